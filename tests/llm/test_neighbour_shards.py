"""A query travels once to each shard that it visits, however many leaves it looks at there."""

import numpy as np
import pandas as pd

from loomspan.llm import neighbours


def test_vectors_sent_by_shard():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(2000, 4))
    tree = neighbours.fit_tree(x, 8, 20)
    leaves = neighbours.assign(tree, x)
    pieces = -(-np.bincount(leaves, minlength=neighbours._leaves(tree)) // 7)
    pieces[0] = 50  # more chunks than shards
    first = np.cumsum(pieces) - pieces
    queries = pd.DataFrame({"vec_id": range(100), "v": list(x[:100])})
    sent = pd.concat(neighbours._sent(tree, first, pieces, 60, 6)([queries]))
    assert len(sent) <= 600 and not sent.duplicated(["shard", "query_id"]).any()
    for i in (0, 63, 64, 99):
        wanted = {((first[f] + c) % 6, f) for f in neighbours.best_bins(tree, x[i], 60) for c in range(pieces[f])}
        got = [(s, f) for s, _, _, fs in sent[sent["query_id"] == i].itertuples(index=False) for f in fs]
        assert set(got) == wanted and len(got) == len(wanted)


def test_best_of_visited_leaves():
    rng = np.random.default_rng(2)
    x, q = rng.normal(size=(50, 3)), rng.normal(size=(5, 3))
    leaves = np.arange(50) % 4
    got = neighbours._best(np.arange(5), q, np.arange(50), x, 3, leaves, [np.array([i % 4, 3]) for i in range(5)])
    for i, rows in got.groupby("query_id"):
        fine = [(-s, j) for j, s in enumerate(x @ q[i]) if leaves[j] in (i % 4, 3) and j != i]
        assert list(rows["vec_id"]) == [j for _, j in sorted(fine)[:3]]
