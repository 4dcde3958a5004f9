"""Approximate nearest neighbours by a hierarchical k-means tree with best-bin-first traversal.

The tree is fitted on a bounded sample; every vector is then sent down it to one leaf. A query walks the tree
through a priority queue of nodes, best centroid first, and lists leaves in that order. How many leaves it
visits is calibrated: for a bounded set of calibration queries the true neighbours are found over all rows,
and visits widen until the wanted share of them lies in visited leaves. Leaves are cut into bounded chunks by
a hash, so that a leaf with a third of all rows is shared among tasks, and chunks are dealt to shards of bounded
size. A query travels to a shard once, with the leaves it visits there, and keeps its best k of the shard;
queries go in blocks of bounded size, so that neither side of a task grows with the table.

Defined results: vectors that are null, all zero, hold a null or non-finite part, or have a length other than
the most frequent one take no part; equal scores rank by smaller vec_id; repeated rows count one by one; a
query has fewer than k rows where fewer candidates exist; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

_NODE_ITERATIONS = 8

#: Least number of shards that rows are dealt to, so that small tables keep all cores busy.
_SHARDS = 24


def usable(vectors: DataFrame) -> DataFrame:
    """Rows (vec_id, v) with v an array of doubles of the most frequent length."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.coalesce(F.forall("v", fine) & F.exists("v", lambda x: x != 0), F.lit(False)))
    lengths = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    return rows.where(F.size("v") == (lengths[0]["d"] if lengths else 0))


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=False)]
    for _ in range(_NODE_ITERATIONS):
        near = np.argmin((centres**2).sum(1) - 2 * x @ centres.T, axis=1)
        for j in range(k):
            if (near == j).any():
                centres[j] = x[near == j].mean(0)
    return centres


def fit_tree(sample: np.ndarray, branch: int, leaf_rows: int, seed: int = 3) -> list:
    """Nested nodes [centres, children]; a child is a node or a leaf number."""
    rng, leaves = np.random.default_rng(seed), iter(range(1 << 30))

    def grow(x: np.ndarray):
        distinct = np.unique(x, axis=0)
        if len(x) <= leaf_rows or len(distinct) <= branch:
            return next(leaves)
        centres = _kmeans(distinct, branch, rng)
        near = np.argmin((centres**2).sum(1) - 2 * x @ centres.T, axis=1)
        kept = [j for j in range(branch) if (near == j).any()]
        if len(kept) == 1:
            return next(leaves)
        return [centres[kept], [grow(x[near == j]) for j in kept]]

    root = grow(sample)
    return root if isinstance(root, list) else [sample[:1], [root]]


def assign(tree: list, x: np.ndarray) -> np.ndarray:
    """The leaf of each row: down the tree by nearest centre."""
    out = np.empty(len(x), np.int64)

    def down(node, rows):
        if not isinstance(node, list):
            out[rows] = node
            return
        centres, children = node
        near = np.argmin((centres**2).sum(1) - 2 * x[rows] @ centres.T, axis=1)
        for j, child in enumerate(children):
            if (got := rows[near == j]).size:
                down(child, got)

    down(tree, np.arange(len(x)))
    return out


def _leaves(tree: list) -> int:
    """Number of leaves."""
    return sum(_leaves(x) for x in tree[1]) if isinstance(tree, list) else 1


def best_bins(tree: list, q: np.ndarray, visits: int) -> list[int]:
    """The first leaves that a best-bin-first walk reaches, nodes ranked by inner product with their centre."""
    queue, out, order = [(0.0, 0, tree)], [], 1
    while queue and len(out) < visits:
        _, _, node = heapq.heappop(queue)
        if not isinstance(node, list):
            out.append(node)
            continue
        for score, child in zip(node[0] @ q, node[1]):
            heapq.heappush(queue, (-float(score), order, child))
            order += 1
    return out


def _best(query_ids, queries, ids, vectors, k, leaves=None, visited=None):
    """The best k rows for each query, its own row apart: (query_id, vec_id, score), ties to the smaller id.

    leaves: of the rows; visited: for each query the leaves it looks at, all where there are none.
    """
    found = []
    order = np.argsort(ids, kind="stable")
    ids, vectors = ids[order], vectors[order]
    names, leaf = np.unique(leaves[order], return_inverse=True) if leaves is not None else (None, None)
    for a in range(0, len(query_ids), 256):
        scores = queries[a : a + 256] @ vectors.T
        for at, (qid, q, row) in enumerate(zip(query_ids[a : a + 256], queries[a : a + 256], scores), a):
            out = ids == qid
            if leaf is not None:
                out |= ~np.isin(names, visited[at])[leaf]
            row = np.where(out, -np.inf, row)
            n = min(k, len(row))
            # blocked products differ in the last bits: take all near the k-th, then settle by plain sums
            edge = np.partition(row, len(row) - n)[len(row) - n]
            near = np.flatnonzero((row >= edge - 1e-9 * max(1.0, abs(edge) if np.isfinite(edge) else 1.0)) & (row > -np.inf))
            exact = (vectors[near] * q).sum(axis=1)
            top = np.lexsort((ids[near], -exact))[:k]
            found.append(pd.DataFrame({"query_id": qid, "vec_id": ids[near][top], "score": exact[top]}))
    return pd.concat(found) if found else pd.DataFrame({"query_id": [], "vec_id": [], "score": []})


_FOUND = "query_id long, vec_id long, score double"


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The best k of all chunks, by a bounded sort of each query's few partial lists."""
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k)
    rows = found.groupBy("query_id").agg(best.alias("best")).select("query_id", F.posexplode("best").alias("at", "x"))
    return rows.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.s")).alias("score"))


def _truth(rows: DataFrame, queries: pd.DataFrame, k: int) -> DataFrame:
    """Exact neighbours of a bounded set of queries over all rows: a partial list a task, then merged."""
    ids, x = queries["vec_id"].to_numpy(), np.stack(queries["v"].to_list())

    def run(batches):
        for b in batches:
            if len(b):
                yield _best(ids, x, b["vec_id"].to_numpy(), np.stack(b["v"].to_list()), k).assign(leaf=0)

    return _ranked(rows.mapInPandas(run, _FOUND + ", leaf long").drop("leaf"), k)


def _sent(tree: list, first: np.ndarray, pieces: np.ndarray, visits: int, shards: int):
    """For mapInPandas over (vec_id, v): a row for each shard that a query visits, with the leaves it visits there.

    Leaf i is cut into pieces[i] chunks, numbered from first[i]; chunk n lies in shard n mod shards. A query's rows go out before
    the next one's are made but for a few, so that a frame holds few vectors.
    """

    def frames(batches):
        for b in batches:
            for a in range(0, len(b), 64):
                out = []
                for vec_id, v in zip(b["vec_id"][a : a + 64], b["v"][a : a + 64]):
                    leaves = np.asarray(best_bins(tree, np.asarray(v), visits))
                    leaves = leaves[pieces[leaves] > 0]
                    spread = np.minimum(pieces[leaves], shards)  # more chunks than shards come round again
                    leaf = np.repeat(leaves, spread)
                    shard = (first[leaf] + np.arange(len(leaf)) - np.repeat(np.cumsum(spread) - spread, spread)) % shards
                    order = np.argsort(shard, kind="stable")
                    found, at = np.unique(shard[order], return_index=True)
                    out += [(s, vec_id, v, x) for s, x in zip(found, np.split(leaf[order], at[1:]))]
                yield pd.DataFrame(out, columns=["shard", "query_id", "q", "leaves"]).astype({"shard": "int64", "query_id": "int64"})

    return frames


def search(vectors: DataFrame, every: int = 20, k: int = 20, recall: float = 0.97, sample_rows: int = 20_000,
           branch: int = 8, leaf_rows: int = 120, calibration: int = 100, chunk_rows: int = 2_000,
           shard_rows: int = 16_000, block_queries: int = 8_000) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): each query's k nearest found. Queries: vec_id divisible by every.

    recall is the calibrated aim. The tree's sample and the calibration set are the rows whose ids hash lowest.
    """
    spark = vectors.sparkSession
    rows = stored(usable(vectors), "vectors")
    pick = F.xxhash64("vec_id", F.lit(5))
    sample = rows.orderBy(pick, "vec_id").limit(sample_rows).toPandas()
    if not len(sample):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = fit_tree(np.stack(sample["v"].to_list()), branch, leaf_rows)
    # an id asks once: of repeated query rows the smallest vector does
    queries = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("v").alias("v"))
    trial = queries.orderBy(pick, "vec_id").limit(calibration).toPandas()
    if not len(trial):
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    def to_leaf(batches):
        for b in batches:
            if len(b):
                yield b.assign(leaf=assign(tree, np.stack(b["v"].to_list())))

    leaved = stored(rows.mapInPandas(to_leaf, "vec_id long, v array<double>, leaf long"), "leaved")
    truth = _truth(rows, trial, k).join(leaved.select("vec_id", "leaf"), "vec_id").select("query_id", "leaf").toPandas()
    needed = []
    for qid, q in zip(trial["vec_id"], trial["v"]):
        place = {leaf: i + 1 for i, leaf in enumerate(best_bins(tree, np.asarray(q), 1 << 30))}
        needed += [place[leaf] for leaf in truth.loc[truth["query_id"] == qid, "leaf"]]
    visits = int(np.sort(needed)[max(0, int(np.ceil(recall * len(needed))) - 1)]) if needed else 1

    # one row a leaf: leaves are bounded by the sample
    counts = leaved.groupBy("leaf").agg(F.count("*").alias("n")).toPandas()
    pieces = np.zeros(max(counts["leaf"].max() + 1, _leaves(tree)), np.int64)
    pieces[counts["leaf"]] = -(-counts["n"] // chunk_rows)
    first = np.cumsum(pieces) - pieces
    shards = int(max(_SHARDS, -(-counts["n"].sum() // shard_rows)))
    blocks = -(-queries.count() // block_queries)
    places = counts.assign(first=first[counts["leaf"]], pieces=pieces[counts["leaf"]])[["leaf", "first", "pieces"]]
    dealt = leaved.join(F.broadcast(spark.createDataFrame(places, "leaf long, first long, pieces long")), "leaf")
    shard = (F.col("first") + F.pmod(F.xxhash64("vec_id"), "pieces")) % shards
    every_block = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block")
    dealt = dealt.select(shard.alias("shard"), every_block, "leaf", "vec_id", "v")
    asks = queries.mapInPandas(_sent(tree, first, pieces, visits, shards), "shard long, query_id long, q array<double>, leaves array<long>")
    asks = asks.withColumn("block", F.pmod(F.xxhash64("query_id", F.lit(7)), F.lit(blocks).cast("long")))

    def score(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        if not len(asked) or not len(held):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        both = [np.stack(x.to_list()) for x in (asked["q"], held["v"])]
        return _best(asked["query_id"].to_numpy(), both[0], held["vec_id"].to_numpy(), both[1], k, held["leaf"].to_numpy(), asked["leaves"].to_list())

    found = asks.groupBy("shard", "block").cogroup(dealt.groupBy("shard", "block")).applyInPandas(score, _FOUND)
    return _ranked(found, k)
