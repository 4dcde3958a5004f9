"""Identity classes, references, clusters and map rescues against walks over ordered rows."""

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from loomspan.operators import classes, classify
from loomspan.plans import class_queries

PAIR = "q long, q_len long, t long, t_len long, aln long, ident long"


def classes_walk(pairs):
    """One pass over the ordered pairs: the first class of a shorter sequence stays, unless it has become a main."""
    kind_of, parent, main, seen = {}, {}, set(), set()
    for q, q_len, t, t_len, aln, ident in sorted(pairs, key=lambda p: (-p[1], -p[4], p[3], p[0], p[2], -p[5])):
        seen |= {q, t}
        if q == t:
            continue
        pid = min(10**9, int(100 * (0.5 + ident) / aln))
        pal = min(100, int(100 * (0.5 + aln) / max(1, min(q_len, t_len))))
        if t_len > q_len:
            q, q_len, t, t_len = t, t_len, q, q_len
        kind = classify.pair_class(pid, pal, q_len, t_len)
        if kind is None or (q_len == t_len and q in kind_of and parent[q][0] == t):
            continue
        if t in kind_of:
            if kind_of[t].startswith("alt") and kind == "althi1":
                kind_of[t] = kind
        elif t not in main:
            kind_of[t], parent[t] = kind, (q, pid, pal)
            if q not in kind_of:
                main.add(q)
    out = {}
    for x in seen:
        root = x
        while root in parent:
            root = parent[root][0]
        out[x] = (kind_of.get(x, "main" if x in main else "noclass"), root, *parent.get(x, (0, 0, 0))[1:])
    return out


def random_pairs(draw, n, many):
    size = {i: draw.choice([200, 300, 300, 400, 500, 700, 900]) for i in range(n)}
    rows = []
    for _ in range(many):
        a, b = draw.randrange(n), draw.randrange(n)
        aln = max(1, int(min(size[a], size[b]) * draw.choice([0.1, 0.4, 0.9, 0.99, 1])))
        rows.append((a, size[a], b, size[b], aln, int(aln * draw.choice([0.7, 0.85, 0.93, 0.992, 1]))))
    return rows, size


def test_identity_classes_against_a_walk(spark):
    draw = random.Random(3)
    for n, many in ((40, 300), (400, 600), (3, 8), (60, 60)):
        rows, _ = random_pairs(draw, n, many)
        df = spark.createDataFrame(rows, PAIR).withColumn("place", F.lit("clash")).withColumn("id", F.lit(0))
        got = {r["id"]: tuple(r[c] for c in ("class", "main", "pid", "pal")) for r in classes.identity_classes(df).collect()}
        assert got == classes_walk(rows)
    assert classes.identity_classes(df.limit(0)).collect() == []


def test_a_long_chain_of_mains(spark):
    """Each sequence is the alternate of a longer one: verdicts alternate down the chain by which pair comes first."""
    rows = [(i, 2000 - i, i + 1, 1999 - i, 1900 - i, 1900 - i) for i in range(40)]
    got = {r["id"]: (r["class"], r["main"]) for r in classes.identity_classes(spark.createDataFrame(rows, PAIR)).collect()}
    assert got == {k: v[:2] for k, v in classes_walk(rows).items()}


def test_identity_classes_query(spark, small):
    pairs = class_queries._known_pairs(spark, small)
    rows = [tuple(r) for r in pairs.select("q", "q_len", "t", "t_len", "aln", "ident").collect()]
    got = {r["id"]: tuple(r[c] for c in ("class", "main", "pid", "pal")) for r in class_queries.identity_classes(spark, small).collect()}
    assert got == classes_walk(rows)
    kinds = {v[0] for v in got.values()}
    assert {"main", "noclass", "altmid", "altlo"} <= kinds


def test_map_rescue_against_a_walk(spark):
    draw = random.Random(9)
    rows, size = random_pairs(draw, 60, 40)
    maps = [(draw.randrange(60), draw.randrange(60), draw.randrange(1, 100)) for _ in range(90)]
    before = classes_walk(rows)
    for i in range(60):
        before.setdefault(i, ("noclass", i, 0, 0))
    df = spark.createDataFrame(rows + [(i, size[i], i, size[i], 1, 1) for i in range(60)], PAIR)
    sizes = spark.createDataFrame(list(size.items()), "id long, size long")
    found = classes.rescued_by_map(classes.identity_classes(df), spark.createDataFrame(maps, "a long, b long, percent long"), sizes, df)
    got = {r["id"]: tuple(r[c] for c in ("class", "main", "pid", "pal")) for r in found.collect()}
    aligned = {frozenset(p[:3:2]) for p in rows}
    larger = defaultdict(list)
    for a, b, percent in maps:
        if a != b and frozenset((a, b)) not in aligned:
            high, low = sorted((a, b), key=lambda x: (-size[x], x))
            larger[low].append((percent, size[high], -high))
    on = {x: max(v) for x, v in larger.items() if before[x][0] == "noclass"}

    def root(x):
        while x in on:
            x = -on[x][2]
        return before[x][1]

    want = {x: ("altmap", root(x), 99, on[x][0]) if x in on else v for x, v in before.items()}
    assert got == want and "altmap" in {v[0] for v in got.values()}


def test_reference_matches_against_a_walk(spark):
    draw = random.Random(6)
    hits = [(draw.randrange(80), draw.randrange(25), draw.choice([30, 59, 60, 61, 100, 140, 150, 300]), draw.randrange(1, 9)) for _ in range(300)]
    best_t, best_r = {}, {}
    for t, r, bits, aln in sorted(hits, key=lambda h: (-h[2], -h[3], h[0], h[1])):  # of equal scores the last one stays
        if not (t in best_t and best_t[t][0] > bits):
            best_t[t] = (bits, r)
    for t, r, bits, aln in sorted(hits, key=lambda h: (-h[2], -h[3], h[0], h[1])):
        if not (r in best_r and best_r[r][0] > bits):
            best_r[r] = (bits, t)
    want = {}
    for t, (bits, r) in best_t.items():
        top, holder = best_r[r]
        some = any(h == t and b >= 60 for b, h in best_r.values())
        want[t] = (r, bits, top, "refbest" if holder == t else "refok" if some else "refgood" if top > 60 and bits >= 0.9 * top else None)
    got = {x["t"]: (x["ref"], x["bits"], x["ref_best"], x["match"]) for x in classes.reference_matches(spark.createDataFrame(hits, "t long, ref long, bits long, aln long")).collect()}
    assert got == want and set(Counter(v[3] for v in want.values())) == {"refbest", "refok", "refgood", None}


def test_corrected_clusters_against_a_walk(spark):
    draw, rows, want = random.Random(8), [], {}
    grades = ["complete", "complete-utrpoor", "partial3", "partial5-utrbad", "partial", None]
    points = dict(zip(grades, (2, 1, 1, -1, 0, 0)))
    for c in range(40):
        mine = [(c, 100 * c + i, i, draw.randrange(100, 130), draw.choice(grades), i == 1, draw.random() < 0.85) for i in range(draw.randrange(1, 30))]
        rows += mine
        main, size, mark = next(((r[1], r[3], points[r[4]]) for r in mine if r[5] and r[6]), (None, 0, -9))
        for _, i, _, s, grade, _, valid in mine:
            p = points[grade]
            if valid and i != main and ((s > size and p >= mark - 1) or (p > mark and s > 0.98 * size)):
                main, size, mark = i, s, p
        want |= {(c, r[1]): main for r in mine if r[6]}
    df = spark.createDataFrame(rows, "cluster long, id long, place long, size long, grade string, is_main boolean, valid boolean")
    got = {(r["cluster"], r["id"]): r["main"] for r in classes.corrected_clusters(df).collect()}
    assert got == want
    assert classes.corrected_clusters(df.limit(0)).collect() == []


def test_fragments_shuffle_few_words(spark):
    """Of the words of all texts those alone leave a task that some text begins with; the sketch costs rows, never results."""
    import numpy as np
    import pandas as pd

    from loomspan.operators import classify

    draw = random.Random(4)
    texts = ["".join(draw.choice("ACGT") for _ in range(draw.randrange(20, 900))) for _ in range(60)]
    texts += [t[a : a + n] for t in texts[:30] for a, n in ((0, 24), (7, 40), (len(t) // 2, 400))] + [texts[3], texts[5] + "é" + texts[7], "A" * 300, "A" * 24]
    rows = [(n, t) for n, t in enumerate(texts)] + [(None, "A" * 30)]
    want = {}
    for n, t in rows[:-1]:
        held = [m for m, u in rows[:-1] if len(u) > len(t) >= 24 and t in u]
        if held:
            want[n] = min(held)
    df = spark.createDataFrame(rows, "id long, seq string")
    for bits in (25, 4):
        assert {r["id"]: r["holder"] for r in classify.fragments(df, bits=bits).collect()} == want
    sketch = type("Held", (), {"value": np.zeros(1 << 13, np.uint8)})
    assert sum(map(len, classify._words(24, 16, sketch)(iter([pd.DataFrame({"id": [1], "seq": [texts[0]]})])))) == 0
