"""Similarity pairs, unique genes of groups and alignment patterns against walks."""

import random
from collections import defaultdict

import pytest

from loomspan.functions import alignments
from loomspan.operators import orthology
from loomspan.plans import orthology_queries

HIT = "q long, t long, qb long, qe long, tb long, te long, bits double, ident double, aln double, evalue double, row_no long"


def pairs_walk(hits, length, database, least_bits, most_evalue, least_align, mirror):
    held = defaultdict(list)

    def clash(b, e, x, y, slop):
        return not (e < x or b > y or (e > y and b >= y - slop) or (b < x and e <= x + slop))

    for q, t, qb, qe, tb, te, bits, ident, aln, evalue, _ in sorted(hits, key=lambda h: (h[0], h[1], h[10])):
        qb, qe, tb, te = min(qb, qe), max(qb, qe), min(tb, te), max(tb, te)
        slop_q, slop_t = max(6, int(0.02 * (qe - qb + 1))), max(6, int(0.02 * (te - tb + 1)))
        if not any(clash(qb, qe, h[0], h[1], slop_q) or clash(tb, te, h[2], h[3], slop_t) for h in held[q, t]):
            held[q, t].append((qb, qe, tb, te, bits, ident, aln, evalue))
    by_query = defaultdict(list)
    for (q, t), parts in held.items():
        bits, ident, aln = (sum(h[k] for h in parts) for k in (4, 5, 6))
        ql, tl = length.get(q, 0), length.get(t, 0)
        evalue = parts[0][7]
        if len(parts) > 1:
            known = min(x for x in (ql, tl) if x) if ql or tl else 0
            evalue = 1.0 if known <= 0 else 0.0 if bits > 1023 else float(f"{known * database / 2**bits:.0e}")
        if bits < least_bits or evalue > most_evalue or (least_align and not (max(ql, tl) and 100 * aln / max(ql, tl) >= least_align)):
            continue
        spans = [f"{i}:{h[0]}-{h[1]}:{h[2]}-{h[3]}" for i, h in enumerate(parts, 1)]
        turned = [f"{i}:{h[2]}-{h[3]}:{h[0]}-{h[1]}" for i, h in enumerate(parts, 1)]
        rest = (evalue, int(100 * ident / aln), bits, len(parts))
        by_query[q].append((-bits, t, (q, ql, t, tl, *rest, ".".join(spans)), (t, tl, q, ql, *rest, ".".join(turned))))
    out = []
    for q in sorted(by_query):
        rows = sorted(by_query[q], key=lambda r: r[:2])
        out += [r[2] for r in rows] + ([r[3] for r in rows] if mirror else [])
    return [(i, *r) for i, r in enumerate(out, 1)]


@pytest.mark.parametrize("mirror,align", [(False, 0), (True, 30)])
def test_similarity_pairs_against_a_walk(spark, mirror, align):
    draw, hits = random.Random(4), []
    for i in range(500):
        q, t = draw.randrange(25), draw.randrange(8)
        n, qb, tb = draw.randrange(3, 90), draw.randrange(1, 300), draw.randrange(1, 300)
        a, b = (qb, qb + n), (tb, tb + n)
        b = b[::-1] if draw.random() < 0.2 else b
        hits.append((q, t, *a, *b, float(draw.randrange(10, 60)), float(n * draw.randrange(3, 10) // 10), float(n), 10.0 ** -draw.randrange(0, 12), i))
    length = {i: 60 * i for i in range(1, 20)}
    found = orthology.similarity_pairs(spark.createDataFrame(hits, HIT), spark.createDataFrame(list(length.items()), "id long, len long"), 1_000_000, 25, 1e-3, align, mirror=mirror, block=7)
    got = sorted(tuple(r[c] for c in ("number", "q", "q_len", "t", "t_len", "evalue", "pident", "bits", "parts", "spans")) for r in found.collect())
    want = pairs_walk(hits, length, 1_000_000, 25, 1e-3, align, mirror)
    assert [(*r[:5], *r[6:]) for r in got] == [(*r[:5], *r[6:]) for r in want]
    assert [r[5] for r in got] == pytest.approx([r[5] for r in want], rel=0.35)  # one digit; halves may round either way
    assert any(r[8] > 2 for r in got)


def test_similarity_pairs_query(spark, small):
    hits = [tuple(r) for r in orthology_queries.protein_hits(spark, small).selectExpr("q", "t", "qb", "qe", "tb", "te", "double(bits)", "double(ident)", "double(aln)", "evalue", "row_no").collect()]
    parts = spark.read.parquet(f"{small}/part.parquet").collect()
    length = {r["p_partkey"]: 300 + r["p_size"] * 10 for r in parts}
    got = sorted((r["number"], r["q"], r["t"], r["spans"]) for r in orthology_queries.similarity_pairs(spark, small).collect())
    want = pairs_walk(hits, length, 10_000_000, 40, 1e-5, 0, True)
    assert got == [(r[0], r[1], r[3], r[9]) for r in want] and got


def test_group_genes_against_two_passes(spark):
    draw = random.Random(5)
    hits = [(g := draw.randrange(30), m, draw.randrange(40), draw.randrange(80, 100), 100 + 9 * g, draw.choice([100, 150, 200, 300])) for m in range(400)]
    best, top, sizes = {}, defaultdict(int), defaultdict(list)
    for gene, member, grp, bits, size, member_size in sorted(hits, key=lambda h: (h[2], -h[3], h[0], h[1])):
        best.setdefault(grp, (gene, member, bits, size))
        top[gene] = max(top[gene], bits)
        sizes[grp].append(member_size)
    given = {}
    for near in (True, False):
        for grp in sorted(best):
            gene, member, bits, size = best[grp]
            if gene not in given and grp not in {v[1] for v in given.values()} and (not near or top[gene] <= 2 + bits):
                given[gene] = (member, grp, bits, size)
    want = set()
    for gene, (member, grp, bits, size) in given.items():
        median = sorted(sizes[grp], reverse=True)[len(sizes[grp]) // 2]
        want.add((gene, member, grp, bits, size, median, size - median, 2 if size > 1.9 * median else -2 if size < 0.65 * median else 0))
    df = spark.createDataFrame(hits, "gene long, member long, grp long, bits long, size long, member_size long")
    rows = [tuple(r) for r in orthology.group_genes(df).collect()]
    assert set(rows) == want and len(rows) == len(want)


def patterns_walk(x, y):
    if x is None or y is None or len(x) != len(y):
        return None
    start, other = x.find("ATG"), y.find("ATG")
    start = max(start, 0)
    start = other if 0 <= other < start else start
    x, y = x[start:], y[start:]
    if len(x) < 2:
        return None
    out, run, longest, step = defaultdict(int), 0, 0, 1 + len(x) // 3
    for i, (a, b) in enumerate(zip(x, y)):
        kind = "g" if a == "-" or b == "-" else "e" if a == b else "n" if "N" in (a, b) else "d"
        out["len1"] += a != "-"
        out["len2"] += not (b == "-" and a != "-")
        name = {"g": "gp", "e": "es" if i % 3 == 2 else "en", "d": "ds" if i % 3 == 2 else "dn"}.get(kind)
        if name:
            for p in ("t", "b" if i < step else "m" if i < 2 * step else "e"):
                out[f"{p}_{name}"] += 1
                out[f"{p}_tn"] += 1
            run = run + 1 if kind == "e" else 0
            longest = max(longest, run)
    return {**out, "er": longest}


def test_alignment_patterns_against_a_walk(spark):
    draw = random.Random(6)
    rows = [(k, "".join(draw.choice("ACGTATG-N") for _ in range(n)), "".join(draw.choice("ACGTATG-N") for _ in range(n))) for k, n in enumerate([0, 1, 2, 3, 7, *[draw.randrange(0, 90) for _ in range(60)]])]
    rows = [(k, x, x[: len(x) // 2] + y[len(x) // 2 :]) for k, x, y in rows] + [(900, None, "A"), (901, "AC", "A"), (902, "ATG", None), (903, "ATGé", "ATGé")]
    df = spark.createDataFrame(rows, "id long, x string, y string")
    got = df.select("id", alignments.alignment_patterns(df["x"], df["y"]).alias("c")).collect()
    for r in got:
        want = patterns_walk(*next(x[1:] for x in rows if x[0] == r["id"]))
        if want is None:
            assert r["c"] is None or r["c"]["t_tn"] is None
        else:
            assert {k: v for k, v in r["c"].asDict().items() if v} == {k: v for k, v in want.items() if v}, r["id"]


def test_hits_of_a_pair_are_not_walked_one_by_one():
    import random

    import pandas as pd

    from loomspan.operators.orthology import _FIELDS, _parts

    from .test_frames import _steps

    run = _parts(6, 0.02, ("int64", "int64"))
    same = pd.DataFrame([(1, 1, 10, 90, 10, 90, 5.0, 4.0, 80.0, 0.1)] * 50_000, columns=_FIELDS)
    assert _steps(lambda: list(run(iter([same])))) < 50_000  # less than one a hit

    rng = random.Random(5)
    rows = []
    for q in range(6):
        for t in range(5):
            for _ in range(rng.choice([1, 2, 60])):
                b, c = rng.randrange(600), rng.randrange(900)
                rows.append((q, t, b, b + rng.randrange(90), c + rng.randrange(-40, 90), c, float(rng.randrange(99)), 1.0, 2.0, rng.random()))

    def clash(b, e, x, y, slop):
        return not (e < x or b > y or (e > y and b >= y - slop) or (b < x and e <= x + slop))

    want = {}
    for q, t, *at, bits, ident, aln, evalue in rows:
        qb, qe, tb, te = min(at[:2]), max(at[:2]), min(at[2:]), max(at[2:])
        held, sums, _ = want.setdefault((q, t), ([], [0.0] * 3, evalue))
        slop = [max(6, int(0.02 * (1 + e - b))) for b, e in ((qb, qe), (tb, te))]
        if not any(clash(qb, qe, w, x, slop[0]) or clash(tb, te, y, z, slop[1]) for w, x, y, z in held):
            held.append((qb, qe, tb, te))
            sums[:] = [x + y for x, y in zip(sums, (bits, ident, aln))]
    want = [(*k, len(h), *s, first, ".".join(f"{i}:{a}-{b}:{c}-{d}" for i, (a, b, c, d) in enumerate(h, 1))) for k, (h, s, first) in want.items()]
    table = pd.DataFrame(rows, columns=_FIELDS)
    for size in (len(rows), 7, 1):  # a pair may lie in several batches
        got = pd.concat(run(table[i : i + size] for i in range(0, len(rows), size)))
        assert list(got.itertuples(index=False, name=None)) == want
