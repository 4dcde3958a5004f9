"""Selection of models against a walk by score over lists."""

import random

import pytest
from pyspark.sql import functions as F

from loomspan.operators import selection


def walk(exons, totals, trivial, utr_most, alternates):
    of = {}
    for g, k, ref, strand, b, e, kind in exons:
        of.setdefault(g, []).append((k, ref, strand, b, e, kind))
    kept, out = [], {}
    order = sorted(totals, key=lambda t: (bool(t[2]), -t[1], min(x[3] for x in of[t[0]]), max(x[4] for x in of[t[0]]), t[0]))
    for g, total, last in order:
        coding = bases = 0
        rows = set()
        for k, ref, strand, b, e, kind in of[g]:
            for w in kept:
                for _, ref2, strand2, b2, e2, kind2 in of[w]:
                    n = min(e, e2) - max(b, b2) + 1
                    if ref != ref2 or n <= 0:
                        continue
                    if kind == kind2 == "CDS":
                        coding += n
                        rows.add(k)
                    if strand == strand2 or "." in (strand, strand2):
                        bases += n
        cds = sum(x[4] - x[3] + 1 for x in of[g] if x[5] == "CDS")
        length = sum(x[4] - x[3] + 1 for x in of[g])
        utr = max(1, length - cds)
        lenient = utr < 0.2 * length or (cds >= 400 and utr < 0.6 * length and total > 300)
        over = coding > trivial * cds or (not lenient and bases >= 30 and bases > utr_most * utr)
        keep = not over or (alternates and len(rows) < sum(x[5] == "CDS" for x in of[g]))
        if keep:
            kept.append(g)
        out[g] = (keep, keep and over, coding, bases)
    return out


@pytest.mark.parametrize("alternates", [False, True])
def test_selection_against_a_walk(spark, alternates):
    draw, exons, totals = random.Random(11), [], []
    for g in range(160):
        ref, strand, at = draw.choice(["a", "b"]), draw.choice("+-."), draw.randrange(0, 6000)
        for k in range(1, draw.randrange(2, 7)):
            n = draw.randrange(20, 260)
            exons.append((g, k, ref, strand, at, at + n, "CDS" if draw.random() < 0.6 else "exon"))
            at += n + draw.randrange(10, 200)
        totals.append((g, draw.randrange(0, 500), draw.choice([True, False, False, None])))
    df = spark.createDataFrame(exons, "gid long, exon_no long, ref string, strand string, begin long, end long, kind string").withColumn("coding", F.lit("clash"))
    given = spark.createDataFrame(totals, "gid long, total long, last boolean")
    got = {r["gid"]: (r["kept"], r["alternate"], r["coding"], r["bases"]) for r in selection.select_models(df, given, alternates=alternates).collect()}
    assert got == walk(exons, totals, 0.1, 0.2, alternates)
    assert 10 < sum(v[0] for v in got.values()) < 150 and any(v[1] for v in got.values()) == alternates
    assert selection.select_models(df, given.limit(0)).collect() == []
