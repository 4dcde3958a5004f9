"""Introns listed by site, and containment told from suffixes that begin like a chain of their main."""

import random

from loomspan.operators import alternates


def test_sites_against_all_pairs(spark):
    rng = random.Random(5)
    exons = [(g, n, "c", rng.choice("+-"), b := 100 * n + rng.choice([0, 7]), b + rng.choice([40, 50]), "CDS") for g in range(60) for n in range(rng.randrange(1, 6))]
    df = spark.createDataFrame(exons, "gid long, exon_no long, ref string, strand string, begin long, end long, kind string")
    places = alternates.shared_introns(df)
    rows = [tuple(r) for r in places.select("ref", "strand", "begin", "end", "intron", "support").collect()]
    want = {}
    for g, n, ref, strand, b, e, _ in exons:
        if near := [x for x in rows if x[:2] == (ref, strand) and (x[3] == b - 1 or x[2] == e + 1)]:
            want[g, n] = (b, e, sorted({x[4] for x in near}), sum(x[5] for x in near))
    got = {(r["gid"], r["exon_no"]): (r["begin"], r["end"], r["introns"], r["score"]) for r in alternates.sited_exons(df, places).collect()}
    assert got == want and len(want) > 50


def test_chains_are_the_same_from_sites_that_hold_places(spark):
    df = spark.createDataFrame([(g, n, "c", "+", 100 * n, 100 * n + 40 + g % 2, "CDS") for g in range(8) for n in range(1, 5)], "gid long, exon_no long, ref string, strand string, begin long, end long, kind string")
    places, mains = alternates.shared_introns(df), spark.createDataFrame([(0,), (1,)], "gid long")
    wide, plain = (alternates.pick(df, f(df, places), mains).orderBy("main", "gid").collect() for f in (alternates.sited_exons, alternates.splice_sites))
    assert wide == plain and len(wide) > 2


def test_contained_against_all_pairs(spark):
    rng = random.Random(6)
    rows = []
    for m in range(6):
        for _ in range(15):
            first = rng.randrange(6)
            rows.append((m, ";".join(f"<{a}>" if rng.random() < 0.7 else f"<{a}>,<{a}b>" for a in range(first, first + rng.randrange(1, 6)))))
    want = {(m, c) for m, c in rows for n, d in rows if m == n and c != d and c in d}
    assert {tuple(r) for r in alternates.contained(spark.createDataFrame(rows, "main long, chain string"), "main").collect()} == want and want
