"""Join and split codes against hand cases and a walk over each gene's exons."""

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from loomspan.operators import splits


def code_walk(nx, chains_of, quality):
    """chains_of: exon -> names of its chains, evidence before introns in their order (kind, name)."""
    size = Counter(c for cs in chains_of.values() for c in cs)
    group = defaultdict(list)
    for x in sorted(chains_of):
        group[min(chains_of[x], key=lambda c: (-size[c], c))].append(x)
    if not group:
        return "N0", "", ""
    ordered = sorted(group, key=lambda c: (-len(group[c]), c))
    main, others = group[ordered[0]], ordered[1:]
    n1, has = len(main), {x for xs in group.values() for x in xs}
    text = ",".join(map(str, main)), ";".join(",".join(map(str, group[c])) for c in others)
    loose_end = 1 not in has or nx not in has
    in_row = main == list(range(main[0], main[0] + n1))
    if n1 >= nx or nx == 1 or (nx > 5 and n1 == nx - 1 and loose_end):
        return "C1", *text
    if nx < 3 or n1 == 1 or n1 < 0.2 * nx:
        return "EP3", *text
    if others:
        more = by_id = 0
        for c in others:
            more += len(group[c])
            by_id += len(group[c]) * (c[0] == 0)
            if n1 + more >= nx:
                break
        if nx > 3 and (n1 + more) / nx < 0.75:
            return "EP3", *text
        if more < 2 and n1 > 1 and nx > 3 and in_row:
            return "C1T1", *text
        if more > 1:
            return "IJ4" if by_id <= 1 else "EM4" if "complete" in quality else "J2", *text
    else:
        if nx > 3 and n1 == nx - 1 and loose_end:
            return "C1", *text
        if nx > 3 and n1 / nx < 0.75:
            return "EP3", *text
    return "EM4" if nx > 3 and n1 > 0.74 * nx and in_row else "ER2", *text


def quality_walk(nx, introns):
    """introns: exon -> (names, value)."""
    joins = [x > 1 and x in introns and x - 1 in introns and bool(set(introns[x][0]) & set(introns[x - 1][0])) for x in range(1, nx + 1)]
    good, bad, j = sum(v > 0 for _, v in introns.values()), sum(v < 0 for _, v in introns.values()), sum(joins)
    if not good and not bad:
        return "none", joins
    if bad:
        return "poor", joins
    if nx > 2 and good == nx and j + 1 == nx:
        return "complete", joins
    if nx > 3 and good >= nx - 2 and (j >= nx - 3 or j > 0.75 * nx):
        k = 3 if j > 8 else 2
        return ("complete_inner" if all(joins[k : nx - k + 1]) else "miss_inner"), joins
    if good and j:
        return ("good" if good / nx > 0.66 else "ok"), joins
    return "poor", joins


def test_codes_against_a_walk(spark):
    draw, exons, ids, sites, want = random.Random(3), [], [], [], {}
    for gid in range(500):
        nx = draw.choice([1, 2, 3, 4, 5, 6, 8, 11, 14])
        covered, introns = defaultdict(set), {}
        for k in range(draw.randrange(0, 4)):
            a, b = sorted((draw.randrange(1, nx + 1), draw.randrange(1, nx + 1)))
            for x in range(a, b + 1):
                if draw.random() < 0.9:
                    covered[x].add((0, f"p{draw.randrange(6)}" if draw.random() < 0.1 else f"r{k}"))
        lost = draw.choice([0, 0.1, 0.4, 1])
        gaps = {g for g in range(1, nx) if draw.random() >= lost}
        for x in range(1, nx + 1):
            names = [f"i{g}" for g in (x - 1, x) if g in gaps]
            if names:
                introns[x] = (names, draw.choice([5, 5, 5, 5, 5, 0, -1]) if draw.random() < 0.15 else 3)
        quality, joins = quality_walk(nx, introns)
        run = 0
        chains = {x: set(c) for x, c in covered.items()}
        for x in range(1, nx + 1):
            if x in introns:
                run += not joins[x - 1]
                chains.setdefault(x, set()).add((1, f"{run:06d}"))
        want[gid] = (*code_walk(nx, chains, quality), quality, nx)
        exons += [(gid, 100 + x, 1000 * x, 1000 * x + 99) for x in range(1, nx + 1)]
        ids += [(gid, 100 + x, c[1]) for x, cs in covered.items() for c in cs] * 2
        sites += [(gid, 100 + x, names, v) for x, (names, v) in introns.items()]
    rows = splits.join_check(
        spark.createDataFrame(exons, "gid long, exon_no long, begin long, end long").withColumn("x", F.lit("clash")).withColumn("introns", F.lit(1)),
        spark.createDataFrame(ids, "gid long, exon_no long, id string"), spark.createDataFrame(sites, "gid long, exon_no long, introns array<string>, score long"),
    )
    got = {r["gid"]: (r["code"], r["main"], r["others"], r["quality"], r["nx"]) for r in rows.collect()}
    assert got == want
    assert {w[0] for w in want.values()} == set(splits.SCORES)


def test_hand_cases(spark):
    cases = {  # number of exons, evidence id -> exons; code
        1: (8, {"a": [1, 2, 3, 4, 5, 6, 7, 8]}, "C1"), 2: (8, {"a": [1, 2, 3, 4], "b": [5, 6, 7, 8]}, "J2"), 3: (8, {"a": [1, 2, 3, 4, 6, 7, 8], "b": [5]}, "ER2"),
        4: (5, {"a": [1, 2, 3, 4], "b": [5]}, "C1T1"), 5: (7, {}, "N0"), 6: (10, {"a": [1]}, "EP3"), 7: (13, {"a": list(range(1, 11)), "b": [11, 12, 13]}, "J2"), 8: (5, {"a": [1, 2, 3, 4]}, "C1"),
    }
    exons = spark.createDataFrame([(g, x, x * 100, x * 100 + 50) for g, (nx, _, _) in cases.items() for x in range(1, nx + 1)], "gid long, exon_no long, begin long, end long")
    ids = spark.createDataFrame([(g, x, i) for g, (_, held, _) in cases.items() for i, xs in held.items() for x in xs], "gid long, exon_no long, id string")
    none = spark.createDataFrame([], "gid long, exon_no long, introns array<string>, score long")
    got = {r["gid"]: r["code"] for r in splits.join_check(exons, ids, none).collect()}
    assert got == {g: code for g, (_, _, code) in cases.items()}
    assert splits.join_check(exons.limit(0), ids, none).collect() == []
