"""Strand segments and partitions against a walk over whole scaffolds, window by window."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from loomspan.operators import intervals, strands


def segments_walk(introns, size, window=100, reach=300, least=6, share=0.05, scan=99):
    """introns: (strand, begin, end, score) of one scaffold. The scaffold's windows as an array that is filled from left to right."""
    top = size // window
    span = {"+": defaultdict(int), "-": defaultdict(int)}
    for strand, b, e, score in introns:
        if strand in span:
            for lo, hi in ((max(1, b - reach), max(1, b - 1)), (e + 1, e + reach)):
                for i in range(lo // window, hi // window + 1):
                    span[strand][i] += score
    kind = []
    for i in range(top + 1):
        f, r = (v if v >= least else 0 for v in (span["+"][i], span["-"][i]))
        kind.append(0 if not f and not r else -1 if not f else 1 if not r else -1 if f < share * r else 1 if r < share * f else 2)
    if not any(kind):
        return []
    last = 0
    for i in range(top + 1):
        if kind[i] == 0:
            j = next((k for k in range(i + 1, min(i + scan, top) + 1) if kind[k]), None)
            if j is not None and last not in (0, kind[j]) and j > i + 2:
                half, other = (i + j) // 2, kind[j]
                kind[i:half] = [last] * (half - i)
                kind[half:j] = [other] * (j - half)
            elif j is not None:
                kind[i:j] = [kind[j]] * (j - i)
            elif last:
                for k in range(i, min(i + scan, top) + 1):
                    if kind[k]:
                        break
                    kind[k] = last
        last = kind[i]
    out, begin = [], 0
    for i in range(1, top + 2):
        if i == top + 1 or kind[i] != kind[begin]:
            t = kind[begin]
            follow = -1
            if i == top + 1:
                follow = 0
            elif t:
                keeps = (1, 2) if t in (1, 2) else (-1, 2)
                follow = next((j - i for j in range(i, i + 50) if j > top or kind[j] not in keeps), -1)
            out.append((len(out) + 1, begin * window + 1, i * window, sum(span["+"][k] for k in range(begin, i)), sum(span["-"][k] for k in range(begin, i)), t, follow))
            begin = i
    return out


def partitions_walk(rows, sizes, part, least=6):
    """rows: (ref, *segment). Numbers given in turn, scaffolds by size."""
    total, number, out = defaultdict(int), {}, {}
    for ref, k, b, e, f, r, t, follow in sorted(rows, key=lambda x: (-sizes[x[0]], x[0], x[1])):
        shown = 0 if f < least and r < least else t
        got = []
        for name, keeps in (("fwd", (1, 2)), ("rev", (-1, 2))):
            if shown not in keeps:
                got.append(None)
                continue
            total[name] += e - b + 1
            n = 1 + total[name] // part
            if name in number and n == number[name] + 1 and follow > 0:
                n = number[name]
            number[name] = n
            got.append(n)
        out[ref, k] = (shown, *got)
    return out


@pytest.mark.parametrize("block", [7, 10_000])
def test_segments_and_partitions_against_a_walk(spark, block):
    draw, introns, sizes = random.Random(block), [], {}
    for k in range(14):
        ref, size = f"c{k}", draw.choice([5_000, 60_000, 200_000, 20_050])
        sizes[ref] = size
        at, strand = draw.randrange(20_000), draw.choice("+-")
        while at < size - 500 and k != 3:
            b = at + draw.randrange(300)
            introns.append((ref, strand if draw.random() < 0.9 else draw.choice("+-."), b + 1, b + draw.randrange(60, 900), draw.choice([1, 3, 4, 7, 90])))
            at += draw.choice([10, 40, 100, 400, 3_000, 10_300, 23_000]) if draw.random() < 0.7 else 20
            strand = draw.choice("+-") if draw.random() < 0.2 else strand
    df = spark.createDataFrame(introns, "ref string, strand string, begin long, end long, score long").withColumn("last", F.lit("clash"))
    held = spark.createDataFrame(list(sizes.items()), "ref string, size long")
    found = strands.segments(df, held, block=block)
    got = sorted((r["ref"], *(r[c] for c in ("segment", "begin", "end", "fwd", "rev", "strand", "next"))) for r in found.collect())
    want = sorted((ref, *row) for ref, size in sizes.items() for row in segments_walk([x[1:] for x in introns if x[0] == ref], size))
    assert got == want and {r[6] for r in got} == {0, 1, -1, 2}
    for part in (300, 4_000, 25_000):
        dealt = {(r["ref"], r["segment"]): (r["shown"], r["fwd_part"], r["rev_part"]) for r in strands.partitions(found, held, part, block=block).collect()}
        assert dealt == partitions_walk(want, sizes, part)
    assert strands.partitions(strands.segments(df.limit(0), held), held).collect() == []


def test_coverage_dealt_by_block(spark):
    draw = random.Random(4)
    rows = [(draw.choice("ab"), b := draw.randrange(-30, 2_000), b + draw.randrange(0, 300), draw.randrange(-2, 9)) for _ in range(250)]
    df = spark.createDataFrame(rows, "ref string, begin long, end long, score long")
    plain = sorted(tuple(r) for r in intervals.coverage(df, ["ref"]).collect())
    assert sorted(tuple(r) for r in intervals.coverage(df, ["ref"], block=60).collect()) == plain and plain
