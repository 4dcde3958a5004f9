"""Vector and gap trimming against an array of bases that are marked and taken out one by one."""

import random

from pyspark.sql import functions as F

from loomspan.operators import trimming
from loomspan.operators.repair import best_orf
from loomspan.plans.catalog import QUERIES


def union_brute(hits):
    out = {}
    for i in {h[0] for h in hits}:
        mine = [h for h in hits if h[0] == i and "weak" not in h[3].lower() and 1 <= h[1] <= h[2]]
        covered = sorted({p for _, b, e, _ in mine for p in range(b, e + 1)})
        spans = [[p, p] for p in covered[:1]]
        for p in covered[1:]:
            joined = p == spans[-1][1] + 1 and any(b <= p - 1 and p <= e for _, b, e, _ in mine)
            if joined:
                spans[-1][1] = p
            else:
                spans.append([p, p])
        out[i] = {(b, e) for b, e in spans}
    return out


def test_vector_spans(spark):
    draw = random.Random(3)
    hits = [(draw.randrange(20), b := draw.randrange(-2, 300), b + draw.randrange(-3, 40), draw.choice(["Strong", "Moderate match", "Weak"])) for _ in range(150)]
    got = {}
    for r in trimming.vector_spans(spark.createDataFrame(hits, "id long, begin long, end long, kind string")).collect():
        got.setdefault(r["id"], set()).add((r["begin"], r["end"]))
    assert got == {i: s for i, s in union_brute(hits).items() if s}


def marked(seq, spans, cds, fill):
    """Bases with their old places, one by one; ends trimmed run by run."""
    gone = {p for b, e in spans for p in range(b, min(e, len(seq)) + 1)}
    if cds and seq[cds[0] - 1 : cds[0] + 2] == "ATG" and not any(b <= cds[0] and e >= cds[1] for b, e in spans):
        gone -= set(range(cds[0], cds[0] + 3))
    out, p = [], 1
    while p <= len(seq):
        if p not in gone:
            out.append((seq[p - 1], p))
            p += 1
            continue
        q = p
        while q in gone:
            q += 1
        if fill:
            out += [("N", None)] * (3 + (q - p) % 3)
        p = q

    def short(bases):
        while True:
            text = "".join(b for b, _ in bases)
            if text.startswith("N"):
                bases = bases[len(text) - len(text.lstrip("N")) :]
            elif 0 <= text.find("NN") <= trimming_near(bases):
                bases = bases[text.find("NN") :]
            else:
                return bases

    def trimming_near(bases):
        return 20

    return short(short(out)[::-1])[::-1]


def test_edits_and_frames_against_marked_bases():
    draw = random.Random(7)
    for _ in range(600):
        n = draw.randrange(0, 160)
        seq = "".join(draw.choice("ACGT" * 6 + "N") for _ in range(n))
        cds = None
        if n > 30 and draw.random() < 0.8:
            b = draw.randrange(1, n - 20)
            cds = (b, draw.randrange(b + 6, n + 1))
            if draw.random() < 0.6:
                seq = seq[: b - 1] + "ATG" + seq[b + 2 :]
        spans, at = [], 1
        while at < n and len(spans) < 3 and draw.random() < 0.7:
            b = at + draw.randrange(0, 50)
            spans.append((b, b + draw.randrange(0, 40)))
            at = spans[-1][1] + 3
        if any(a[1] + 1 >= b[0] for a, b in zip(spans, spans[1:])):
            continue
        got = trimming.trimmed_row(seq, spans, cds)
        plain, filled = marked(seq, spans, cds, False), marked(seq, spans, cds, True)
        text, other = ("".join(b for b, _ in x) for x in (plain, filled))
        frame, found = best_orf(text), best_orf(other)
        old = (cds[1] - cds[0] + 1) // 3 if cds else 0
        cut_any = any(b <= n for b, _ in spans)
        gapped = cut_any and text and frame[5] < old and len(other) > len(text) and found[5] - (found[5] - found[0]) // 3 > frame[5]
        use = filled if gapped else plain
        assert got["seq"] == "".join(b for b, _ in use), (seq, spans, cds)
        places = [p for _, p in use]
        assert got["cut"] == n - sum(p is not None for p in places)
        held = [i for i, p in enumerate(places, 1) if cds and p is not None and cds[0] <= p <= cds[1]]
        assert (got["held_begin"], got["held_end"]) == ((held[0], held[-1]) if held else (None, None))
        assert got["in_frame"] == (cds[1] - cds[0] + 1 - len(held) if cds else 0)
        assert got["aa"] == (found if gapped else frame)[5]


def test_trim_rows(spark):
    rows = [(1, "A" * 30 + "ATG" + "GCC" * 30 + "TAA" + "C" * 20, 31, 126), (2, None, None, None), (3, "NNNACGTACGT", None, None), (4, "ACGT" * 5, 1, 20)]
    df = spark.createDataFrame(rows, "id long, seq string, cds_begin long, cds_end long").withColumn("kind", F.lit("clash"))
    hits = spark.createDataFrame([(1, 1, 32, "Strong"), (4, 1, 20, "Strong"), (9, 1, 5, "Strong")], "id long, begin long, end long, kind string")
    got = {r["id"]: r for r in trimming.trim_transcripts(df, trimming.vector_spans(hits)).collect()}
    assert (got[1]["seq"][:6], got[1]["state"], got[1]["held_begin"], got[1]["held_end"], got[1]["cut"], got[1]["in_frame"]) == ("ATGGCC", "plain", 1, 96, 30, 0)
    assert (got[2]["seq"], got[2]["state"], got[3]["seq"], got[4]["state"]) == ("", "allcut", "ACGTACGT", "allcut")
    assert trimming.trim_transcripts(df.limit(0), trimming.vector_spans(hits)).collect() == []


def test_whole_query_adds_up(spark, small):
    rows = QUERIES["flt12_trimmed_transcripts"](spark, small).collect()
    assert {"plain", "uncut"} <= {r["state"] for r in rows} and any(r["state"] == "gapped" for r in rows)
    for r in rows:
        assert r["frame_end"] is None or r["seq"][r["frame_begin"] - 1 : r["frame_end"]]
