"""Gene repair: planted shifts, gaps, open ends and strands; places checked by reading the frames back from the scaffold."""

import random

from pyspark.sql import functions as F

from loomspan.functions.sequences import CODONS
from loomspan.operators import repair
from loomspan.plans.adapters import scaffold_genes, sequences

EXON = "gid long, exon_no long, ref string, strand string, begin long, end long, kind string, score long"
TURN = str.maketrans("ACGT", "TGCA")


def orf_brute(seq):
    """The frame with most amino acids: the first start after a stop, or the head of a frame, to the first stop or the tail."""
    every = []
    for frame in range(3):
        words = [seq[i : i + 3] for i in range(frame, len(seq) - 2, 3)]
        for i, word in enumerate(words):
            since = next((k for k in range(i - 1, -1, -1) if CODONS.get(words[k]) == "*"), -1)
            if i and (word != "ATG" or "ATG" in words[since + 1 : i]):
                continue
            stop = next((k for k in range(i, len(words)) if CODONS.get(words[k]) == "*"), None)
            end = len(words) if stop is None else stop + 1
            aa = end - i - (stop is not None)
            kind = ("complete" if stop is not None else "partial3") if word == "ATG" else ("partial5" if stop is not None else "partial")
            if aa >= 1:
                every.append((aa - 3 * sum("N" in w for w in words[i:end]), kind == "complete", frame + 3 * i, frame + 3 * end, kind, aa))
    return max(every, key=lambda f: (f[0], f[1], -f[2], -f[3]), default=(0, False, 0, 0, "", 0))


def test_best_frame_against_brute_force():
    draw = random.Random(2)
    for _ in range(1500):
        seq = "".join(draw.choice("ACGTN" if draw.random() < 0.1 else "ACGT") for _ in range(draw.randrange(0, 120)))
        assert repair.best_orf(seq) == orf_brute(seq), seq


def test_unknown_head():
    for seq, n in (("", 0), ("ACGT", 0), ("NACG", 1), ("NNNACG", 3), ("ACNNACGT", 4), ("A" * 20 + "NNAC", 22), ("A" * 21 + "NNAC", 0), ("NN" + "A" * 20 + "NNNC", 25), ("NN" + "A" * 21 + "NNNC", 2), ("ANA", 0), ("NNNN", 4)):
        assert repair.unknown_head(seq) == n, seq


def coding(draw, n):
    free = [c for c, a in CODONS.items() if a not in "*M"]
    while True:
        seq = "ATG" + "".join(draw.choice(free) for _ in range(n)) + "TAA"
        # each third is closed in the other two frames and on the other strand, so that no frame but the planted one goes through
        thirds = [seq[:90], seq[120:210], seq[240:330]]
        read = [(part, shift) for part in thirds for shift in (1, 2)] + [(part[::-1].translate(TURN), shift) for part in thirds for shift in (0, 1, 2)]
        if all(any(CODONS[part[i : i + 3]] == "*" for i in range(shift, len(part) - 2, 3)) for part, shift in read):
            return seq


def test_planted_faults_are_mended(spark):
    draw, exons, scaffolds, want = random.Random(7), [], [], {}
    for gid in range(48):
        whole = coding(draw, 119)
        cuts = [0, 120, 240, len(whole)]
        pieces = [whole[a:b] for a, b in zip(cuts, cuts[1:])]
        fault, strand = gid % 6, "+-"[gid % 2]
        seqs, moves = list(pieces), [0, 0, 0]
        if fault in (1, 2):  # one or two bases too many at the head of the second exon
            seqs[1], moves[1] = "TA"[:fault] + seqs[1], fault
        if fault == 3:  # the first exon begins with a gap
            seqs[0] = "N" * 12 + seqs[0]
            moves[0] = 12
        text, spans = "CTAGTTAACTAGC" * 12, []
        for s in seqs:
            spans.append((len(text) + 1, len(text) + len(s)))
            text += s + "GTAAGTTAGCTAGCTAACAG"
        text += "CTAGTTAACTAGC" * 12
        kept = [(b + m, e) for (b, e), m in zip(spans, moves)]
        if fault == 4:  # both ends are cut short
            spans[0], spans[-1] = (spans[0][0] + 30, spans[0][1]), (spans[-1][0], spans[-1][1] - 30)
        if fault == 5 and gid % 4 == 1:  # one exon in two touching pieces
            b, e = spans[1]
            spans[1:2] = [(b, b + 49), (b + 53, e)]
        if strand == "-":
            n = len(text)
            text = text[::-1].translate(TURN)
            spans, kept = [(n - e + 1, n - b + 1) for b, e in spans], [(n - e + 1, n - b + 1) for b, e in kept]
        scaffolds.append((f"s{gid}", text))
        shown = "." if gid % 5 == 0 else strand
        exons += [(gid, k, f"s{gid}", shown, b, e, "exon", 0) for k, (b, e) in enumerate(sorted(spans), 1)]
        want[gid] = (strand, whole, sorted(kept))
    df = spark.createDataFrame(exons, EXON)
    held = spark.createDataFrame(scaffolds, "ref string, seq string")
    rows = repair.repair(df, held, block=64)
    cds = {r["gid"]: r["cds"] for r in repair.coding_sequences(rows, held, block=64).collect()}
    got = {}
    for r in rows.collect():
        got.setdefault(r["gid"], []).append(r)
    assert set(got) == set(want)
    for gid, (strand, whole, kept) in want.items():
        mine = sorted(got[gid], key=lambda r: r["begin"])
        assert {r["strand"] for r in mine} == {strand}, gid
        assert cds[gid] == whole and {(r["kind"], r["aa"]) for r in mine} == {("complete", 120)}, gid
        fixes = set(mine[0]["fixes"].split(",")) - {""}
        assert fixes == {1: {"edge"}, 2: {"edge"}, 3: {"gap"}, 4: {"open"}, 5: {"merge"} if gid % 4 == 1 else set()}.get(gid % 6, set()) | ({"strand"} if gid % 5 == 0 else set()), gid
        if gid % 6 != 4:
            assert [(r["begin"], r["end"]) for r in mine] == kept, gid


def test_fetched_spans(spark):
    draw = random.Random(1)
    text = "".join(draw.choice("ACGT") for _ in range(501))
    held = spark.createDataFrame([("a", text), ("b", ""), ("c", None)], "ref string, seq string")
    spans = [(i, draw.choice("abx"), b := draw.randrange(-20, 520), b + draw.randrange(0, 200)) for i in range(80)]
    got = {r["key"]: r["seq"] for r in repair.fetched(spark.createDataFrame(spans, "key int, ref string, begin long, end long"), repair.blocks(held, 50), 50).collect()}
    assert got == {k: (text[max(0, b - 1) : max(0, e)] or None) if r == "a" else None for k, r, b, e in spans}


def test_whole_query_reads_its_frames_back(spark, small):
    """Every frame of the query, read from the scaffolds by its places, is open and has the length it is said to have."""
    scaffolds = sequences(spark, small).select(F.col("id").cast("string").alias("ref"), "seq")
    genes = scaffold_genes(spark, small).withColumn("ref", F.col("ref").cast("string"))
    rows = repair.repair(genes, scaffolds)
    told = {r["gid"]: (r["aa"], r["kind"]) for r in rows.select("gid", "aa", "kind").distinct().collect()}
    cds = {r["gid"]: r["cds"] for r in repair.coding_sequences(rows, scaffolds).collect()}
    assert len(told) == genes.select("gid").distinct().count() and any("edge" in r["fixes"] for r in rows.select("fixes").distinct().collect())
    for gid, (aa, kind) in told.items():
        words = [cds[gid][i : i + 3] for i in range(0, len(cds[gid]), 3)]
        stopped = kind in ("complete", "partial5")
        assert len(cds[gid]) % 3 == 0 and len(words) == aa + stopped
        assert [CODONS[w] == "*" for w in words] == [False] * aa + [True] * stopped
        assert (words[0] == "ATG") or kind in ("partial5", "partial")
