"""Gene repair on scaffold sequences: gaps at the ends, exon edges that break the frame, open ends, unknown strands.

Scaffolds are dealt into blocks of bases, so that a span is fetched by an equi-join and no task holds a scaffold. What follows
needs one gene at a time: a row holds its exons' bases and a flank on either side, and a small search in it decides.
"""

from __future__ import annotations

from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.functions.sequences import _MARKS, CODONS, _frames, reverse_complement

from .genes import joined_exons

#: Bases looked at beyond an open end, and how far a frame may end from the transcript's end and still count as open.
FLANK, SLOP = 270, 27
#: Runs of unknown bases nearer than this to an end, or to one another, go together.
NEAR = 20
#: Amino acids that a frame must gain before exon edges move.
GAIN = 3


def blocks(scaffolds: DataFrame, size: int = 10_000) -> DataFrame:
    """Sequences in blocks: ref, block (from 0), bases. scaffolds: ref, seq."""
    last = F.floor((F.length("seq") - 1) / size)
    rows = scaffolds.where(F.length("seq") > 0).select("ref", "seq", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("block"))
    return rows.select("ref", "block", F.col("seq").substr((F.col("block") * size + 1).cast("int"), F.lit(size)).alias("bases"))


def fetched(spans: DataFrame, held: DataFrame, size: int = 10_000) -> DataFrame:
    """spans (key, ref, begin, end) with seq, their bases on the + strand: what lies on the scaffold, null where nothing does.

    held: blocks of that size. A span meets only the blocks it touches; its pieces are put together by their order.
    """
    whole = spans.select("key", "ref", F.greatest("begin", F.lit(1)).alias("begin"), "end").where("end >= begin")
    rows = whole.withColumn("block", F.explode(F.sequence(F.floor((F.col("begin") - 1) / size), F.floor((F.col("end") - 1) / size))))
    first = F.greatest(F.col("begin") - F.col("block") * size, F.lit(1))
    last = F.least(F.col("end") - F.col("block") * size, F.lit(size))
    pieces = rows.join(held, ["ref", "block"]).select("key", F.struct("block", F.col("bases").substr(first.cast("int"), (last - first + 1).cast("int")).alias("s")).alias("p"))
    seqs = pieces.groupBy("key").agg(F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["s"]), "").alias("seq"))
    return spans.join(seqs, "key", "left")


def unknown_head(seq: str) -> int:
    """Bases to cut at the head: up to the last run of two or more N (one at the very head) that lies near the head or the run before."""
    end, at = 0, 0 if seq.startswith("N") else seq.find("NN")
    while at >= 0 and at <= end + NEAR:
        end = at
        while end < len(seq) and seq[end] == "N":
            end += 1
        at = seq.find("NN", end)
    return end


def best_orf(seq: str) -> tuple:
    """(good, complete, begin, end, kind, aa): the frame of the + strand with most amino acids, unknown ones counting three against it.

    Of equal ones a complete one, then the earlier. begin and end from 0, open; without a frame all is 0.
    """
    none = (0, False, 0, 0, "", 0)
    if "N" in seq:
        found = [(aa - 3 * xs, kind == "complete", begin - 1, end, kind, aa) for _, _, begin, end, kind, aa, xs in _frames(seq, 1, "+")]
        return max(found, key=lambda f: (f[0], f[1], -f[2], -f[3]), default=none)
    # without unknown bases the longest is looked for as the marks come: no list of all frames
    best, longest = none, 1
    heads, starts = [True] * 3, [None] * 3
    size = len(seq)
    marks = [(m.start(), m.group() == "T") for m in _MARKS.finditer(seq)]
    for at, stop in chain(marks, ((size - (size - k) % 3, None) for k in range(3))):
        k = at % 3
        if stop is False:
            if starts[k] is None:
                starts[k] = at
            continue
        head, start = heads[k], starts[k]
        heads[k], starts[k] = False, None
        low = k if head else start
        if low is None or at - low < 3 * longest:
            continue
        last = at + 3 if stop else at
        for begin, kind in ((start, "complete" if stop else "partial3"), (k if head and start != k else None, "partial5" if stop else "partial")):
            if begin is not None and at - begin >= 3 * longest:
                aa = (at - begin) // 3
                new = (aa, kind == "complete", begin, last, kind, aa)
                if (aa, new[1], -begin, -last) > (best[0], best[1], -best[2], -best[3]):
                    best, longest = new, aa
    return best


def most_amino(seq: str) -> int:
    """best_orf's first part alone."""
    if "N" in seq:
        return best_orf(seq)[0]
    most, begins, size = 0, [0, 1, 2], len(seq)
    for m in _MARKS.finditer(seq):
        at = m.start()
        k = at % 3
        begin = begins[k]
        if begin is None:
            if seq[at] == "A":
                begins[k] = at
        elif seq[at] == "T":
            if at - begin > most:
                most = at - begin
            begins[k] = None
    for k in range(3):
        if begins[k] is not None:
            most = max(most, size - (size - k) % 3 - begins[k])
    return most // 3


def protein(seq: str) -> str:
    return "".join(CODONS.get(seq[i : i + 3], "X") for i in range(0, len(seq) - 2, 3)).rstrip("*")


def mended(seqs: list[str], before: str, after: str) -> dict:
    """One gene in the order of transcription: cuts at the exons' heads and tails (below 0: the end moves out), the frame and what was done.

    before and after: the bases beyond its ends.
    """
    fixes, heads, tails = [], [0] * len(seqs), [0] * len(seqs)
    for cut, order, turn in ((heads, range(len(seqs)), 1), (tails, range(len(seqs) - 1, -1, -1), -1)):
        for k in order:
            left = seqs[k][heads[k] : len(seqs[k]) - tails[k]]
            n = unknown_head(left[::turn])
            cut[k] += n
            if n:
                fixes.append("gap")
            if n < len(left):
                break
    parts = [s[h : len(s) - t] for s, h, t in zip(seqs, heads, tails)]
    frame = best_orf("".join(parts))

    # move the edges of exons by a base or two where the frame gains by it, one exon after the other
    moved, grown = [], ""
    for k, part in enumerate(parts):
        j = 0
        if grown and len(part) > 3:
            _, j = max((most_amino(grown + part[j:]), -j) for j in (0, 1, 2))
        moved.append(-j)
        grown += part[-j:]
    if any(moved):
        other = best_orf(grown)
        if other[5] >= frame[5] + GAIN:
            heads = [h + j for h, j in zip(heads, moved)]
            parts, frame = [p[j:] for p, j in zip(parts, moved)], other
            fixes.append("edge")

    # look beyond ends at which the frame is open
    cdna, kind = "".join(parts), frame[4]
    before = before if kind in ("partial5", "partial") and frame[2] <= SLOP and not heads[0] > 0 else ""
    after = after if kind in ("partial3", "partial") and len(cdna) - frame[3] <= SLOP and not tails[-1] > 0 else ""
    if cdna and (before or after):
        wide = best_orf(before + cdna + after)
        begin, end = wide[2] - len(before), wide[3] - len(before)
        old = protein(cdna[frame[2] : frame[3]])
        same = old[2:] in protein((before + cdna + after)[wide[2] : wide[3]])
        if wide[5] > frame[5] and same and end >= frame[3] - SLOP and begin <= frame[2] + SLOP:
            out = min(len(before), max(0, 3 - begin)) if begin < 0 else 0
            far = min(len(after), max(0, end + 3 - len(cdna))) if end > len(cdna) else 0
            heads[0], tails[-1] = heads[0] - out, tails[-1] - far
            frame = (*wide[:2], begin + out, end + out, *wide[4:])
            fixes.append("open")
    return {"heads": heads, "tails": tails, "good": frame[0], "begin": frame[2], "end": frame[3], "kind": frame[4], "aa": frame[5], "fixes": sorted(set(fixes))}


_MENDED = "strand string, heads array<int>, tails array<int>, frame_begin int, frame_end int, kind string, aa int, fixes array<string>"


def _mend(strand: pd.Series, exons: pd.Series, before: pd.Series, after: pd.Series) -> pd.DataFrame:
    """exons: bases on the + strand in place order; before and after lie left and right of them."""
    out = []
    turned = str.maketrans("ACGT", "TGCA")
    for known, seqs, left, right in zip(strand, exons, before, after):
        both = []
        for s in ("+", "-"):
            if known in (s, "."):
                if s == "+":
                    given = [x.upper() for x in seqs], left.upper(), right.upper()
                else:
                    given = [x.upper()[::-1].translate(turned) for x in seqs[::-1]], right.upper()[::-1].translate(turned), left.upper()[::-1].translate(turned)
                found = mended(*given)
                both.append((found["good"], s == "+", s, found))
        *_, s, found = max(both, key=lambda x: x[:2])
        fixes = found["fixes"] + (["strand"] if known == "." else [])
        out.append((s, found["heads"], found["tails"], found["begin"], found["end"], found["kind"], found["aa"], fixes))
    return pd.DataFrame(out, columns=[c.split()[0] for c in _MENDED.split(", ")])


def _shifted(rows: DataFrame) -> DataFrame:
    """Exons with their edges moved: one row an exon, in order of transcription, with the transcript offset before it."""
    minus = F.col("m.strand") == "-"
    ordered = F.when(minus, F.reverse("xs")).otherwise(F.col("xs"))
    # a plain explode has rows without exons filtered out before it, and the genes mended twice for that
    rows = rows.select("gid", "ref", "m.*", ordered.alias("xs")).select("*", F.posexplode_outer("xs").alias("k", "x"))
    head, tail = F.get("heads", F.col("k")), F.get("tails", F.col("k"))
    minus = F.col("strand") == "-"
    rows = rows.select("*", (F.col("x.begin") + F.when(minus, tail).otherwise(head)).alias("begin"), (F.col("x.end") - F.when(minus, head).otherwise(tail)).alias("end"))
    size = lambda i: F.greatest(F.lit(0), F.get("xs", i)["end"] - F.get("xs", i)["begin"] + 1 - F.get("heads", i) - F.get("tails", i))
    upto = F.aggregate(F.sequence(F.lit(0), F.col("k")), F.lit(0).cast("long"), lambda a, i: a + size(i))
    return rows.withColumn("upto", upto).where("end >= begin")


def repair(exons: DataFrame, scaffolds: DataFrame, least_intron: int = 10, block: int = 10_000) -> DataFrame:
    """Exons of mended genes: gid, ref, strand, begin, end, cds_begin, cds_end (null outside the frame), kind, aa, fixes.

    exons: gid, exon_no, ref, strand ('.' where unknown), begin, end, kind, score. scaffolds: ref, seq. In this order: exons with
    hardly an intron between them become one (merge); unknown bases go at the outer ends (gap); edges of exons move by one or
    two bases where that lengthens the longest frame by GAIN amino acids or more (edge); a frame that is open at an end goes on
    into the flank if the protein it had stays in it (open); genes of unknown strand take the one with the better frame (strand).
    Genes whose scaffold is missing have no row; letters other than ACGT count as unknown.
    """
    joined = joined_exons(exons.where("gid is not null"), least_intron)  # said here, so that all uses below share one shuffle
    span = F.struct("begin", "end", "parts")
    genes = joined.groupBy("gid", "ref", "strand").agg(F.sort_array(F.collect_list(span)).alias("xs"), F.max("parts").alias("parts"))
    ends = F.array(
        F.struct(F.lit("L").alias("side"), (F.element_at("xs", 1)["begin"] - FLANK).alias("begin"), (F.element_at("xs", 1)["begin"] - 1).alias("end")),
        F.struct(F.lit("R").alias("side"), (F.array_max("xs.end") + 1).alias("begin"), (F.array_max("xs.end") + FLANK).alias("end")),
    )
    wanted = F.concat(F.transform("xs", lambda x: F.struct(F.lit("X").alias("side"), x["begin"].alias("begin"), x["end"].alias("end"))), ends)
    spans = genes.select("gid", "ref", F.explode(wanted).alias("w")).select(F.struct("gid", "w.side", "w.begin").alias("key"), "ref", "w.begin", "w.end")
    bases = fetched(spans, blocks(scaffolds, block), block).where("seq is not null")
    clean = F.regexp_replace(F.upper("seq"), "[^ACGT]", "N")
    bases = bases.select("key.gid", F.struct("key.side", "key.begin", clean.alias("s")).alias("b")).groupBy("gid").agg(F.sort_array(F.collect_list("b")).alias("b"))
    side = lambda name: F.transform(F.filter("b", lambda x: x["side"] == name), lambda x: x["s"])
    rows = genes.join(bases, "gid").select("gid", "ref", "strand", "xs", "parts", side("X").alias("seqs"), F.array_join(side("L"), "").alias("l"), F.array_join(side("R"), "").alias("r"))
    whole = F.size("seqs") == F.size("xs")  # an exon beyond the scaffold's end has no bases
    mend = rows.where(whole).select("gid", "ref", "xs", "parts", F.pandas_udf(_mend, _MENDED)("strand", "seqs", "l", "r").alias("m"))
    return _placed(_shifted(mend.select("gid", "ref", "xs", F.struct("m.strand", "m.heads", "m.tails", "m.frame_begin", "m.frame_end", "m.kind", "m.aa", _noted(F.col("m.fixes"), F.col("parts")).alias("fixes")).alias("m"))))


def _noted(fixes: Column, parts: Column) -> Column:
    return F.array_join(F.sort_array(F.concat(fixes, F.when(parts > 1, F.array(F.lit("merge"))).otherwise(F.array().cast("array<string>")))), ",")


def _placed(rows: DataFrame) -> DataFrame:
    """The part of each exon that the frame covers, at its place."""
    size = F.col("end") - F.col("begin") + 1
    before = F.col("upto") - size
    first = F.greatest(F.lit(0), F.col("frame_begin") - before)  # offsets in the exon, open at the end
    last = F.least(size, F.col("frame_end") - before)
    minus, held = F.col("strand") == "-", last > first
    low = F.when(minus, F.col("end") - last + 1).otherwise(F.col("begin") + first)
    high = F.when(minus, F.col("end") - first).otherwise(F.col("begin") + last - 1)
    return rows.select("gid", "ref", "strand", "begin", "end", F.when(held, low).alias("cds_begin"), F.when(held, high).alias("cds_end"), "kind", "aa", "fixes")


def coding_sequences(cds: DataFrame, scaffolds: DataFrame, block: int = 10_000) -> DataFrame:
    """gid and cds, the bases of its pieces in order of transcription. cds: rows of repair()."""
    pieces = cds.where("cds_begin is not null").select(F.struct("gid", "strand", F.col("cds_begin").alias("begin")).alias("key"), "ref", F.col("cds_begin").alias("begin"), F.col("cds_end").alias("end"))
    rows = fetched(pieces, blocks(scaffolds, block), block).select("key.gid", "key.strand", F.struct("begin", F.col("seq")).alias("p"))
    rows = rows.groupBy("gid", "strand").agg(F.upper(F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda p: p["seq"]), "")).alias("s"))
    return rows.select("gid", F.when(F.col("strand") == "-", reverse_complement(F.col("s"))).otherwise(F.col("s")).alias("cds"))
