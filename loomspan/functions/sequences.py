"""Nucleotide and protein sequences: complements, translation, reading frames, coding measures.

Plain measures are column expressions. Reading frames need walks over codons and run in an Arrow UDF.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from itertools import product

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The universal code, in TCAG order of its codons.
BASES = "TCAG"
AMINO = "FFLLSSSSYY**CC*WLLLLPPPPHHQQRRRRIIIMTTTTNNKKSSRRVVVVAAAADDEEGGGG"
CODONS = {"".join(c): a for c, a in zip(product(BASES, repeat=3), AMINO)}
#: Two bases that settle the amino acid whatever the third: CTN is L.
PARTIAL = {pair: CODONS[pair + "A"] for pair in map("".join, product(BASES, repeat=2)) if len({CODONS[pair + b] for b in BASES}) == 1}
#: One codon an amino acid, the first of its sort order.
BACK = {a: min(c for c, x in CODONS.items() if x == a) for a in sorted(set(AMINO))}


def reverse_complement(seq: Column) -> Column:
    """Complement of ACGT and of the codes Y, R, K, M, in reverse; other letters stay."""
    return F.reverse(F.translate(seq, "ACGTacgtyrkm", "TGCAtgcarymk"))


def _amino_array() -> Column:
    """Amino acids at the numbers that codons make when TCAGN and all else are the digits 0 to 5."""
    known = {**CODONS, **{pair + "N": a for pair, a in PARTIAL.items()}}
    table = ["X"] * 556
    for codon, amino in known.items():
        table[int("".join(str("TCAGN".index(b)) for b in codon))] = amino
    return F.array(*map(F.lit, table))


def codons(seq: Column) -> Column:
    """The codons of frame 1; a short tail is nothing."""
    return F.regexp_extract_all(seq, F.lit("(?s)(...)"), F.lit(1))


def translate(seq: Column, frame: int = 1) -> Column:
    """Protein of frame 1, 2 or 3, or -1, -2, -3 on the other strand. Unknown codons are X, a short tail is nothing."""
    s = F.upper(seq if frame > 0 else reverse_complement(seq))
    s = F.translate(F.regexp_replace(F.substring(s, abs(frame), 1 << 30), "(?s)[^TCAGN]", "X"), "TCAGNX", "012345")
    table = _amino_array()
    return F.array_join(F.transform(codons(s), lambda c: F.get(table, c.cast("int"))), "")


def back_translate(protein: Column) -> Column:
    """A coding sequence of a protein; unknown letters give NNN."""
    table = F.create_map(*[F.lit(x) for pair in BACK.items() for x in pair])
    return F.array_join(F.transform(F.split(protein, ""), lambda a: F.coalesce(table[a], F.when(a == "", "").otherwise(F.lit("NNN")))), "")


def letter_count(seq: Column, letters: str) -> Column:
    return F.length(seq) - F.length(F.translate(seq, letters, ""))


def sizes(seq: Column) -> list[Column]:
    """Length without gaps, gaps (N or X) and GC share."""
    gaps = letter_count(seq, "NXnx")
    gc = F.round(letter_count(seq, "GCgc") / F.greatest(F.length(seq) - gaps, F.lit(1)), 6)
    return [(F.length(seq) - gaps).cast("long").alias("bases"), gaps.cast("long").alias("gaps"), gc.alias("gc")]


_ORF = "array<struct<strand: string, frame: int, begin: int, end: int, complete: string, aa: int, xs: int>>"


#: Where codons of interest begin: a stop (T) or the start (A). One character is taken, so that overlapping ones are found.
_MARKS = re.compile("T(?=A[AG]|GA)|A(?=TG)")
_TURNED = str.maketrans("ACGT", "TGCA")


def _frames(seq: str, least: int, strands: str = "+-") -> list[tuple]:
    """Reading frames of the strands: from a start (or the sequence's head) to a stop (or its tail)."""
    out = []
    for strand in strands:
        s = seq if strand == "+" else seq[::-1].translate(_TURNED)
        unknown = "N" in s
        # a frame's stops, and the first start since the stop before; one pass over the bases, steps at starts and stops alone
        ends, starts, first = ([], [], []), ([], [], []), [None, None, None]
        for m in _MARKS.finditer(s):
            at = m.start()
            k = at % 3
            if s[at] == "T":
                ends[k].append(at)
                starts[k].append(first[k])
                first[k] = None
            elif first[k] is None:
                first[k] = at
        for frame in range(3):
            size = frame + max(0, len(s) - frame) // 3 * 3  # where its whole codons end
            i, head = frame, True
            for end, start in zip([*ends[frame], None], [*starts[frame], first[frame]]):
                stop = size if end is None else end
                if i >= size:
                    break
                last = stop if end is None else stop + 3
                for begin, whole in ((start, True), (i if head and start != i else None, False)):
                    if begin is None or (stop - begin) // 3 < least:
                        continue
                    kind = ("partial3" if end is None else "complete") if whole else ("partial" if end is None else "partial5")
                    xs = sum("N" in s[c : c + 3] for c in range(begin, last, 3)) if unknown and s.find("N", begin, last) >= 0 else 0
                    out.append((strand, frame + 1, begin + 1, last, kind, (stop - begin) // 3, xs))
                i, head = last, False
    return out


def open_frames(least: int = 30):
    """Arrow UDF: all open reading frames of at least so many amino acids. Places count from 1 on the frame's strand."""

    @F.pandas_udf(_ORF)
    def run(seq: pd.Series) -> pd.Series:
        names = ("strand", "frame", "begin", "end", "complete", "aa", "xs")
        return seq.map(lambda s: [dict(zip(names, x)) for x in _frames((s or "").upper(), least)])

    return run


def best_frame(rows: DataFrame, key: str, share: float = 0.85) -> DataFrame:
    """The longest frame of each key, unknowns counting three against it; a complete one wins at share of the longest.

    rows: key, seq. Ties go to the + strand, then to the earlier place.
    """
    each = rows.select(key, F.length("seq").alias("length"), F.explode(open_frames()(F.col("seq"))).alias("o")).select(key, "length", "o.*")
    good = F.col("aa") - 3 * F.col("xs")
    by = Window.partitionBy(key)
    each = each.withColumn("good", good).withColumn("longest", F.max("good").over(by))
    wins = (F.col("complete") == "complete") & (F.col("good") >= share * F.col("longest"))
    rank = F.row_number().over(by.orderBy(F.desc(wins.cast("int")), F.desc("good"), "strand", "begin", "frame"))
    return each.withColumn("rank", rank).where("rank = 1").drop("rank", "longest")


def protein_grade(aa: Column, length: Column, complete: Column) -> list[Column]:
    """Coding percent of the transcript and the grade: completeness, then -utrbad or -utrpoor."""
    pct = F.floor(100 * 3 * aa / F.greatest(length, F.lit(1)) + 0.5).cast("long")
    grade = F.concat(complete, F.when(pct < 35, "-utrbad").when(pct < 60, "-utrpoor").otherwise(""))
    return [pct.alias("pcds"), grade.alias("grade")]


def quality_score(grade: Column, pcds: Column) -> Column:
    """-3 to 3: complete and well filled is best, partial with bad ends worst."""
    base = F.when(grade.startswith("complete"), 2).when(grade.startswith("partial5") | grade.startswith("partial3"), 0).otherwise(-1)
    return base + F.when(grade.endswith("utrbad"), -2).when(grade.endswith("utrpoor"), -1).when(pcds >= 70, 1).otherwise(0)


def _words(seqs: pd.Series) -> pd.DataFrame:
    found = [Counter(s[i : i + 6] for i in range(0, len(s) - 5, 3)) for s in seqs]
    return pd.DataFrame({"hexamer": [list(c) for c in found], "n": [list(c.values()) for c in found]})


def hexamer_counts(rows: DataFrame, key: str) -> DataFrame:
    """(key, hexamer, n): in-frame six-base words of each row, counted within it; rows of one key are not put together."""
    words = F.pandas_udf(_words, "hexamer array<string>, n array<bigint>").asNondeterministic()
    held = rows.where("seq is not null").select(key, words("seq").alias("x"))
    return held.select(key, F.explode(F.arrays_zip("x.hexamer", "x.n")).alias("x")).select(key, "x.hexamer", "x.n")


def hexamers(rows: DataFrame, key: str) -> DataFrame:
    """(key, hexamer, n): in-frame six-base words."""
    return hexamer_counts(rows, key).groupBy(key, "hexamer").agg(F.sum("n").alias("n"))


def hexamer_scores(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Mean log ratio of the known hexamers of each sequence. table: hexamer, ratio (at most 4,096 rows)."""
    known = hexamer_counts(rows, key).join(F.broadcast(table), "hexamer")
    return known.groupBy(key).agg(F.round(F.sum(F.col("n") * F.col("ratio")) / F.sum("n"), 6).alias("score"))


def position_asymmetry(seq: Column) -> list[Column]:
    """Per base: largest over smallest count among the three codon places (plus 1), to six decimals."""
    out = []
    for b in "ACGT":
        n = [F.length(F.regexp_replace(F.regexp_replace(seq, f"(?s)({'.' * k})({'.'})({'.' * (2 - k)})|.+", "$2"), f"[^{b}]", "")) for k in range(3)]
        out.append(F.round(F.greatest(*n) / (F.least(*n) + 1), 6).alias(f"asym_{b.lower()}"))
    return out


def coding_class(score: Column, low: float = 0.74, high: float = 0.95) -> Column:
    return F.when(score < low, "Noncode").when(score >= high, "Code").otherwise("Unknown")


def consensus_class(*calls: Column) -> Column:
    """The class most calls agree on; Unknown without a majority."""
    votes = lambda name: sum(((F.coalesce(c, F.lit("")) == name).cast("int") for c in calls), F.lit(0))
    need = len(calls) // 2 + 1
    return F.when(votes("Code") >= need, "Code").when(votes("Noncode") >= need, "Noncode").otherwise("Unknown")


def extracted(seq: Column, begin: Column, end: Column, strand: Column) -> Column:
    """seq from begin to end (from 1, closed), reversed and complemented on the - strand."""
    part = seq.substr(begin, end - begin + 1)
    return F.when(strand == "-", reverse_complement(part)).otherwise(part)


def trimmed(seq: Column) -> Column:
    """Without N at both ends."""
    return F.regexp_replace(seq, "^[Nn]+|[Nn]+$", "")


def n50(lengths: DataFrame, column: str = "length") -> DataFrame:
    """One row: n, total and the length at which sorted lengths reach half of the total. Equal lengths count as one row."""
    counts = lengths.groupBy(column).agg(F.count("*").alias("c"))
    order = Window.orderBy(F.desc(column))  # over distinct lengths
    run = counts.withColumn("upto", F.sum(F.col("c") * F.col(column)).over(order)).withColumn("total", F.sum(F.col("c") * F.col(column)).over(Window.partitionBy()))
    n = F.sum("c").over(Window.partitionBy())
    run = run.withColumn("n", n).where(2 * F.col("upto") >= F.col("total"))
    return run.groupBy().agg(F.max("n").alias("n"), F.max("total").alias("total"), F.max(column).alias("n50"))


_ROUND = re.compile(r"e([+-])0*(\d)")


def three_digits(x: float) -> str:
    """A number with three significant digits, as text."""
    return "0" if x == 0 or math.isnan(x) else _ROUND.sub(r"e\1\2", f"{x:.3g}")
