"""Best gene models, in full: drop rules before, joins last, coding overlap, then transcript overlap, alternates exempt.

The rule is a walk by score; a model's verdict hangs on the kept ones above it that it overlaps. More kept models can only turn
a verdict from kept to dropped, so bounds decide it: dropped if those known to be kept suffice, kept if all that may still be
kept don't. Rounds of joins over the pairs of overlapping models go on until all are decided.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.session import cut

from .intervals import overlap_pairs

_ROWS = "array<bigint>"


def _pairs(exons: DataFrame, ranked: DataFrame) -> DataFrame:
    """(winner, gid, coding, bases, rows): what exons of a higher model share with those of a lower one.

    coding: bases of CDS rows in CDS rows, rows: the lower one's CDS rows among them; bases: of any rows on one strand.
    """
    rows = exons.select("gid", "exon_no", "ref", "strand", "begin", "end", "kind").join(ranked.select("gid", "place"), "gid")
    both = overlap_pairs(rows, rows).where("p_place < b_place")
    coding = (F.col("p_kind") == "CDS") & (F.col("b_kind") == "CDS")
    strand = (F.col("p_strand") == F.col("b_strand")) | (F.col("p_strand") == ".") | (F.col("b_strand") == ".")
    return both.groupBy(F.col("p_gid").alias("winner"), F.col("b_gid").alias("gid")).agg(
        F.sum(F.when(coding, F.col("overlap")).otherwise(0)).alias("coding"), F.sum(F.when(strand, F.col("overlap")).otherwise(0)).alias("bases"),
        F.collect_set(F.when(coding, F.col("b_exon_no").cast("long"))).alias("rows"),
    )


def _dropped(coding: Column, bases: Column, rows: Column, trivial: float, utr_most: float, alternates: bool) -> Column:
    """Whether so much overlap drops a model of cds, utr (bases), n_cds (rows) and lenient (no second test)."""
    first = coding > trivial * F.col("cds")
    second = ~F.col("lenient") & (bases >= 30) & (bases > utr_most * F.col("utr"))
    over = first | second
    return over & (F.size(rows) >= F.col("n_cds")) if alternates else over


def select_models(
    exons: DataFrame, totals: DataFrame, trivial: float = 0.1, utr_most: float = 0.20, utr_share: float = 0.20, long_cds: int = 400, utr_big: float = 0.60,
    good_score: float = 300, alternates: bool = False,
) -> DataFrame:
    """gid, total, last, kept, alternate, coding and bases (taken from it by kept models) of every model in totals.

    exons: gid, exon_no, ref, strand, begin, end, kind ('CDS' or not); those of other models are passed over. totals: gid, total, last (true for models to be looked at
    after all others: suspected joins). Models go by total, then place, then gid. One is dropped if kept ones cover more than a share
    `trivial` of its coding bases, or else if they cover 30 bases or more of its transcript and more than `utr_most` of its
    untranslated bases; this second test spares models with hardly any of these (under utr_share of the transcript), and those
    of long_cds coding bases or more, under utr_big untranslated ones and a total above good_score. With alternates a model stays,
    marked, while one of its CDS rows is free of kept ones.
    """
    size = F.col("end") - F.col("begin") + 1
    spans = exons.groupBy("gid").agg(
        F.sum(F.when(F.col("kind") == "CDS", size).otherwise(0)).alias("cds"), F.count_if(F.col("kind") == "CDS").alias("n_cds"), F.sum(size).alias("length"),
        F.min("begin").alias("begin"), F.max("end").alias("end"),
    )
    utr = F.greatest(F.lit(1), F.col("length") - F.col("cds"))
    lenient = (F.lit(utr_most >= 1)) | (utr < utr_share * F.col("length")) | ((F.col("cds") >= long_cds) & (utr < utr_big * F.col("length")) & (F.col("total") > good_score))
    genes = spans.join(totals.select("gid", "total", F.coalesce("last", F.lit(False)).alias("last")), "gid")
    place = F.struct("last", (-F.col("total")).alias("minus"), "begin", "end", "gid")
    genes = cut(genes.select("gid", "total", "last", "cds", "n_cds", utr.alias("utr"), lenient.alias("lenient"), place.alias("place")))
    pairs = edges = cut(_pairs(exons, genes))
    sums = lambda p: [F.sum("coding").alias(f"{p}coding"), F.sum("bases").alias(f"{p}bases"), F.array_distinct(F.flatten(F.collect_list("rows"))).alias(f"{p}rows")]
    zero, none = F.lit(0).cast("long"), F.array().cast(_ROWS)
    held = ["gid", "cds", "n_cds", "utr", "lenient"]
    left = genes.select(*held, zero.alias("coding"), zero.alias("bases"), none.alias("rows"))
    decided = None
    test = lambda a, b, c: _dropped(a, b, c, trivial, utr_most, alternates)
    while True:
        waiting = edges.groupBy("gid").agg(*sums("w_"))
        more = [F.col("coding") + F.coalesce("w_coding", zero), F.col("bases") + F.coalesce("w_bases", zero), F.array_union("rows", F.coalesce("w_rows", none))]
        verdict = F.when(~test(*more), True).when(test(F.col("coding"), F.col("bases"), F.col("rows")), False)
        told = cut(left.join(waiting, "gid", "left").select(*held, "coding", "bases", "rows", verdict.alias("kept")))
        done = told.where("kept is not null").select("gid", "kept")
        decided = done if decided is None else decided.union(done)
        left = told.where("kept is null").drop("kept")
        if left.isEmpty():
            break
        known = told.select(F.col("gid").alias("winner"), F.col("kept").alias("won"))
        edges = cut(edges.join(left.select("gid"), "gid", "left_semi").join(known, "winner"))
        won = edges.where("won").groupBy("gid").agg(*sums("w_"))
        grown = [(F.col(c) + F.coalesce(f"w_{c}", zero)).alias(c) for c in ("coding", "bases")]
        left = left.join(won, "gid", "left").select(*held, *grown, F.array_union("rows", F.coalesce("w_rows", none)).alias("rows"))
        edges = edges.where("won is null").drop("won")
    winners = decided.where("kept").select(F.col("gid").alias("winner"))
    taken = pairs.join(winners, "winner", "left_semi").groupBy("gid").agg(F.sum("coding").alias("coding"), F.sum("bases").alias("bases"))
    rows = genes.join(decided, "gid").join(taken, "gid", "left").fillna(0, ["coding", "bases"])
    over = _dropped(F.col("coding"), F.col("bases"), none, trivial, utr_most, False)
    return rows.select("gid", "total", "last", "kept", (F.col("kept") & over).alias("alternate"), "coding", "bases")
