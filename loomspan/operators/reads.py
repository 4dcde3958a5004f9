"""Aligned reads: counts per feature and group, CIGAR walks, statistics, tiles, wide count tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .intervals import overlap_pairs


def cigar_ops(cigar: Column) -> Column:
    """Array of (n, op) of a CIGAR string."""
    n = F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(1))
    op = F.regexp_extract_all(cigar, F.lit(r"(\d+)([MIDNSHP=X])"), F.lit(2))
    return F.zip_with(n, op, lambda a, b: F.struct(a.cast("long").alias("n"), b.alias("op")))


def _moves(ops: Column) -> Column:
    return F.aggregate(ops, F.lit(0).cast("long"), lambda at, x: at + F.when(x["op"].isin("M", "D", "N", "=", "X"), x["n"]).otherwise(0))


def blocks(reads: DataFrame, op: str = "M") -> DataFrame:
    """One row for each run of op: the read's columns, begin and end on the reference. reads: loc, cigar, ..."""
    ops = cigar_ops(F.col("cigar"))
    rows = reads.withColumn("_ops", ops).select("*", F.posexplode("_ops").alias("_i", "_x")).where(F.col("_x.op") == op)
    begin = F.col("loc") + _moves(F.slice("_ops", F.lit(1), F.col("_i")))
    return rows.withColumn("begin", begin).withColumn("end", F.col("begin") + F.col("_x.n") - 1).drop("_ops", "_i", "_x")


def introns(reads: DataFrame) -> DataFrame:
    """Counted introns: ref, begin, end, strand, reads. An intron is an N run of a CIGAR."""
    return blocks(reads, "N").groupBy("ref", "begin", "end", "strand").agg(F.count("*").alias("reads"))


def clipped(reads: DataFrame) -> DataFrame:
    """Sequences without soft-clipped ends; cigar keeps its other runs. Hard clips are dropped from the CIGAR."""
    head = F.coalesce(F.regexp_extract("cigar", r"^(?:\d+H)?(\d+)S", 1).try_cast("int"), F.lit(0))
    tail = F.coalesce(F.regexp_extract("cigar", r"(\d+)S(?:\d+H)?$", 1).try_cast("int"), F.lit(0))
    rows = reads.withColumn("seq", F.col("seq").substr(head + 1, F.greatest(F.lit(0), F.length("seq") - head - tail)))
    return rows.withColumn("cigar", F.regexp_replace("cigar", r"^(\d+H)?(\d+S)?|(\d+S)?(\d+H)?$", ""))


def counts_by_group(rows: DataFrame, feature: str, group: str, groups: list[str]) -> DataFrame:
    """One row a feature, a column for each group, missing counts 0."""
    return rows.groupBy(feature).pivot(group, groups).agg(F.count(F.lit(1))).na.fill(0, groups)


def pasted(tables: DataFrame, feature: str, group: str, value: str, groups: list[str]) -> DataFrame:
    """Long counts as a wide table, missing 0, with a last row '#TOTAL'."""
    sums = [F.sum(F.when(F.col(group) == g, F.col(value)).otherwise(0)).alias(g) for g in groups]
    rows = tables.withColumn(feature, F.col(feature).cast("string"))
    return rows.rollup(feature).agg(*sums, F.grouping(feature).alias("_all")).select(
        F.when(F.col("_all") == 1, "#TOTAL").otherwise(F.col(feature)).alias(feature), *groups
    )


def count_reads(reads: DataFrame, features: DataFrame, must_not: str | None = None) -> DataFrame:
    """Reads per feature; a read that touches a feature whose type matches must_not counts nowhere. reads: id, ref, begin, end."""
    pairs = overlap_pairs(reads, features)
    if must_not is not None:
        barred = pairs.where(F.col("b_type").rlike(must_not)).select("p_id").distinct()
        pairs = pairs.join(barred, "p_id", "left_anti")
    return pairs.groupBy("b_fid").agg(F.count_distinct("p_id").alias("reads"))


def filtered(reads: DataFrame, features: DataFrame, inside: bool = True) -> DataFrame:
    """Reads that overlap a feature, or those that overlap none."""
    ids = overlap_pairs(reads, features).select(F.col("p_id").alias("id")).distinct()
    return reads.join(ids, "id", "left_semi" if inside else "left_anti")


def statistics(reads: DataFrame) -> DataFrame:
    """Counters over flags (bits 1 paired, 2 proper, 4 unmapped, 16 reverse, 256 secondary), gaps and mates."""
    bit = lambda b: F.count_if(F.col("flag").bitwiseAND(b) != 0)
    return reads.agg(
        F.count("*").alias("reads"), bit(1).alias("paired"), bit(2).alias("proper"), bit(4).alias("unmapped"), bit(16).alias("reverse"), bit(256).alias("secondary"),
        F.count_if(F.col("cigar").contains("N")).alias("spliced"), F.count_if(F.col("cigar").rlike("[SH]")).alias("clipped"),
    )


def identity_reached(reads: DataFrame, least: int) -> DataFrame:
    """Reads whose share of aligned bases without a mismatch, rounded to percent, is at least least. reads: cigar, nm."""
    aligned = F.aggregate(cigar_ops(F.col("cigar")), F.lit(0).cast("long"), lambda a, x: a + F.when(x["op"].isin("M", "=", "X"), x["n"]).otherwise(0))
    percent = F.floor(100 * (aligned - F.coalesce("nm", F.lit(0))) / F.greatest(F.length("seq"), F.lit(1)) + 0.5)
    return reads.where(percent >= least)
