"""Predictions against known genes, replacements in gene sets, and the classes that annotations give."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import overlap_pairs


def matched_models(predicted: DataFrame, known: DataFrame) -> DataFrame:
    """Best known gene of each prediction by shared exon bases, ties to the smaller id, with both fractions and a grade.

    perfect: both fractions above .94 and one known gene touched; mostly: above .69 and .65; partial: any; none: no bases
    shared. join: the second known gene holds at least half of the bases that the best one holds.
    """
    shared = overlap_pairs(predicted.select("gid", "ref", "begin", "end"), known.select("gid", "ref", "begin", "end"))
    shared = shared.groupBy(F.col("p_gid").alias("gid"), F.col("b_gid").alias("known")).agg(F.sum("overlap").alias("bases"))
    size = lambda df, k, to: df.groupBy(F.col("gid").alias(k)).agg(F.sum(F.col("end") - F.col("begin") + 1).alias(to))
    order = Window.partitionBy("gid").orderBy(F.desc("bases"), "known")
    rows = shared.withColumn("rank", F.row_number().over(order)).withColumn("second", F.lead("bases").over(order))
    rows = rows.withColumn("touched", F.count("*").over(Window.partitionBy("gid"))).where("rank = 1")
    rows = size(predicted, "gid", "p_size").join(rows, "gid", "left").join(size(known, "known", "k_size"), "known", "left")
    of_p, of_k = F.col("bases") / F.col("p_size"), F.col("bases") / F.col("k_size")
    grade = (
        F.when(F.col("bases").isNull(), "none").when((of_p > 0.94) & (of_k > 0.94) & (F.col("touched") == 1), "perfect")
        .when((of_p > 0.69) & (of_k > 0.65), "mostly").otherwise("partial")
    )
    join = F.coalesce(2 * F.col("second") >= F.col("bases"), F.lit(False))
    return rows.select("gid", "known", "bases", "p_size", "k_size", grade.alias("grade"), join.alias("join"))


def exon_accuracy(predicted: DataFrame, known: DataFrame) -> DataFrame:
    """One row: exons predicted and known, those found whole on either side, and bases hit."""
    pairs = overlap_pairs(predicted, known)
    same = pairs.where("p_begin = b_begin and p_end = b_end")
    found = same.agg(F.count_distinct("p_xid").alias("right"), F.count_distinct("b_xid").alias("found"))
    n = lambda df: df.agg(F.count("*")).scalar()
    return found.select(n(predicted).alias("predicted"), n(known).alias("known"), "right", "found")


def replaced(genes: DataFrame, updates: DataFrame, key: str = "gid") -> DataFrame:
    """genes with rows of the same key taken from updates; keys of updates alone are added."""
    return genes.join(updates.select(key).distinct(), key, "left_anti").unionByName(updates)


def must_keep(selected: DataFrame, wanted: DataFrame, key: str = "gid") -> DataFrame:
    """Every wanted key with the word kept or missing."""
    return wanted.select(key).distinct().join(selected.select(key, F.lit("kept").alias("state")), key, "left").select(key, F.coalesce("state", F.lit("missing")).alias("state"))


def last_action(rows: DataFrame, key: str = "id") -> DataFrame:
    """The last listed action of each key. rows: key, action, row_no."""
    return rows.groupBy(key).agg(F.max_by("action", "row_no").alias("action"))


def evidence_class(strong: Column, medium: Column, weak: Column, poor: Column, utr_poor: Column, te: Column, partial: Column) -> Column:
    """Transposon, Strong, Medium, Poor, Weak or None from counted marks; bad ends cost a level; Partial is appended."""
    level = F.when(strong > 0, 3).when(medium > 0, 2).when(weak > 0, 1).otherwise(0)
    level = F.when(utr_poor & (level > 0), level - 1).otherwise(level)
    name = F.when(te, "Transposon").when(level == 3, "Strong").when(level == 2, "Medium").when(poor, "Poor").when(level == 1, "Weak").otherwise("None")
    return F.concat(name, F.when(partial, "Partial").otherwise(""))


def best_of_sets(rows: DataFrame) -> DataFrame:
    """The set with the best score for each locus, a tie going to the set named first; and how far the next one is. rows: locus, set, score."""
    order = Window.partitionBy("locus").orderBy(F.desc("score"), "set")
    ranked = rows.withColumn("rank", F.row_number().over(order)).withColumn("lead", F.col("score") - F.lead("score").over(order))
    return ranked.where("rank = 1").select("locus", "set", "score", "lead")
