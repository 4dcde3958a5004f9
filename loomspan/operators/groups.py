"""Ortholog groups: members are (gene, species, grp, size)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomspan.functions.statistics import lower_median


def matrix(members: DataFrame, species: list[int]) -> DataFrame:
    """One row a group: genes, taxa and a count column s<species> each."""
    counts = [F.count_if(F.col("species") == s).alias(f"s{s}") for s in species]
    return members.groupBy("grp").agg(F.count("*").alias("genes"), F.count_distinct("species").alias("taxa"), *counts)


def species_classes(members: DataFrame) -> DataFrame:
    """Per species: genes in groups, groups, genes in groups of its own, single and repeated orthologs, largest count."""
    cell = members.groupBy("grp", "species").agg(F.count("*").alias("n"))
    cell = cell.withColumn("taxa", F.count("*").over(Window.partitionBy("grp")))
    shared = F.col("taxa") > 1
    return cell.groupBy("species").agg(
        F.sum("n").alias("in_gene"), F.count("*").alias("n_group"), F.sum(F.when(~shared, F.col("n")).otherwise(0)).alias("unique_genes"),
        F.count_if(shared & (F.col("n") == 1)).alias("orth1"), F.count_if(shared & (F.col("n") > 1)).alias("or_dup"), F.max("n").alias("g_max"),
    )


def set_averages(members: DataFrame, key: str) -> DataFrame:
    """Genes, groups and mean size per set, over all groups and over the groups that every set has."""
    sets = members.agg(F.count_distinct(key)).scalar()
    common = members.groupBy("grp").agg(F.count_distinct(key).alias("n")).where(F.col("n") == sets).select("grp")

    def level(df: DataFrame, name: str) -> DataFrame:
        rows = df.groupBy(key).agg(F.count("*").alias("genes"), F.count_distinct("grp").alias("groups"), F.round(F.avg("size"), 6).alias("mean_size"))
        return rows.select(key, F.lit(name).alias("level"), "genes", "groups", "mean_size")

    return level(members, "all").unionByName(level(members.join(common, "grp", "left_semi"), "common"))


def outliers(members: DataFrame, large: float = 1.9, small: float = 0.65) -> DataFrame:
    """2 for members above large times their group's median size, -2 below small times, else 0."""
    rows = members.join(lower_median(members, "size", ["grp"]), "grp")
    size, median = F.col("size"), F.col("median")
    return rows.select("gene", "grp", "size", "median", F.when(size > large * median, 2).when(size < small * median, -2).otherwise(0).alias("outlier"))


def best_by_set(members: DataFrame, key: str, close: float = 0.95) -> DataFrame:
    """Per set: groups where its best member is the best of all, close to it, or apart; and mean sizes."""
    best = members.groupBy("grp", key).agg(F.max("size").alias("size"))
    top = F.max("size").over(Window.partitionBy("grp"))
    grade = F.when(F.col("size") == F.col("top"), "best").when(F.col("size") >= close * F.col("top"), "same").otherwise("diff")
    rows = best.withColumn("top", top).withColumn("class", grade)
    return rows.groupBy(key, "class").agg(F.count("*").alias("n"), F.round(F.avg("size"), 6).alias("mean"))


def mean_match(members: DataFrame) -> DataFrame:
    """Mean ratio of the smaller to the larger size over a group's pairs, from sorted running sums.

    With sizes in order, member i (from 1) is the larger of i - 1 pairs, whose ratios sum to (sum of earlier sizes) / size.
    """
    order = Window.partitionBy("grp").orderBy("size", "gene").rowsBetween(Window.unboundedPreceding, -1)
    rows = members.select("grp", "size", F.count("*").over(order).alias("before"), F.coalesce(F.sum("size").over(order), F.lit(0)).alias("sum"))
    sums = rows.groupBy("grp").agg(F.sum("before").alias("pairs"), F.sum(F.col("sum") / F.col("size")).alias("ratios")).where("pairs > 0")
    return sums.select("grp", "pairs", F.round(F.col("ratios") / F.col("pairs"), 6).alias("mean"))


def consensus_name(names: DataFrame, share: float = 0.7) -> DataFrame:
    """The member name of each group that its most frequent words speak for. names: grp, gene, name.

    Words count once a name. The most frequent ones, up to share of the group's words, weigh by falling rank; a name
    scores the weights of its words, ties going to the smaller gene.
    """
    words = names.select("grp", "gene", "name", F.explode(F.array_distinct(F.split(F.lower("name"), r"[^\p{L}\p{N}]+"))).alias("word")).where("word <> ''")
    counts = words.groupBy("grp", "word").agg(F.count("*").alias("n"))
    by = Window.partitionBy("grp")
    counts = counts.withColumn("rank", F.row_number().over(by.orderBy(F.desc("n"), "word"))).withColumn("words", F.count("*").over(by))
    counts = counts.where(F.col("rank") <= F.greatest(F.lit(1), F.floor(share * F.col("words")))).withColumn("weight", F.greatest(F.lit(1), 100 - 3 * F.col("rank")))
    score = words.join(counts.select("grp", "word", "weight"), ["grp", "word"]).groupBy("grp", "gene", "name").agg(F.sum("weight").alias("score"))
    return score.groupBy("grp").agg(F.max_by("name", F.struct("score", -F.col("gene"))).alias("name"), F.max("score").alias("score"))
