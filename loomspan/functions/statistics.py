"""Statistics with the conventions of gene-set evaluation: upper medians, counts above cuts, guarded deviations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def upper_median(df: DataFrame, column: str, keys: list[str] | None = None, to: str = "median") -> DataFrame:
    """The value at place n div 2 (from 0) in ascending order, per keys. Values are counted first, so ties cost one row."""
    return _placed(df, column, keys or [], to, F.floor(F.col("_n") / 2))


def lower_median(df: DataFrame, column: str, keys: list[str] | None = None, to: str = "median") -> DataFrame:
    """The value at place n div 2 (from 0) in descending order, per keys."""
    return _placed(df, column, keys or [], to, F.col("_n") - 1 - F.floor(F.col("_n") / 2))


def _placed(df: DataFrame, column: str, keys: list[str], to: str, place: Column) -> DataFrame:
    counts = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count("*").alias("_c"))
    ordered = Window.partitionBy(*keys).orderBy(column)
    counts = counts.withColumn("_upto", F.sum("_c").over(ordered)).withColumn("_n", F.sum("_c").over(Window.partitionBy(*keys)))
    return counts.where(F.col("_upto") > place).groupBy(*keys).agg(F.min(column).alias(to))


def cut_counts(column: Column, cuts: list[float], prefix: str = "ge_") -> list[Column]:
    """How many values reach each cut."""
    return [F.count_if(column >= c).alias(f"{prefix}{i}") for i, c in enumerate(cuts)]


def deviation(column: str) -> Column:
    """Sample standard deviation; 0 for fewer than three values or a variance under 1."""
    return F.when((F.count(column) < 3) | (F.coalesce(F.var_samp(column), F.lit(0.0)) < 1), 0.0).otherwise(F.stddev_samp(column))


def log_mean_ratio(a: Column, b: Column) -> tuple[Column, Column]:
    """Half the sum and the difference of logarithms; values under 1 count as logarithm 0."""
    la, lb = (F.when(x < 1, 0.0).otherwise(F.log(x)) for x in (a, b))
    return (la + lb) / 2, la - lb


def evalue_weight(e: Column) -> Column:
    """-log10 of an e-value, 316 for 0."""
    return F.when(e == 0, 316.0).otherwise(-F.log10(e))


def human_bases(n: Column) -> Column:
    """Bases in Mb from a million, Kb from a thousand, with one decimal; plain below."""
    scaled = lambda d, unit: F.concat((F.floor(n / (d / 10)) / 10).cast("string"), F.lit(unit))
    return F.when(n >= 1_000_000, scaled(1_000_000, "Mb")).when(n >= 1_000, scaled(1_000, "Kb")).otherwise(n.cast("string"))


def bases_of(text: Column) -> Column:
    """The number that human_bases wrote, to its precision."""
    number = F.regexp_extract(text, r"^([\d.]+)", 1).cast("double")
    return F.round(number * F.when(text.endswith("Mb"), 1_000_000).when(text.endswith("Kb"), 1_000).otherwise(1)).cast("long")
