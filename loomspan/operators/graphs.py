"""Components of graphs and ends of redirect chains, by joins that halve what is left in each round."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspan.session import cut


def _ranked(c: str):
    """Ids in a hashed order, so that a path of ascending ids shrinks as fast as any other graph."""
    return F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))


def components(edges: DataFrame, a: str = "a", b: str = "b", keep: Callable[[DataFrame], DataFrame] = cut) -> DataFrame:
    """(id, component): the smallest id of each connected component. Ids without an edge are left out.

    In each round every node follows its first neighbour in a hashed order, and that one's, and edges move along; of
    each unfinished component a constant share of nodes is left on average. keep stores a round's tables.
    """
    left = keep(edges.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).where("a <> b").distinct())
    labels = None
    while not left.isEmpty():
        both = left.union(left.select(F.col("b"), F.col("a")))
        step = both.groupBy("a").agg(F.min(_ranked("b")).alias("x")).select(F.col("a").alias("id"), F.least(_ranked("a"), F.col("x"))["id"].alias("to"))
        step = keep(step.join(step.select(F.col("id").alias("to"), F.col("to").alias("next")), "to").select("id", F.col("next").alias("to")))
        if labels is None:
            labels = step.select("id", F.col("to").alias("label"))
        else:
            labels = labels.join(step.select(F.col("id").alias("label"), "to"), "label", "left").select("id", F.coalesce("to", "label").alias("label"))
        labels = keep(labels)
        ends = left.join(step.select(F.col("id").alias("a"), F.col("to").alias("x")), "a").join(step.select(F.col("id").alias("b"), F.col("to").alias("y")), "b")
        left = keep(ends.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
    if labels is None:
        return left.select(F.col("a").alias("id"), F.col("b").alias("component"))
    smallest = labels.groupBy("label").agg(F.min("id").alias("component"))  # partial minima first, so a large component is no hot key
    return keep(labels.join(smallest, "label").select("id", "component"))


def chain_ends(links: DataFrame) -> DataFrame:
    """(id, end): where each redirect (id, to) leads in the end. Chains must not be circular."""
    now = cut(links.select("id", F.col("to").alias("end")))
    while True:
        further = now.select(F.col("id").alias("end"), F.col("end").alias("next"))
        moved = cut(now.join(further, "end", "left").select("id", F.coalesce("next", "end").alias("end"), F.col("next").isNotNull().alias("moved")))
        now = moved.select("id", "end")
        if moved.where("moved").isEmpty():
            return now
