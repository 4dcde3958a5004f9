"""Shared pieces: scratch tables, word splitting, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.operators import graphs
from loomspan.session import stored

#: Words are maximal runs of anything but these six ASCII space characters.
SPACES = r"[\x20\x09-\x0D]+"


def dropped(table: DataFrame) -> None:
    """Delete the files of a stored table that nothing reads any more; what was made of it must be stored."""
    spark = table.sparkSession
    jvm = spark.sparkContext._jvm
    for folder in {f.rpartition("/")[0] for f in table.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def maybe_in(ids: DataFrame, keys: list[str], bits: int = 23) -> Column:
    """False only for rows whose keys are not among those of ids: a bitmap of hashed keys, fixed at 2**bits bits.

    It spares a following join the shuffle of most other rows. Once ids fill the bitmap it only stops helping.
    """
    place = F.pmod(F.xxhash64(*keys), F.lit(1 << bits))
    word, bit = F.shiftright(place, 6).cast("int"), place.bitwiseAND(63).cast("int")
    held = ids.select(word.alias("w"), bit.alias("b")).select("w", F.expr("shiftleft(1L, b)").alias("m"))
    every = ids.sparkSession.range(1 << (bits - 6)).select(F.col("id").cast("int").alias("w"), F.lit(0).cast("long").alias("m"))
    dense = held.unionByName(every).groupBy("w").agg(F.bit_or("m").alias("m"))
    row = dense.groupBy().agg(F.transform(F.sort_array(F.collect_list(F.struct("w", "m"))), lambda x: x["m"]).alias("bitmap"))
    return F.bit_get(F.get(stored(row, "bitmap").scalar(), word), bit) == 1


def words(text: Column) -> Column:
    """Words of a text; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES), lambda w: w != "")


def n_words(text: Column) -> Column:
    """Number of words, without building filtered arrays: only the outermost parts can be empty."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACES)
    return (
        F.size(parts) - (F.element_at(parts, 1) == "").cast("int") - ((F.element_at(parts, -1) == "") & (F.size(parts) > 1)).cast("int")
    ).cast("long")


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges (a, b): rows (id, component), component being the smallest id reached."""
    return graphs.components(edges, keep=lambda df: stored(df, "graph"))
