"""Writers. Each writes a folder of part files by Spark's own writers, so any file system it knows will do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def gff_line(mark: str | None = None, value: Column | None = None) -> Column:
    """A feature row as a line; an attribute mark is replaced by value."""
    attrs = F.coalesce("attr_text", F.lit(""))
    if mark is not None:
        kept = F.filter(F.split(attrs, ";"), lambda x: ~x.startswith(f"{mark}=") & (F.trim(x) != ""))
        attrs = F.array_join(F.concat(kept, F.when(value.isNotNull(), F.array(F.concat(F.lit(f"{mark}="), value.cast("string")))).otherwise(F.array().cast("array<string>"))), ";")
    dot = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("."))
    return F.concat_ws("\t", *[dot(c) for c in ("ref", "source", "type", "begin", "end", "score", "strand", "phase")], attrs)


def write_gff(df: DataFrame, path: str, mark: str | None = None, value: Column | None = None) -> None:
    df.select(gff_line(mark, value).alias("value")).write.text(path)


def write_table(df: DataFrame, path: str, header: bool = True, totals: dict[str, Column] | None = None) -> None:
    """Tab-separated, nulls as na. The header is a part file of its own before the rows, and totals one after them.

    totals: column -> aggregate; columns without one are left empty.
    """
    cells = lambda rows: rows.select(*[F.coalesce(F.col(c).cast("string"), F.lit("na")).alias(c) for c in df.columns])
    lines = lambda rows: rows.select(F.concat_ws("\t", *df.columns).alias("value"))
    if header:
        lines(df.sparkSession.range(1).select(*[F.lit(c).alias(c) for c in df.columns])).write.text(f"{path}/part=0-header")
    lines(cells(df)).write.text(f"{path}/part=1-rows")
    if totals:
        last = df.agg(*[totals.get(c, F.lit("")).cast("string").alias(c) for c in df.columns])
        lines(last).write.text(f"{path}/part=2-totals")


def write_classes(df: DataFrame, path: str, column: str = "class") -> None:
    """One folder a class."""
    df.write.partitionBy(column).parquet(path)


def write_fasta(df: DataFrame, path: str, width: int = 60) -> None:
    """id and header, then the sequence in lines of width letters."""
    lines = F.regexp_replace("seq", f"(.{{{width}}})(?=.)", "$1\n")
    df.select(F.concat(F.lit(">"), "id", F.when(F.coalesce("header", F.lit("")) != "", F.concat(F.lit(" "), "header")).otherwise(""), F.lit("\n"), lines).alias("value")).write.text(path)


def write_bed(df: DataFrame, path: str, log: bool = False) -> None:
    """Closed places from 1 as half-open ones from 0, with value or log(1 + value)."""
    value = F.round(F.log1p("value"), 3) if log else F.col("value")
    df.select("ref", F.col("begin") - 1, "end", value).write.option("sep", "\t").csv(path)


def hint_rows(exons: DataFrame) -> DataFrame:
    """Hints of gene models: an exonpart a part, an intronpart and splice sites (dss, ass) a gap. exons: gid, ref, strand, begin, end."""
    from loomspan.operators.genes import introns

    part = exons.select("ref", F.lit("exonpart").alias("type"), "begin", "end", "strand", F.col("gid").alias("grp"))
    gaps = introns(exons).select("ref", "begin", "end", "strand", F.col("gid").alias("grp"))
    back = F.col("strand") == "-"
    sites = F.array(
        F.struct(F.lit("intronpart").alias("type"), F.col("begin").alias("b"), F.col("end").alias("e")),
        F.struct(F.when(back, "ass").otherwise("dss").alias("type"), F.col("begin").alias("b"), F.col("begin").alias("e")),
        F.struct(F.when(back, "dss").otherwise("ass").alias("type"), F.col("end").alias("b"), F.col("end").alias("e")),
    )
    more = gaps.select("ref", "strand", "grp", F.explode(sites).alias("x")).select("ref", "x.type", F.col("x.b").alias("begin"), F.col("x.e").alias("end"), "strand", "grp")
    return part.unionByName(more)
