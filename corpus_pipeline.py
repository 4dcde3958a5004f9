"""Corpus pipeline: quality rules, line dedup, near-duplicate removal, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.llm import line_dedup, mixing, ngram_join, packing, quality
from loomspan.llm.common import stored

#: Near duplicates: five-word n-grams and a similarity of 0.8 or more.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def _like(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """rows with the columns of docs, n_chars following the text where docs has it."""
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and the fences of their group, unchanged."""
    carried = [c for c in docs.columns if c not in ("doc_id", "lang", "source")]
    renamed = docs.select("doc_id", "lang", "source", F.col("text"), F.struct(*docs.columns).alias("_row"))
    return quality.judge(renamed, ("_row",)).where("kept").select("_row.*") if carried else docs


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that near-copy an earlier line; documents left without a word go."""
    rows = line_dedup.apply(docs)
    return _like(docs, rows.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")))


def _numbered(docs: DataFrame) -> DataFrame:
    """Rows (n, row): a number of its own and one struct of all columns, so that none can clash; stored, so that n can't change."""
    return stored(docs.select(F.monotonically_increasing_id().alias("n"), F.struct(*docs.columns).alias("row")), "numbered")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies: the one with the smallest doc_id, nulls last, ties by the text's hash.

    Rows are told apart by numbers of their own, so that rows with a null doc_id and different texts of one doc_id stay
    unless they are near copies. Of rows without words one a doc_id stays, and all with a null one.
    """
    rows = _numbered(docs)
    found = ngram_join.join(rows.select(F.col("n").alias("doc_id"), F.col("row.text").alias("text")), NEAR_WORDS, NEAR_PERCENT)
    found = found.select(F.col("doc_id").alias("n"), "n_shingles", "component_id")
    known = rows.select("n", F.col("row.doc_id").alias("id"), F.xxhash64("row.text").alias("text_key"))
    # a row without words is its own group by number; those of one doc_id share a group below
    members = known.join(found, "n")
    empty = F.col("n_shingles") == 0
    group = F.struct(F.when(~empty, F.col("component_id")).alias("component"), F.when(empty, F.col("id")).alias("id"), F.when(empty & F.col("id").isNull(), F.col("n")).alias("n"))
    first = members.groupBy(group.alias("group")).agg(F.min(F.struct(F.col("id").isNull(), "id", "text_key", "n")).alias("first"))
    return rows.join(first.select("first.n"), "n", "left_semi").select("row.*")


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: its row repeated for its copies.

    Copies are joined by the rows' own numbers: rows with a null doc_id stay, and those of one doc_id don't multiply.
    """
    rows = _numbered(docs)
    taken = mixing.mix(rows.select("row.doc_id", "row.source", "row.text", "n"), columns=("n",)).where("copies > 0").select("n", "copies")
    return rows.join(taken, "n").select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).select("row.*")


def window_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in windows of 2048 tokens."""
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("ngram_join", near_duplicates),
    ("mixing", source_mixing),
    ("packing", window_packing),
]

#: Graph components, balanced sampling and token ids have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's result is a table in the shared folder before the next one starts."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
