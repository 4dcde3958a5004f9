"""Queries opN_<name> and pipeline, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_line_dedup(spark, sf_dir):
    from .line_dedup import removed_lines

    return removed_lines(_docs(spark, sf_dir))


def op2_nearest_neighbours(spark, sf_dir):
    from .neighbours import search

    return search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op3_quality_rules(spark, sf_dir):
    from .quality import judge

    return judge(_docs(spark, sf_dir))


def op4_chat_formatting(spark, sf_dir):
    from .chat import neighbours, preference_pairs

    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return preference_pairs(turns, neighbours(turns))


def op5_ngram_join(spark, sf_dir):
    from .ngram_join import join

    return join(_docs(spark, sf_dir))


def op6_packing(spark, sf_dir):
    import public_tokenizers

    from .packing import pack

    return pack(_docs(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("byte_bpe_50k.json"))


def op7_substring_dedup(spark, sf_dir):
    from .passages import remove_repeats

    return remove_repeats(_docs(spark, sf_dir))


def op8_pii_surrogates(spark, sf_dir):
    from .surrogates import replace

    return replace(_docs(spark, sf_dir))


def op9_licence_scan(spark, sf_dir):
    from .licences import scan

    return scan(_docs(spark, sf_dir))


def op10_mixing(spark, sf_dir):
    from .mixing import mix

    return mix(_docs(spark, sf_dir))


def op11_byte_bpe(spark, sf_dir):
    import public_tokenizers

    from .bpe import round_trip

    return round_trip(_docs(spark, sf_dir), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op12_source_divergence(spark, sf_dir):
    from .divergence import audit

    return audit(_docs(spark, sf_dir))


def op13_vector_codes(spark, sf_dir):
    from .codes import compress

    return compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def queries() -> dict:
    import corpus_pipeline

    found = {name: f for name, f in globals().items() if name.startswith("op") and name[2:3].isdigit()}
    return found | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict:
    from . import chat, codes, divergence

    return {"op4_chat_formatting": chat.ORACLE_SQL, "op12_source_divergence": divergence.ORACLE_SQL, "op13_vector_codes": codes.ORACLE_SQL}
