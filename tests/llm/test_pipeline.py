"""The pipeline stage by stage against brute force, and the SQL of registered queries."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomspan.llm import mixing, registry

from . import helpers as H
from .test_pairs_and_lines import lines_brute


@pytest.fixture(scope="module")
def stages(spark, small, tmp_path_factory):
    """Input and result of every stage."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    out = []
    for name, stage in corpus_pipeline.STAGES:
        path = f"file://{tmp_path_factory.mktemp(name)}/out"
        stage(spark, docs, small).write.parquet(path)
        after = spark.read.parquet(path)
        out.append((docs, after))
        docs = after
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_columns_stay(stages):
    for before, after in stages[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes


def test_quality_stage_drops_what_the_base_rule_fails(stages):
    before, after = map(texts, stages[0])
    assert set(after) <= {d for d, t in before.items() if not H.quality_brute(t)[-1]}
    assert all(before[d] == t for d, t in after.items())
    assert len(after) > 0.5 * len(before)


def test_line_stage_removes_later_matches(stages):
    before, after = map(texts, stages[1])
    gone = lines_brute(list(before.items()))
    want = {d: "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in gone) for d, t in before.items()}
    assert after == {d: t for d, t in want.items() if H.words(t)}


def test_near_duplicates_stage_keeps_one_of_each_component(stages):
    before, after = map(texts, stages[2])
    found = H.component_brute(list(before.items()), corpus_pipeline.NEAR_WORDS, corpus_pipeline.NEAR_PERCENT)
    assert set(after) == {d for d, (_, c) in found.items() if d == c}
    assert all(before[d] == t for d, t in after.items())


def test_near_duplicates_stage_keeps_rows_that_ids_cant_tell_apart(spark, small):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [
        (None, text), (7, text + " end"), (7, text), (3, "one text of three with words"), (3, "another text that shares its id"),
        (None, "no id but words of its own here"), (None, "no id but words of its own here"), (4, None), (4, ""), (None, None), (None, " "),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n", F.lit(1)).withColumn("row", F.lit("r"))
    after = corpus_pipeline.near_duplicates(spark, docs, small)
    assert after.columns == docs.columns
    got = sorted(((r["doc_id"], (r["text"] or "").strip()) for r in after.collect()), key=str)
    # either text of 7 may stand for its component: the hash decides
    assert {x for x in got if x[0] == 7} <= {(7, text), (7, text + " end")} and sum(x[0] == 7 for x in got) == 1
    assert [x for x in got if x[0] != 7] == sorted(
        [(3, rows[3][1]), (3, rows[4][1]), (None, rows[5][1]), (4, ""), (None, ""), (None, "")], key=str
    )


def test_mixing_stage_repeats_rows_by_their_copies(stages):
    before, after = stages[3]
    copies = {r["doc_id"]: r["copies"] for r in mixing.mix(before).collect()}
    got = {}
    for r in after.collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == {d: n for d, n in copies.items() if n}


def test_mixing_stage_allows_clashing_names(spark, stages, small):
    docs = stages[3][0].limit(40).withColumn("copies", F.lit("c")).withColumn("_copy", F.lit(7)).withColumn("row", F.lit(1))
    after = corpus_pipeline.source_mixing(spark, docs, small)
    assert after.columns == docs.columns
    rows = after.select("copies", "_copy", "row").distinct().collect()
    assert [tuple(r) for r in rows] == [("c", 7, 1)]


def test_mixing_stage_keeps_rows_that_ids_cant_tell_apart(spark, small):
    rows = [(i // 2 if i % 3 else None, f"row {i} of a source with words", "a" if i % 2 else None) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    copies = {r["text"]: r["copies"] for r in mixing.mix(docs, columns=("text",)).collect()}
    got = {}
    for r in corpus_pipeline.source_mixing(spark, docs, small).collect():
        got[r["text"]] = got.get(r["text"], 0) + 1
    assert got == {t: n for t, n in copies.items() if n} and any("row 0 " in t for t in copies)


def test_packing_stage_places_every_row(stages):
    before, after = stages[4]
    assert after.where("start = 0").count() == before.count()
    rows = after.groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert all(r[1] <= 2048 for r in rows) and sum(r[1] < 2048 for r in rows) <= 1


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_registered_sql_matches(spark, medium, name):
    con = duckdb.connect()
    for table in ("conversations", "documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{medium}/{table}.parquet'")
    found = con.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    want = sorted(tuple(str(x) for x in r) for r in found.fetchall())
    got = sorted(tuple(str(x) for x in r) for r in registry.queries()[name](spark, medium).select(*columns).collect())
    assert got == want and want and not any(x == "nan" or (isinstance(x, float) and math.isnan(x)) for r in got for x in r)
