"""Unions of a pair's hits and of a gene's exons come from running windows: a task builds no table of its groups, and one sort serves all windows."""

import random

from pyspark.sql import functions as F

from loomspan.operators import genes, hits
from loomspan.operators.intervals import islands


def _plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]


def test_percent_match_sums_in_a_window(spark):
    rng = random.Random(1)
    rows = [(rng.randrange(20), rng.randrange(2), 50, 60, b, b + rng.randrange(9), 1, 1) for b in rng.choices(range(50), k=300)]
    got = hits.percent_match(spark.createDataFrame(rows, "q long, t long, q_len long, t_len long, qb long, qe long, tb long, te long"))
    bases = {}
    for q, t, _, _, b, e, _, _ in rows:
        bases.setdefault((q, t), set()).update(range(b, e + 1))
    assert {(r["q"], r["t"]): r["match"] for r in got.collect()} == {k: 100 * len(v) / 50 for k, v in bases.items()}
    plan = _plan(got)
    assert "Aggregate" not in plan and plan.count("Sort ") == 1


def test_joined_exons_without_a_table_of_islands(spark):
    rng = random.Random(2)
    one = lambda x: None if rng.random() < 0.15 else x
    rows = [(one(rng.randrange(40)), one("c"), "+", one(b), one(b + rng.randrange(30))) for b in rng.choices(range(300), k=600)]
    exons = spark.createDataFrame(rows, "gid long, ref string, strand string, begin long, end long")
    got = genes.joined_exons(exons, 20)
    by = islands(exons, ["gid", "ref", "strand"], gap=19).groupBy("gid", "ref", "strand", F.col("island").alias("exon_no"))
    want = by.agg(F.min("begin").alias("begin"), F.max("end").alias("end"), F.count("*").alias("parts"))
    assert got.dtypes == want.dtypes
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    plan = _plan(got)
    assert "Aggregate" not in plan and plan.count("Sort ") == 1
