"""Join checks deal the links of evidence by gene once; repeated ids and exons that aren't there change nothing."""

from loomspan.operators import splits


def test_links_are_dealt_once(spark):
    exons = spark.createDataFrame([(g, n, 100 * n, 100 * n + 50) for g in (1, 2, 3) for n in range(1, 5)], "gid long, exon_no long, begin long, end long")
    ids = [(g, n, str(n // 3)) for g in (1, 2) for n in range(1, 5)]
    none = spark.createDataFrame([], "gid long, exon_no long, introns array<string>, score long")
    frame = lambda rows: spark.createDataFrame(rows, "gid long, exon_no long, id string")
    want = splits.join_check(exons, frame(ids), none)
    got = splits.join_check(exons, frame(ids * 3 + [(3, 9, "x"), (7, 1, "y")]), none)
    assert sorted(got.collect()) == sorted(want.collect()) and want.count() == 3
    assert {r["gid"]: (r["main"], r["others"]) for r in got.collect()} == {1: ("1,2", "3,4"), 2: ("1,2", "3,4"), 3: ("", "")}
    plan = splits.join_check(exons, frame(ids), none)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") <= 10  # with broadcasts; links go by one of them
