"""Selected models check joins once: what selection makes of them doesn't send them through the check again."""

from loomspan.plans import model_queries
from loomspan.plans.adapters import transcripts


def test_join_check_runs_once(spark, small, monkeypatch):
    seen, real = spark.sparkContext.accumulator(0), model_queries.splits.join_check

    def counted(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    def check(*args):
        found = real(*args)
        return found.mapInPandas(counted, found.schema)

    monkeypatch.setattr(model_queries.splits, "join_check", check)
    model_queries.selected_models(spark, small).collect()
    assert seen.value == transcripts(spark, small).select("gid").distinct().count()
