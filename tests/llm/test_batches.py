"""What a task of the n-gram join works on at once is bounded in bytes, whatever rows hold."""

import pyarrow as pa
from pyspark.sql import functions as F

from loomspan.llm import ngram_join
from loomspan.llm.grams import chunks
from loomspan.session import stored


def test_chunks_by_both_texts():
    batch = pa.RecordBatch.from_pydict({"text_a": ["a"] * 9, "text_b": ["b" * 60, None, "b" * 500] * 3})
    parts = list(chunks(batch, "text_a", "text_b", limit=200))
    assert pa.Table.from_batches(parts).to_pylist() == batch.to_pylist()
    assert all(p.num_rows == 1 or sum(len(t or "") for c in p.columns for t in c.to_pylist()) <= 200 for p in parts)


def test_arrow_batches_by_bytes(spark):
    rows = spark.range(0, 4000, 1, 1).select("id", F.repeat(F.lit("x"), 4000).alias("text"))

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows], "nbytes": [b.nbytes]})

    key = next(iter(ngram_join.BATCHES))
    before = spark.conf.get(key)
    got = stored(rows.mapInArrow(run, "n long, nbytes long"), "sizes", ngram_join.BATCHES).collect()
    assert sum(r["n"] for r in got) == 4000 and max(r["nbytes"] for r in got) < 6 << 20
    assert spark.conf.get(key) == before
