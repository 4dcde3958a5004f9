"""N-gram Jaccard self-join: a blocked product of the sparse document by n-gram incidence matrix.

Documents with equal n-gram sets collapse into one row of the matrix. Columns are ordered from rare to frequent
by a fixed-size count sketch over all documents, ties by hash. Each row keeps the first entries of that order, as
many as its size demands: two rows that reach the threshold must share one of them, and a bound from sizes and the
places of their first shared entry discards pairs that can't reach it. A kept column with two rows or more is a block of the product.

Blocks multiply in two passes, so that a large group of near copies costs its size and not its square. First every
row meets the row it shares most blocks with among the blocks' leading rows, and links found make components. Then
only pairs of different components are multiplied, and those whose accumulated counts can't reach the threshold go.
Overlaps of the rest are counted on full n-gram sets.

Defined results: a null, empty or blank text has no n-grams and links with nothing; a text with fewer words than n
is one n-gram; repeated rows and equal sets are linked; a row with a null doc_id links with nothing and its
component is null; rows of one doc_id with different texts are one document, linked if one of them is, with a row of
the result each; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import components, dropped, maybe_in, stored
from .grams import Words, chunks, mix

#: log2 of the sketch's counters: fixed, 2 MB, whatever the corpus holds.
SKETCH_BITS = 18
#: Bytes of text that a task works on at once: it takes a hundred times as much for the hashes of its bytes and n-grams.
CHUNK = 1 << 18
#: Arrow batches are bounded in bytes, too: a task has one in the executor, and one or two at its worker.
BATCHES = {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"}


def _sets(column: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """row, hash of each distinct n-gram (sorted by row and hash), and the number of each row."""
    w = Words(column, lower=True)
    start, grams = w.grams(n)
    few = np.flatnonzero((w.count > 0) & (w.count < n))
    row = np.concatenate([w.rows()[start], few])
    grams = np.concatenate([grams, w.spans(w.first[few], w.first[few + 1])])
    order = np.lexsort((grams, row))
    row, grams = row[order], grams[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (grams[1:] != grams[:-1])
    row, grams = row[new], grams[new]
    return row, grams, np.bincount(row, minlength=len(w.count))


def _per_row(values: np.ndarray, row: np.ndarray, rows: int) -> np.ndarray:
    sums = np.zeros(rows, np.uint64)
    np.add.at(sums, row, values)
    return sums


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64), pa.int64())


def _surveyed(docs: DataFrame, n: int) -> DataFrame:
    """One row a document (sketched false): doc_id, size, s1, s2; and a task's counters (sketched true)."""
    names = ["doc_id", "size", "s1", "s2", "sketched"]

    def run(batches):
        counts = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for part in chunks(batch, limit=CHUNK):
                row, grams, size = _sets(part.column(1), n)
                counts += np.bincount((grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(counts))
                s1, s2 = _per_row(grams, row, len(size)), _per_row(mix(grams ^ np.uint64(0x5851F42D4C957F2D)), row, len(size))
                yield pa.RecordBatch.from_arrays([part.column(0), _long(size), _long(s1), _long(s2), pa.array(np.zeros(len(size), bool))], names=names)
        at = np.flatnonzero(counts)
        nothing = np.zeros(len(at), np.int64)
        yield pa.RecordBatch.from_arrays([_long(at), _long(counts[at]), _long(nothing), _long(nothing), pa.array(np.ones(len(at), bool))], names=names)

    return docs.mapInArrow(run, "doc_id long, size long, s1 long, s2 long, sketched boolean")


def _ordered(docs: DataFrame, n: int, counts: np.ndarray, percent: int) -> DataFrame:
    """doc_id, size and the leading n-grams of each document, rare ones first."""
    shared = docs.sparkSession.sparkContext.broadcast(counts)

    def run(batches):
        counts = shared.value
        for batch in batches:
            for part in chunks(batch, limit=CHUNK):
                row, grams, size = _sets(part.column(1), n)
                order = np.lexsort((grams, counts[(grams >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)], row))
                row, grams = row[order], grams[order]
                first = np.concatenate([[0], np.cumsum(size)])
                keep = size - (percent * size + 99) // 100 + 1
                lead = np.arange(len(row)) - first[row] < keep[row]
                held = np.concatenate([[0], np.cumsum(np.where(size > 0, keep, 0))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(held), _long(grams[lead]))
                yield pa.RecordBatch.from_arrays([part.column(0), _long(size), lists], names=["doc_id", "size", "lead"])

    return docs.mapInArrow(run, "doc_id long, size long, lead array<long>")


def _linked(pairs: DataFrame, docs: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose overlap reaches the threshold, by their whole n-gram sets.

    Texts travel and not their sets, which are larger and hardly compress.
    """
    rows = pairs.select("a", "b")
    for k in "ab":
        texts = docs.where(maybe_in(pairs.select(F.col(k).alias("doc_id")), ["doc_id"]))
        rows = rows.join(texts.select(F.col("doc_id").alias(k), F.col("text").alias(f"text_{k}")), k)

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text_a", "text_b", limit=CHUNK):
                (row_a, grams_a, size_a), (row_b, grams_b, size_b) = (_sets(part.column(c), n) for c in (2, 3))
                row, grams = np.concatenate([row_a, row_b]), np.concatenate([grams_a, grams_b])
                order = np.lexsort((grams, row))
                row, grams = row[order], grams[order]
                twice = (row[1:] == row[:-1]) & (grams[1:] == grams[:-1])  # each set holds a gram once
                same = np.bincount(row[1:][twice], minlength=part.num_rows)
                keep = pa.array((same > 0) & (100 * same >= percent * (size_a + size_b - same)))
                yield pa.RecordBatch.from_arrays([part.column(j).filter(keep) for j in (0, 1)], names=["a", "b"])

    return rows.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _bounded(a: str, b: str, percent: int):
    """What sizes and places allow if the n-gram is the first in the common order that both rows hold.

    Every other shared one then stands behind it in both. A linked pair passes at its first shared n-gram, so none is
    lost; pairs that only share frequent n-grams, with enough of their own before them, never pass.
    """
    size_a, size_b, at_a, at_b = (F.col(f"{x}.{c}") for c in ("size", "at") for x in (a, b))
    most = F.least(size_a - at_a, size_b - at_b)
    return (100 + percent) * most >= percent * (size_a + size_b)


def join(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id: documents link when 100 * overlap >= percent * union of n-gram sets."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    survey = stored(_surveyed(rows, n), "survey", BATCHES)
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    for at, count in survey.where("sketched").groupBy("doc_id").agg(F.sum("size")).toPandas().itertuples(index=False):
        counts[int(at)] = count
    each = survey.where("not sketched").select("doc_id", "size", "s1", "s2")
    classes = each.where("size > 0 and doc_id is not null").groupBy("s1", "s2", "size").agg(F.min("doc_id").alias("class"))
    classes = stored(classes, "classes")

    lead = _ordered(rows.where("doc_id is not null"), n, counts, percent)
    lead = lead.join(classes.select(F.col("class").alias("doc_id")), "doc_id", "left_semi").dropDuplicates(["doc_id", "size", "lead"])
    entries = lead.select("doc_id", "size", F.posexplode("lead").alias("at", "gram"))
    column = Window.partitionBy("gram")
    entries = entries.select(
        "gram", "doc_id", "size", "at", F.count("*").over(column).alias("rows"), F.min(F.struct("at", "doc_id", "size")).over(column).alias("head")
    )
    entries = stored(entries.where("rows > 1").drop("rows"), "blocks", BATCHES)

    def verified(pairs: DataFrame) -> DataFrame:
        pairs = stored(pairs, "pairs")
        found = stored(_linked(pairs, rows, n, percent).distinct(), "links", BATCHES)
        dropped(pairs)
        return found

    heads = entries.alias("e").where((F.col("doc_id") != F.col("head.doc_id")) & _bounded("e", "head", percent))
    heads = heads.groupBy("doc_id", F.col("head.doc_id").alias("head")).count()
    first = heads.groupBy("doc_id").agg(F.min(F.struct(-F.col("count"), "head")).alias("x"))
    first = first.select(F.col("doc_id").alias("a"), F.col("x.head").alias("b"))
    links = verified(first)
    found = components(links)

    held = entries.drop("head").join(found.select(F.col("id").alias("doc_id"), "component"), "doc_id", "left")
    held = held.withColumn("component", F.coalesce("component", "doc_id"))
    held = held.withColumn("mixed", F.min("component").over(column) < F.max("component").over(column))
    held = stored(held.where("mixed").drop("mixed"), "mixed")
    pairs = (
        held.alias("x")
        .join(held.alias("y"), (F.col("x.gram") == F.col("y.gram")) & (F.col("x.doc_id") < F.col("y.doc_id")) & (F.col("x.component") != F.col("y.component")) & _bounded("x", "y", percent))
        .groupBy(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"), F.col("x.size").alias("size_a"), F.col("y.size").alias("size_b"))
        .agg(
            F.count("*").alias("shared"),
            F.max("x.at").alias("last_a"), F.max("y.at").alias("last_b"),
        )
    )
    # the count holds every shared n-gram up to the last places; whatever else is shared stands behind them in both rows
    rest = F.least(F.col("size_a") - F.col("last_a"), F.col("size_b") - F.col("last_b")) - 1
    pairs = pairs.where((100 + percent) * (F.col("shared") + rest) >= percent * (F.col("size_a") + F.col("size_b"))).select("a", "b").distinct()
    links = links.union(verified(pairs))
    found = components(links)

    labels = classes.join(found.select(F.col("id").alias("class"), "component"), "class", "left")
    labels = labels.select("s1", "s2", "size", F.coalesce("component", "class").alias("component"))
    out = each.join(labels, ["s1", "s2", "size"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", F.col("size").alias("n_shingles"), component.alias("component_id"))
