"""Substring dedup: repeated passages found through Aho-Corasick automata of recurring phrases.

Of every window of 50 words the phrase of 16 words with the smallest hash is its mark, so two documents that share a
window share its mark. Marks that two documents or more hold recur. Recurring phrases are compiled into automata,
one shard per group of first holders, over texts written as one character a word; each document is streamed through
the shards that hold its marks, which finds every place of every recurring phrase. The windows around those places
are then confirmed by a 128-bit hash across documents: a window's words go where a smaller doc_id holds it too.

Texts that are wholly equal collapse first, so large groups of exact copies cost one document. Hot shards are dealt
to several tasks, each with the shard's automaton and a bounded number of words to stream.

Defined results: a null or blank text has no words; texts shorter than a window lose nothing; repeated rows of one
doc_id, equal or not, don't count against each other; a row with a null doc_id loses nothing and takes nothing from
others; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .grams import Words, chunks

_BASE_A, _BASE_B = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x9FB21C651E98DF25)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64) if x.dtype == np.uint64 else x.astype(np.int64), pa.int64())


def _marks(w: Words, window: int, phrase: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(phrase hash at each word, window starts, mark of each window)."""
    total = len(w.hashes)
    if total < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(total - phrase + 1)
    grams = w.spans(at, at + phrase)
    least = np.lib.stride_tricks.sliding_window_view(grams, window - phrase + 1).min(axis=1)
    start = np.flatnonzero((np.repeat(w.first[1:], w.count) - np.arange(total) >= window)[: len(least)])
    return grams, start, least[start]


def _joined(text: str | None) -> list[bytes]:
    return (text or "").encode().split()  # bytes split at the six ASCII spaces and nowhere else


def _surveyed(rows: DataFrame, window: int, phrase: int) -> DataFrame:
    """row, doc_id, n_words, s1 and s2 (hashes of the word sequence), whole (its sha256) and its distinct marks."""
    names = ["doc_id", "row", "n_words", "s1", "s2", "whole", "marks"]

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                w = Words(part.column(1))
                _, start, mark = _marks(w, window, phrase)
                row = w.rows()[start]
                order = np.lexsort((mark, row))
                row, mark = row[order], mark[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (mark[1:] != mark[:-1])
                held = np.concatenate([[0], np.cumsum(np.bincount(row[new], minlength=len(w.count)))]).astype(np.int32)
                whole = [hashlib.sha256(b" ".join(_joined(t.as_py()))).digest() for t in part.column(1)]
                signs = [_long(w.spans(w.first[:-1], w.first[1:], base)) for base in (_BASE_A, _BASE_B)]
                columns = [part.column(0), part.column(2), _long(w.count), *signs, pa.array(whole, pa.binary()), pa.ListArray.from_arrays(pa.array(held), _long(mark[new]))]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(run, "doc_id long, row long, n_words long, s1 long, s2 long, whole binary, marks array<long>")


def _codes(w: Words) -> str:
    """A text as one character a word; unequal words may share one, so finds are confirmed by hashes."""
    return (np.uint64(0x10000) + w.hashes % np.uint64(0xF0000)).astype("<u4").tobytes().decode("utf-32-le")


def _phrases(phrase: int):
    """(row, text, marks) -> mark, row and the phrase's characters, for the marks the row holds first."""

    def run(batches):
        for batch in batches:
            doc, out = batch.column(0).to_pylist(), []
            for i in range(batch.num_rows):
                w = Words(batch.column(1).slice(i, 1))
                start, grams = w.grams(phrase)
                at = dict(zip(grams.view(np.int64).tolist(), start.tolist()))
                codes = _codes(w)
                out += [(m, doc[i], codes[at[m] : at[m] + phrase]) for m in batch.column(2)[i].as_py()]
            columns = list(zip(*out)) or [[], [], []]
            kinds = (pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["mark", "owner", "phrase"])

    return run


def _located(window: int, phrase: int):
    """One shard's automaton over its documents: the windows around every place of its phrases."""
    names = ["h1", "h2", "row", "doc_id", "start"]

    def run(phrases: pa.Table, docs: pa.Table) -> pa.Table:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for text, mark in zip(phrases["phrase"].to_pylist(), phrases["mark"].to_pylist()):
            marks = automaton.get(text, None)
            if marks is None:
                automaton.add_word(text, [mark])
            else:
                marks.append(mark)
        kinds = pa.schema([(n, pa.int64()) for n in names])
        if not len(phrases) or not len(docs):
            return kinds.empty_table()
        automaton.make_automaton()
        keys, texts, out = list(zip(docs["row"].to_pylist(), docs["doc_id"].to_pylist())), docs["text"].combine_chunks(), []
        for i, key in enumerate(keys):
            w = Words(texts.slice(i, 1))
            grams, start, mark = _marks(w, window, phrase)
            signed, hit = grams.view(np.int64), np.zeros(len(grams) + 1, bool)
            for end, marks in automaton.iter(_codes(w)):
                hit[end - phrase + 1] = signed[end - phrase + 1] in marks
            # a window counts when a place of its own mark lies in it
            places = np.flatnonzero(hit)
            low = np.searchsorted(places, start)
            near = np.zeros(len(start), bool)
            values = np.unique(grams[places])
            if len(values):
                near = (values[np.minimum(np.searchsorted(values, mark), len(values) - 1)] == mark) & (low < len(places))
            start = start[near]
            h1, h2 = (w.spans(start, start + window, base) for base in (_BASE_A, _BASE_B))
            out.append(pa.table([_long(h1), _long(h2), *[pa.array(np.full(len(start), k), pa.int64()) for k in key], _long(start)], schema=kinds))
        return pa.concat_tables(out)

    return run


def _kept(window: int):
    """(row, text, starts of removed windows) -> row, n_removed and the sha256 of what stays."""
    names = ["row", "n_removed", "rest"]

    def run(batches):
        for batch in batches:
            removed, rest = [], []
            for text, starts in zip(batch.column(1), batch.column(2)):
                words = _joined(text.as_py())
                change = np.zeros(len(words) + 1, np.int64)
                at = np.asarray(starts.values)
                np.add.at(change, at, 1)
                np.add.at(change, at + window, -1)
                gone = np.cumsum(change)[:-1] > 0
                removed.append(int(gone.sum()))
                rest.append(hashlib.sha256(b" ".join([x for x, g in zip(words, gone.tolist()) if not g])).digest())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(removed, pa.int64()), pa.array(rest, pa.binary())], names=names)

    return run


def remove_repeats(docs: DataFrame, window: int = 50, phrase: int = 16, shard_phrases: int = 40_000, task_words: int = 2_000_000) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256. shard_phrases and task_words bound what one task holds."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # a row is known by its doc_id and text, so that rows of one doc_id with different texts stay apart
    rows = rows.withColumn("row", F.xxhash64("doc_id", "text"))
    each = stored(_surveyed(rows, window, phrase), "survey")
    long_ = each.where(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
    classes = stored(long_.groupBy("s1", "s2", "n_words").agg(F.min(F.struct("doc_id", "row")).alias("first")), "classes")
    classes = classes.select("s1", "s2", "n_words", F.col("first.doc_id").alias("first_doc"), F.col("first.row").alias("first_row"))

    own = long_.select("row", "doc_id", "n_words", "marks").join(classes.select(F.col("first_row").alias("row")).distinct(), "row", "left_semi").dropDuplicates(["row"])
    places = own.select("row", "doc_id", "n_words", F.explode("marks").alias("mark"))
    held = places.groupBy("mark").agg(F.min(F.struct("doc_id", "row")).alias("first"), F.max("doc_id").alias("last"))
    held = held.where("first.doc_id < last").select("mark", F.col("first.row").alias("owner"))
    places = stored(places.join(held, "mark"), "marks")

    wanted = places.select("row").distinct()
    texts = stored(rows.join(wanted, "row", "left_semi").dropDuplicates(["row"]), "texts")

    firsts = places.where("row = owner").select("owner", "mark").distinct()
    shards = max(1, -(-firsts.count() // shard_phrases))
    shard = lambda c: F.pmod(F.xxhash64(c), F.lit(shards))
    given = texts.join(firsts.groupBy(F.col("owner").alias("row")).agg(F.collect_list("mark").alias("marks")), "row")
    phrases = given.select("row", "text", "marks").mapInArrow(_phrases(phrase), "mark long, owner long, phrase string").withColumn("shard", shard("owner"))

    routes = places.select("row", "n_words", shard("owner").alias("shard")).distinct()
    parts = routes.groupBy("shard").agg(F.ceil(F.sum("n_words") / task_words).alias("parts"))
    routes = routes.join(parts, "shard").select("row", "shard", F.pmod(F.xxhash64("row", F.lit(1)), "parts").alias("part"))
    streams = texts.join(routes, "row").select("shard", "part", "row", "doc_id", "text")
    dealt = phrases.join(parts, "shard").select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "mark", "phrase")
    found = dealt.groupBy("shard", "part").cogroup(streams.groupBy("shard", "part")).applyInArrow(_located(window, phrase), "h1 long, h2 long, row long, doc_id long, start long")

    found = stored(found, "windows")
    # minima combine before the shuffle, so a window that every document holds costs one row a task
    first = found.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").drop("last")
    repeated = found.join(first, ["h1", "h2"]).where("doc_id > first")
    starts = repeated.groupBy("row").agg(F.collect_list(F.col("start").cast("int")).alias("starts"))
    cut = texts.join(starts, "row").select("row", "text", "starts").mapInArrow(_kept(window), "row long, n_removed long, rest binary")

    copies = each.join(classes, ["s1", "s2", "n_words"], "left").drop("s1", "s2", "marks")
    copy = F.coalesce(F.col("doc_id") > F.col("first_doc"), F.lit(False))
    out = copies.join(cut, "row", "left")
    nothing = F.lit(hashlib.sha256(b"").digest())
    return out.select(
        "doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.lower(F.hex(F.when(copy, nothing).otherwise(F.coalesce("rest", "whole")))).alias("kept_sha256"),
    )
