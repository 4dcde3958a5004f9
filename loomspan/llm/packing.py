"""Mixture-controlled packing into fixed windows by deficit round-robin over source queues.

Every source is a queue of documents in a keyed order. In each round, which fills one window, a source's
deficit grows by its share of the window, and the source sends whole documents while its deficit is positive;
what it overdraws or is owed carries to later windows. Sent documents are laid end to end and cut at window
ends, so only the last window is short.

To run on many machines, virtual time (tokens sent by a source over its weight) is cut into equal stretches.
What a source owes at the start of a stretch follows from its token prefix sum, so stretches run the same
round-robin side by side, each with the deficits that the one before leaves.

Ids are those of the tokenizers library, special tokens' strings in texts included.

Defined results: a null text is empty and packs as the end id alone; a null source is a source of its own;
repeated rows are packed one by one; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

import base64
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

_PIECES = 200_000
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, source string"


def encoder(ranks: str, vocabulary: str):
    """text -> the ids that the tokenizers library gives. Both files hold one vocabulary.

    tiktoken works them out several times faster. Where its pattern matcher gives up, as on very long runs of spaces,
    tokenizers itself does it; the ids are the same either way.
    """
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks, "rb") as file:
        table = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, file)}
    plain = Tokenizer.from_file(vocabulary)
    special = {token.content: number for number, token in plain.get_added_tokens_decoder().items()}
    fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens=special)

    def encode(text: str) -> list[int]:
        try:
            return fast.encode(text, allowed_special="all")
        except ValueError:
            return plain.encode(text, add_special_tokens=False).ids

    return encode


def tokenized(docs: DataFrame, ranks: str, vocabulary: str, end_id: int) -> DataFrame:
    """Rows (row_id, doc_id, source, n, ids): ids as little-endian unsigned 16-bit numbers, stored once."""

    def run(batches):
        encode = encoder(ranks, vocabulary)
        for batch in batches:
            text = batch.column(2)
            for at in range(0, batch.num_rows, 64):
                ids = [np.array([*x, end_id], "<u2") for x in map(encode, (t or "" for t in text.slice(at, 64).to_pylist()))]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(at, 64),
                        batch.column(1).slice(at, 64),
                        pa.array([len(x) for x in ids], pa.int64()),
                        pa.array([x.tobytes() for x in ids], pa.binary()),
                    ],
                    names=["doc_id", "source", "n", "ids"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"), F.col("text").cast("string"))
    return stored(rows.mapInArrow(run, "doc_id long, source string, n long, ids binary").withColumn("row_id", F.monotonically_increasing_id()), "tokens")


def _rounds(window: int, total_weight: float, stretch: float):
    """The round-robin of one stretch of virtual time: rows come back with their place in what it sends."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["source_key", "before"], kind="stable").reset_index(drop=True)
        n, weight, before = (rows[c].to_numpy() for c in ("n", "weight", "before"))
        first = np.flatnonzero(np.r_[True, rows["source_key"].to_numpy()[1:] != rows["source_key"].to_numpy()[:-1]])
        head, last = first.tolist(), [*first[1:].tolist(), len(rows)]
        since = float(rows["stretch"].iloc[0]) * stretch
        deficit = [weight[i] * since - before[i] for i in first]  # carried from the stretch before
        quantum = [weight[i] * window / total_weight for i in first]
        order: list[int] = []
        while len(order) < len(rows):
            for k in range(len(head)):
                deficit[k] += quantum[k]
                while head[k] < last[k] and deficit[k] > 0:
                    deficit[k] -= n[head[k]]
                    order.append(head[k])
                    head[k] += 1
        sent = n[order]
        return pd.DataFrame({"row_id": rows["row_id"].to_numpy()[order], "stretch": rows["stretch"].to_numpy(), "within": np.cumsum(sent) - sent})

    return run


def placed(lengths: DataFrame, window: int, weights: dict | None = None, seed: int = 7, block_rows: int = 4_000) -> DataFrame:
    """Rows (row_id, at): each document's first place in the stream that is cut into windows.

    lengths: row_id, doc_id, source, n. weights: source -> weight; None takes the sources' own token totals,
    so that all queues run dry together.
    """
    spark = lengths.sparkSession
    bits = max(0, (max(1, lengths.count()) // block_rows).bit_length())
    key = F.xxhash64("doc_id", F.lit(seed))
    rows = lengths.select(
        "row_id", "doc_id", "n", F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("source_key"), key.alias("key"),
        (F.shiftrightunsigned(key, 64 - bits) if bits else F.lit(0).cast("long")).alias("block"),
    )
    sums = rows.groupBy("source_key", "block").agg(F.sum("n").alias("tokens"))
    earlier = Window.partitionBy("source_key").orderBy("block")
    sums = stored(
        sums.select("source_key", "block", (F.sum("tokens").over(earlier) - F.col("tokens")).alias("base"), F.sum("tokens").over(Window.partitionBy("source_key")).alias("total")),
        "blocks",
    )
    if weights is not None:
        given = spark.createDataFrame([("" if k is None else f"={k}", float(v)) for k, v in weights.items()], "source_key string, given double")
        sums = sums.join(F.broadcast(given), "source_key", "left").withColumn("weight", F.coalesce("given", F.lit(1.0))).drop("given")
    else:
        sums = sums.withColumn("weight", F.col("total").cast("double"))
    whole = sums.groupBy("source_key").agg(F.first("weight").alias("weight"), F.first("total").alias("total"))
    span, total_weight = whole.agg(F.max(F.col("total") / F.col("weight")), F.sum("weight")).first()
    if span is None:
        return spark.createDataFrame([], "row_id long, at long")
    parts = 1 << bits
    within = Window.partitionBy("source_key", "block").orderBy("key", "doc_id", "row_id")
    rows = (
        rows.withColumn("upto", F.sum("n").over(within) - F.col("n"))
        .join(sums.select("source_key", "block", "base", "weight"), ["source_key", "block"])
        .withColumn("before", F.col("base") + F.col("upto"))
        .withColumn("stretch", F.least(F.floor(F.col("before") / F.col("weight") / F.lit(span) * parts), F.lit(parts - 1)).cast("long"))
    )
    sent = stored(
        rows.select("stretch", "source_key", "row_id", "n", "before", "weight")
        .groupBy("stretch")
        .applyInPandas(_rounds(window, total_weight, span / parts), "row_id long, stretch long, within long")
        .join(lengths.select("row_id", "n"), "row_id"),
        "sent",
    )
    bases = sent.groupBy("stretch").agg(F.sum("n").alias("tokens"))
    bases = bases.select("stretch", (F.sum("tokens").over(Window.orderBy("stretch")) - F.col("tokens")).alias("base"))
    return sent.join(bases, "stretch").select("row_id", (F.col("base") + F.col("within")).alias("at"))


def _cut(window: int):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "source"]

    def run(batches):
        for batch in batches:
            doc, source, at, n = (batch.column(i).to_pylist() for i in range(4))
            out = []
            for i in range(batch.num_rows):
                ids, start = np.frombuffer(batch.column(4)[i].as_buffer(), "<u2").astype("<u4"), 0
                while start < n[i]:
                    sequence, offset = divmod(at[i] + start, window)
                    length = min(window - offset, n[i] - start)
                    out.append((doc[i], start, length, zlib.crc32(ids[start : start + length].tobytes()), n[i], sequence, offset, source[i]))
                    start += length
            columns = list(zip(*out)) or [[]] * len(names)
            kinds = [pa.int64()] * 7 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return run


def pack(docs: DataFrame, ranks: str, vocabulary: str, window: int = 2048, end_id: int = 1, weights: dict | None = None) -> DataFrame:
    """Pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, source."""
    tokens = tokenized(docs, ranks, vocabulary, end_id)
    places = placed(tokens.select("row_id", "doc_id", "source", "n"), window, weights)
    rows = tokens.join(places.hint("shuffle_hash"), "row_id").select("doc_id", "source", "at", "n", "ids")
    return rows.mapInArrow(_cut(window), _PIECES)
