"""Vector code compression: a product code whose nearest entries are found by annular norm pruning.

Vectors become integers and are cut into equal parts; each part position has its own codebook of a few entries, improved in
rounds. The search for a part's nearest entry sorts the entries by norm: an entry whose norm differs from the part's by more
than the best distance so far can't be nearer, so only the annulus of norms within that distance, borders included, is
evaluated exactly, from the entry of the nearest norm outwards; its interval is found by binary search and shrinks with the
best distance. Ties go to the lower index. Each task sums its parts by entry before anything is shuffled; a round's
codebooks (entries times vector length integers) are the only thing the driver sees.

Defined results: rows whose vector is null or holds null or non-finite components are dropped, as are those of another length
than the first seed's; a length that the number of parts doesn't divide, or components of 2**28 or more after scaling, are
errors (sums of squares would leave 64 bits). Seeds are the smallest distinct ids, null last, of equal ids the smallest
vector; with fewer ids than entries the codebooks are as much smaller. Repeated rows count and are returned one by one; an
empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

#: Scaled components stay below this in size.
LIMIT = 1 << 28
#: Labels are dealt to so many salts each.
SALTS = 16


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Index of the nearest entry of book and squared distance of each row of parts, and how many distances were evaluated.

    Norms are floats, so the annulus is widened by their rounding; distances are exact integers.
    """
    n, k = len(parts), len(book)
    length = np.sqrt((book.astype(float) ** 2).sum(axis=1))
    order = np.lexsort((np.arange(k), length))
    norms, mine = length[order], np.sqrt((parts.astype(float) ** 2).sum(axis=1))
    after = np.clip(np.searchsorted(norms, mine), 1, max(1, k - 1))
    start = np.where(np.abs(norms[after - 1] - mine) <= np.abs(norms[np.minimum(after, k - 1)] - mine), after - 1, np.minimum(after, k - 1))

    def exact(rows: np.ndarray, at: np.ndarray) -> np.ndarray:
        away = parts[rows] - book[order[at]]
        return np.einsum("ij,ij->i", away, away)

    every = np.arange(n)
    best, entry, evaluated = exact(every, start), order[start], n
    low, high, active = np.zeros(n, np.int64), np.full(n, k), every
    for step in range(1, k):
        reach = np.sqrt(best[active].astype(float)) * (1 + 1e-12) + 1e-6 + mine[active] * 1e-12
        low[active] = np.searchsorted(norms, mine[active] - reach, "left")
        high[active] = np.searchsorted(norms, mine[active] + reach, "right")
        active = active[(start[active] - step >= low[active]) | (start[active] + step < high[active])]
        if not len(active):
            break
        for side in (-step, step):
            at = start[active] + side
            inside = (at >= low[active]) & (at < high[active])
            rows, at = active[inside], at[inside]
            found, evaluated = exact(rows, at), evaluated + len(rows)
            better = (found < best[rows]) | ((found == best[rows]) & (order[at] < entry[rows]))
            best[rows[better]], entry[rows[better]] = found[better], order[at][better]
    return entry, best, evaluated


@dataclass
class Books:
    """Codebooks: entries[p] has the entries of part position p as rows of integers."""

    entries: np.ndarray

    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def search(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry of each part of each row, and the row's squared distances summed."""
        parts = vectors.reshape(len(vectors), len(self.entries), -1)
        found = [nearest(parts[:, p], book) for p, book in enumerate(self.entries)]
        return np.stack([f[0] for f in found], axis=1), np.sum([f[1] for f in found], axis=0)


def whole_numbers(column: pa.Array, size: int, scale: int) -> np.ndarray:
    """The vectors of a column without nulls as rows of integers, rounded down."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, size)
    scaled = np.floor(flat * scale)
    if len(scaled) and np.abs(scaled).max() >= LIMIT:
        raise ValueError(f"scaled components have to be below {LIMIT} in size")
    return scaled.astype(np.int64)


def usable(rows: DataFrame, vector: str) -> DataFrame:
    """Rows whose vector has finite components only."""
    x = F.col(vector).cast("array<double>")
    return rows.where(F.col(vector).isNotNull() & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))))


def seeds(rows: DataFrame, key: str, vector: str, parts: int, entries: int, scale: int) -> Books | None:
    """Codebooks of the smallest keys' vectors: at most `entries` rows come to the driver."""
    first = rows.select(key).distinct().orderBy(F.col(key).asc_nulls_last()).limit(entries)
    found = rows.join(F.broadcast(first.withColumnRenamed(key, "_k")), F.col(key).eqNullSafe(F.col("_k")), "left_semi").groupBy(key).agg(F.min(F.col(vector).cast("array<double>")).alias("v"))
    vectors = [r["v"] for r in found.orderBy(F.col(key).asc_nulls_last()).collect()]
    vectors = [v for v in vectors if len(v) == len(vectors[0])]
    if not vectors:
        return None
    size = len(vectors[0])
    if size % parts or not size:
        raise ValueError(f"vectors of length {size} can't be cut into {parts} equal parts")
    whole = whole_numbers(pa.array(vectors, pa.list_(pa.float64())), size, scale)
    return Books(np.ascontiguousarray(whole.reshape(len(whole), parts, -1).transpose(1, 0, 2)))


def _sums(books: Books, scale: int):
    """Sums and counts of the parts that fall to each entry, a row an entry and task."""
    p, k, d = books.entries.shape

    def run(batches):
        total, count = np.zeros((p, k, d), np.int64), np.zeros((p, k), np.int64)
        for batch in batches:
            vectors = whole_numbers(batch.column(0), p * d, scale)
            entry, _ = books.search(vectors)
            cut = vectors.reshape(len(vectors), p, d)
            for i in range(p):
                np.add.at(total[i], entry[:, i], cut[:, i])
                count[i] += np.bincount(entry[:, i], minlength=k)
        at, to = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(to), pa.array(count[at, to]), pa.array(list(total[at, to]), pa.list_(pa.int64()))], names=["part", "entry", "n", "total"])

    return run


def improved(vectors: DataFrame, books: Books, scale: int) -> Books:
    """The codebooks after one round: entries that got parts move to their floored mean."""
    p, k, d = books.entries.shape
    sums = vectors.mapInArrow(_sums(books, scale), "part long, entry long, n long, total array<long>")
    every = sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.get("total", F.lit(i))).alias(f"t{i}") for i in range(d)])
    entries = books.entries.copy()
    for row in every.collect():  # at most parts times entries rows
        entries[row["part"], row["entry"]] = [row[f"t{i}"] // row["n"] for i in range(d)]
    return Books(entries)


def _codes(books: Books, scale: int):
    p, _, d = books.entries.shape

    def run(batches):
        for batch in batches:
            entry, error = books.search(whole_numbers(batch.column(2), p * d, scale))
            codes = ["".join(f"{c:02x}" for c in row) for row in entry.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(codes, pa.string()), pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])

    return run


def trained(vectors: DataFrame, key: str, vector: str, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> Books | None:
    """Codebooks after all rounds; None for a table without usable vectors."""
    rows = usable(vectors, vector)
    books = seeds(rows, key, vector, parts, entries, scale)
    if books is not None:
        fitting = rows.where(F.size(vector) == books.entries.shape[0] * books.entries.shape[2]).select(F.col(vector).cast("array<double>").alias("v"))
        for _ in range(rounds):
            books = improved(fitting, books, scale)
    return books


def compress(vectors: DataFrame, parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> DataFrame:
    """One row a usable vector: vec_id, code, error, label_error, codebooks_sha256.

    Up to 256 entries a part: a code has two hex digits a part.
    """
    if entries > 256:
        raise ValueError("a code holds 256 entries at most")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").alias("label"), F.col("embedding").alias("embedding"))
    books = trained(rows, "vec_id", "embedding", parts, entries, rounds, scale)
    if books is None:
        return vectors.sparkSession.createDataFrame([], "vec_id long, code string, error long, label_error long, codebooks_sha256 string")
    size = books.entries.shape[0] * books.entries.shape[2]
    kind = rows.schema["label"].dataType.simpleString()
    fitting = usable(rows, "embedding").where(F.size("embedding") == size).select("vec_id", "label", F.col("embedding").cast("array<double>"))
    coded = stored(fitting.mapInArrow(_codes(books, scale), f"vec_id long, label {kind}, code string, error long"), "codes")
    totals = coded.groupBy("label").agg(F.sum("error").alias("label_error"))
    # a label's one row goes to each of its salts, so that no task gets all rows of a large label
    salted = totals.select(F.struct("label").alias("of"), "label_error", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    keyed = coded.select("vec_id", "code", "error", F.struct("label").alias("of"), F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int").alias("salt"))
    joined = keyed.alias("k").join(salted.alias("s"), F.col("k.of").eqNullSafe(F.col("s.of")) & (F.col("k.salt") == F.col("s.salt")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256"))


def _oracle(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The same in DuckDB: each round's codebooks and their use as two expressions."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""d{r} AS (
          SELECT v.row, v.part, b.entry, list_sum(list_transform(list_zip(v.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS far
          FROM cuts v JOIN b{r} b USING (part)),
        a{r} AS MATERIALIZED (SELECT row, part, (min({{'far': far, 'entry': entry}})).entry AS entry, min(far) AS far FROM d{r} GROUP BY row, part)""")
        if r < rounds:
            steps.append(f"""m{r} AS (
          SELECT part, entry, list(floor_mean ORDER BY pos) AS x FROM (
            SELECT a.part, a.entry, u.pos, (CASE WHEN sum(u.c) >= 0 OR sum(u.c) % count(*) = 0 THEN sum(u.c) // count(*) ELSE sum(u.c) // count(*) - 1 END)::BIGINT AS floor_mean
            FROM a{r} a JOIN flat u USING (row, part) GROUP BY ALL) GROUP BY part, entry),
        b{r + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.x, b.x) AS x FROM b{r} b LEFT JOIN m{r} m USING (part, entry))""")
    return f"""
    WITH kept AS (
      SELECT row_number() OVER (ORDER BY vec_id) AS row, vec_id, label, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})::BIGINT) AS x
      FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
    places AS (SELECT unnest(range({parts})) AS part),
    cuts AS MATERIALIZED (SELECT row, part, x[part * (len(x) // {parts}) + 1 : (part + 1) * (len(x) // {parts})] AS x FROM kept, places),
    flat AS MATERIALIZED (SELECT row, part, unnest(x) AS c, unnest(range(len(x))) AS pos FROM cuts),
    b0 AS MATERIALIZED (SELECT part, row - 1 AS entry, x FROM cuts WHERE row <= {entries}),
    {", ".join(steps)},
    books AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY part, entry)) AS digest FROM b{rounds}),
    codes AS (SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(far)::BIGINT AS error FROM a{rounds} GROUP BY row)
    SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, digest AS codebooks_sha256
    FROM codes JOIN kept USING (row), books"""


ORACLE_SQL = _oracle()
