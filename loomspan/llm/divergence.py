"""Source divergence audit: every source of a language against its peers and against the language, over all kept terms.

Terms are counted in tasks and summed; a language keeps the terms of enough documents, dealt into blocks of bounded size.
A group (language, source) has one compressed vector of shares a block. The comparison is a systolic rotation: a language's
groups are the players of a round-robin tournament (circle method), each stays resident with its vectors in the partition
that its place hashes to, cached there, and in every round the vectors of one side of each meeting travel to the other, so
that after all rounds each pair has met once; a meeting yields both directions. Rounds go in sweeps, each of a bounded
number of rounds and stored before the next: only a sweep's vectors are on their way at a time. Terms that a group overuses
are ranked by heaps in the tasks that hold its counts; the heaps' few entries are merged.

All arithmetic is in whole numbers. Defined results: null text, lang and source are ''; a group without kept terms has the
same share for each; without any kept term in the language pairs have value 0 and there are no terms; a language of one source has no
pairs; repeated rows count as documents each; an empty table gives none; other columns are ignored.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import stored

_TERM = re.compile(rb"[a-z\x80-\xff]+")
#: A task's counts go on when it holds so many.
HELD = 200_000


def _count(batches):
    """Terms of documents (lang, source, text): rows (lang, source, term, n, docs), summed over as much as a task holds."""

    def rows():
        keys, terms, n, docs = [], [], [], []
        for key, counts in total.items():
            keys += [key] * len(counts)
            terms += counts.keys()
            n += [c[0] for c in counts.values()]
            docs += [c[1] for c in counts.values()]
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array(terms, pa.binary()).cast(pa.string()), pa.array(n, pa.int64()), pa.array(docs, pa.int64())]
        return pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "docs"])

    total, held = defaultdict(dict), 0
    for batch in batches:
        langs, sources = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for i in range(batch.num_rows):
            text = batch.column(2)[i].as_buffer()
            if text is None or not text.size:
                continue
            mine = total[langs[i], sources[i]]
            before = len(mine)
            for term, c in Counter(_TERM.findall(text.to_pybytes().lower())).items():
                seen = mine.get(term)
                if seen is None:
                    mine[term] = [c, 1]
                else:
                    seen[0] += c
                    seen[1] += 1
            held += len(mine) - before
            if held > HELD:
                yield rows()
                total.clear()
                held = 0
    if held:
        yield rows()


def share(n: np.ndarray, total: np.ndarray | int, kept: np.ndarray | int, more: int = 5, unit: tuple = (1000, 1000, 1000)) -> np.ndarray:
    """1 + floor(10**9 * (n + more) / (total + more * kept)), by long division, so that nothing leaves 64 bits."""
    below = np.asarray(total + more * np.asarray(kept, np.int64), np.int64)
    rest, found = np.asarray(n, np.int64) + more, np.zeros(np.shape(n), np.int64)
    whole, rest = np.divmod(rest, below)
    found = whole
    for step in unit:
        digit, rest = np.divmod(rest * step, below)
        found = found * step + digit
    return found + 1


def opponent(slot: Column, round_: Column, players: Column) -> Column:
    """Whom a player meets in a round of the circle method, players being even; the last player keeps its seat."""
    circle = players - 1
    other = F.pmod(round_ - slot, circle)
    middle = F.pmod(round_ * (players / 2).cast("long"), circle)  # the player who would meet themself
    return F.when(slot == circle, middle).when(other == slot, circle).otherwise(other)


def _packed(batches):
    """A compressed vector of shares a group and block, from its counts at places of the block."""
    for batch in batches:
        width, total, kept, at, n = (batch.column(batch.schema.get_field_index(c)) for c in ("width", "total", "kept", "at", "n"))
        vectors = []
        for w, t, v, a, c in zip(width.to_pylist(), total.to_pylist(), kept.to_pylist(), at, n):
            counts = np.zeros(w, np.int64)
            if a.is_valid:
                counts[a.values.to_numpy()] = c.values.to_numpy()
            vectors.append(zlib.compress(share(counts, t, v).astype("<u4").tobytes(), 1) if w else b"")
        yield pa.RecordBatch.from_arrays([*(batch.column(batch.schema.get_field_index(c)) for c in ("lang", "slot", "block")), pa.array(vectors, pa.binary())], names=["lang", "slot", "block", "vector"])


def _met(batches):
    """Meetings (lang, host, guest, its vector, the guest's): absolute differences, summed over the blocks a task has."""
    total: dict[tuple, int] = defaultdict(int)
    for batch in batches:
        lang, host, guest = (batch.column(i).to_pylist() for i in range(3))
        for i, key in enumerate(zip(lang, host, guest)):
            a, b = batch.column(3)[i].as_py(), batch.column(4)[i].as_py()
            value = 0
            if a:
                mine, other = (np.frombuffer(zlib.decompress(x), "<u4").astype(np.int64) for x in (a, b))
                value = int(np.abs(mine - other).sum())
            total[key] += value
        if len(total) > HELD:
            yield _both(total)
            total.clear()
    if total:
        yield _both(total)


def _both(total: dict) -> pa.RecordBatch:
    lang, host, guest = zip(*total)
    value = list(total.values())
    return pa.RecordBatch.from_arrays([pa.array([*lang, *lang], pa.string()), pa.array([*host, *guest], pa.int64()), pa.array([*guest, *host], pa.int64()), pa.array(value + value, pa.int64())], names=["lang", "slot", "peer", "value"])


def _heaps(top: int):
    """The terms of largest value of each group that a task sees, at most `top` a group."""

    def rows(heaps):
        out = [(lang, source, term, value) for (lang, source), heap in heaps.items() for value, term in ((-v, t) for v, t in heap)]
        lang, source, term, value = zip(*out) if out else ((),) * 4
        return pa.RecordBatch.from_arrays([pa.array(lang, pa.string()), pa.array(source, pa.string()), pa.array(term, pa.binary()).cast(pa.string()), pa.array(value, pa.int64())], names=["lang", "source", "item", "value"])

    def run(batches):
        heaps: dict[tuple, list] = {}
        for batch in batches:
            column = {c: batch.column(batch.schema.get_field_index(c)) for c in batch.schema.names}
            n, total, whole, all_, kept = (column[c].to_numpy(zero_copy_only=False) for c in ("n", "total", "whole", "lang_total", "kept"))
            over = share(n, total, kept) - share(whole, all_, kept)
            used = np.flatnonzero((over > 0) & (n > 0))
            pick = pa.array(used)
            lang, source, term = (column[c].take(pick).to_pylist() for c in ("lang", "source", "term"))
            found = defaultdict(list)
            for a, b, t, v in zip(lang, source, term, over[used].tolist()):
                found[a, b].append((-v, t.encode()))
            for key, more in found.items():
                heaps[key] = heapq.nsmallest(top, [*heaps.get(key, ()), *more])
            if len(heaps) * top > 10 * HELD:
                yield rows(heaps)
                heaps = {}
        if heaps:
            yield rows(heaps)

    return run


def _rounds(first: int, many: int) -> Column:
    """Rounds first to first + many - 1 that a language of so many players has; none for a smaller one."""
    last = F.least(F.col("players") - 1, F.lit(first + many)) - 1
    return F.when(last >= first, F.sequence(F.lit(first).cast("long"), last.cast("long"), F.lit(1).cast("long"))).otherwise(F.array().cast("array<bigint>"))


def audit(docs: DataFrame, least_docs: int = 30, top: int = 50, block_terms: int = 4096, sweep_rounds: int = 8) -> DataFrame:
    """Rows (lang, source, part, item, value, rank) of all pairs of sources of a language and of each group's overused terms.

    least_docs: documents of the language a kept term occurs in. top: ranks of terms. block_terms: terms a block, about;
    sweep_rounds: rounds of the tournament whose vectors travel at a time.
    """
    spark = docs.sparkSession
    plain = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = plain.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    counts = counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("whole"), F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("sources"))
    terms = stored(terms.where(F.col("docs") >= least_docs).drop("docs"), "terms")

    # groups, their sizes and their seats in the tournament; a seat is a source's place among the language's
    of_lang = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("whole").alias("lang_total"))
    held = terms.select("lang", F.explode("sources").alias("s")).groupBy("lang", F.col("s.source").alias("source")).agg(F.sum("s.n").alias("total"))
    seats = plain.groupBy("lang", "source").agg(F.count("*").alias("rows")).withColumn("slot", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1)
    many = seats.groupBy("lang").agg(F.count("*").alias("groups"))
    groups = seats.join(many, "lang").join(of_lang, "lang", "left").join(held, ["lang", "source"], "left")
    groups = groups.fillna(0, ["kept", "lang_total", "total"]).withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("kept") / block_terms)))
    groups = stored(groups.withColumn("players", F.col("groups") + F.col("groups") % 2).drop("rows"), "groups")

    # terms at their places in blocks
    blocks = groups.groupBy("lang").agg(F.first("blocks").alias("blocks"))
    placed = terms.join(blocks, "lang").withColumn("block", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("long")).drop("blocks")
    placed = placed.withColumn("at", F.row_number().over(Window.partitionBy("lang", "block").orderBy("term")) - 1)
    placed = stored(placed, "placed")
    widths = placed.groupBy("lang", "block").agg(F.count("*").cast("int").alias("width"))
    cells = placed.select("lang", "term", "whole", "block", "at", F.explode("sources").alias("s")).select("lang", "term", "whole", "block", "at", "s.source", "s.n")

    # the resident vectors: one a group and block, whether the group has terms there or not
    lists = cells.groupBy("lang", "source", "block").agg(F.collect_list(F.struct("at", "n")).alias("c"))
    lists = lists.select("lang", "source", "block", F.col("c.at").alias("at"), F.col("c.n").alias("n"))
    grid = groups.select("lang", "source", "slot", "total", "kept", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    grid = grid.join(widths, ["lang", "block"], "left").join(lists, ["lang", "source", "block"], "left").fillna(0, ["width"])
    vectors = stored(grid.mapInArrow(_packed, "lang string, slot long, block long, vector binary"), "vectors")

    seats = groups.select("lang", "slot", "source", "players")
    rounds = (groups.agg(F.max("players")).first()[0] or 1) - 1
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    residents = vectors.select("lang", F.col("slot").alias("host"), "block", F.col("vector").alias("own")).repartition(parts, "lang", "host", "block").persist(StorageLevel.MEMORY_AND_DISK)
    sums = []
    for first in range(0, rounds, sweep_rounds):
        games = seats.withColumn("round", F.explode(_rounds(first, sweep_rounds)))
        games = games.withColumn("host", opponent(F.col("slot"), F.col("round"), F.col("players")))
        # of the two the one of even sum of seats and the smaller seat stays, or else the larger
        away = F.when((F.col("slot") + F.col("host")) % 2 == 0, F.col("slot") > F.col("host")).otherwise(F.col("slot") < F.col("host"))
        games = games.where(away).select("lang", F.col("slot").alias("guest"), "host")
        guests = vectors.withColumnRenamed("slot", "guest").join(games, ["lang", "guest"]).select("lang", "host", "block", "guest", F.col("vector").alias("other"))
        met = residents.join(guests.hint("shuffle_hash"), ["lang", "host", "block"]).select("lang", "host", "guest", "own", "other")
        met = met.mapInArrow(_met, "lang string, slot long, peer long, value long")
        sums.append(stored(met.groupBy("lang", "slot", "peer").agg(F.sum("value").alias("value")), "sweep"))
    residents.unpersist()

    heaps = cells.join(groups.select("lang", "source", "total", "lang_total", "kept"), ["lang", "source"]).select("lang", "source", "term", "n", "whole", "total", "lang_total", "kept")
    best = heaps.mapInArrow(_heaps(top), "lang string, source string, item string, value long")
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), F.col("item"))
    out = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank")
    for found in sums[:1]:
        for more in sums[1:]:
            found = found.union(more)
        named = found.join(seats.drop("players"), ["lang", "slot"]).join(seats.select("lang", F.col("slot").alias("peer"), F.col("source").alias("item")), ["lang", "peer"])
        pairs = named.withColumn("rank", F.row_number().over(order))
        out = pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank").union(out)
    return out


ORACLE_SQL = """
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents),
t AS (SELECT row, lang, source, unnest(terms) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 30),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
groups AS (SELECT g.lang, g.source, coalesce(v.v, 0) AS v, coalesce(sum(c.n), 0) AS total FROM g LEFT JOIN v USING (lang) LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS MATERIALIZED (SELECT lang, source, term, coalesce(c.n, 0) AS n, (1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 5) // (total + 5 * v))::BIGINT AS p
  FROM groups JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
w AS (SELECT lang, term, (1 + 1000000000::HUGEINT * (sum(n) + 5) // (sum(sum(n)) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang)))::BIGINT AS p FROM c GROUP BY lang, term),
pair AS (SELECT m.lang, m.source, 'pair' AS part, m.peer AS item, coalesce(sum(abs(a.p - b.p)), 0)::BIGINT AS value
  FROM (SELECT x.lang, x.source, y.source AS peer FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source) m
  LEFT JOIN p a ON a.lang = m.lang AND a.source = m.source LEFT JOIN p b ON b.lang = m.lang AND b.source = m.peer AND b.term = a.term
  GROUP BY m.lang, m.source, m.peer),
term AS (SELECT p.lang, p.source, 'term' AS part, term AS item, p.p - w.p AS value FROM p JOIN w USING (lang, term) WHERE p.n > 0 AND p.p > w.p),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM (FROM pair UNION ALL FROM term))
SELECT lang, source, part, item, value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
