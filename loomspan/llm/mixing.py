"""Mixing sources to target weights by cube-method balanced sampling.

A source's target over its size is the mean number of copies of each of its documents. The whole part is
taken outright. The fraction is an inclusion probability, which the flight phase of the cube method moves
through the null space of the balancing constraints (documents and their sizes) until it is 0 or 1. Blocks
of each source fly side by side. At most two documents a block stay undecided; they go on to the next
level, where far fewer blocks fly, and so on. The last two of a source land by rounding towards its total.

Defined results: a null or blank text has size 0; a null source is a source of its own, after all others;
repeated rows are decided one by one; sources whose sizes are all 0 get target 0; an empty table gives none.
Runs agree: blocks, order and directions come from hashes of what a row holds.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import n_words, stored

_TINY = 1e-9
#: Parts of a source that meet its totals in different tasks.
SALTS = 64
#: Stands for a null doc_id inside, so that ids stay 64-bit integers in pandas.
_NO_ID = -(1 << 63)


def targets(sizes: DataFrame, weights: tuple = (5, 2, 1), most: float = 3.0) -> DataFrame:
    """Rows (source_key, source_size, target). sizes: source_key, source_size, one row a source.

    Sources in code point order, null last, weigh weights in turn. Targets share the sum of all sizes by
    weight; one that would pass most times its source's size stops there, and the excess is shared anew.
    """
    numbered = sizes.withColumn("k", F.row_number().over(Window.orderBy(F.col("source_key") == "", "source_key")) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("k") % len(weights) + 1).cast("int"))
    numbered = stored(numbered.select("source_key", "source_size", weight.alias("weight"), (F.col("source_size") * float(most)).alias("cap")), "sources")
    level = 0.0
    while True:  # the level rises until no more sources stop; each round adds one stopped source at least
        stops = F.col("cap") <= F.col("weight") * level
        total, stopped, free = numbered.agg(F.sum("source_size"), F.sum(F.when(stops, F.col("cap"))), F.sum(F.when(~stops, F.col("weight")))).first()
        rises = (float(total or 0) - float(stopped or 0)) / free if free else level
        if rises <= level:
            break
        level = rises
    return numbered.select("source_key", "source_size", F.least("cap", F.col("weight") * level).alias("target"))


def flight(pi: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move fractional pi to 0 or 1 with sum(pi) and sum(pi * size) kept, until two or fewer are left."""
    pi = pi.copy()
    open_ = [i for i in range(len(pi)) if _TINY < pi[i] < 1 - _TINY]
    draws = rng.random(len(open_) + 3)
    active, nxt, step = open_[:3], 3, 0
    while len(active) == 3:
        a, b, c = active
        # null space of the rows (1, 1, 1) and (size a, size b, size c): their cross product
        u = np.array([size[c] - size[b], size[a] - size[c], size[b] - size[a]], float)
        if not u.any():
            u = np.array([1.0, -1.0, 0.0])
        p = pi[active]
        with np.errstate(divide="ignore", invalid="ignore"):
            up = np.where(u > 0, (1 - p) / u, np.where(u < 0, -p / u, np.inf)).min()
            down = np.where(u > 0, p / u, np.where(u < 0, (p - 1) / u, np.inf)).min()
        p = p + up * u if draws[step] * (up + down) < down else p - down * u
        step += 1
        p[p < _TINY], p[p > 1 - _TINY] = 0.0, 1.0
        pi[active] = p
        active = [i for i in active if 0 < pi[i] < 1]
        while len(active) < 3 and nxt < len(open_):
            active.append(open_[nxt])
            nxt += 1
        if len(active) == 3 and step >= len(draws):
            draws = np.concatenate([draws, rng.random(len(open_) + 3)])
    pi[pi <= _TINY], pi[pi >= 1 - _TINY] = 0.0, 1.0
    return pi


def _level(seed: int, landing: bool):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["order", "doc_id", "size", "text_key"], kind="stable").reset_index(drop=True)
        mark = abs(hash((seed, int(rows["order"].iloc[0]), len(rows)))) % (1 << 63)
        pi, size = rows["pi"].to_numpy(float), rows["size"].to_numpy(float)
        after = flight(pi, size, np.random.default_rng(mark))
        if landing:
            left = np.flatnonzero((after > 0) & (after < 1))
            owed = float((after[left] * size[left]).sum())
            for i in left[np.argsort(-size[left], kind="stable")]:
                take = 0 < size[i] <= 2 * owed
                after[i] = float(take)
                owed -= size[i] * take
        rows["pi"] = after
        return rows

    return run


def mix(docs: DataFrame, weights: tuple = (5, 2, 1), most: float = 3.0, seed: int = 11, block_rows: int = 4096, columns: tuple = ()) -> DataFrame:
    """One row a document: doc_id, size, source_size, target, taken and copies; then the named columns.

    taken is size times copies. Blocks hold about block_rows documents of one source, whatever its share.
    """
    carried = [c for c in columns if c not in ("doc_id", "size", "source_size", "target", "taken", "copies", "source")]
    base = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc_id"), F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("")).alias("source_key"),
        n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("text_key"), F.xxhash64("doc_id", F.lit(seed)).alias("order"), *carried,
    )
    base = stored(base, "sizes")
    per_source = base.groupBy("source_key").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    per_source = stored(per_source, "per_source")
    goal = targets(per_source.select("source_key", "source_size"), weights, most)
    goal = goal.join(per_source.select("source_key", "rows"), "source_key")
    # a source's one row goes to each of its salts, so that no task gets all documents of a large source
    salt = F.pmod(F.xxhash64("order", "text_key"), F.lit(SALTS))
    salts = goal.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    rows = base.withColumn("salt", salt).join(salts, ["source_key", "salt"]).drop("salt")
    mean = F.when(F.col("source_size") > 0, F.least(F.lit(float(most)), F.col("target") / F.col("source_size"))).otherwise(F.lit(0.0))
    whole = F.floor(mean + _TINY)
    rows = rows.withColumn("whole", whole).withColumn("pi", F.greatest(F.lit(0.0), mean - whole))
    rows = rows.withColumn("blocks", F.ceil(F.col("rows") / block_rows)).drop("rows")
    done, landing = [], False
    while True:
        dealt = rows.withColumn("block", F.pmod(F.xxhash64("order", "text_key", "blocks"), "blocks"))
        flown = dealt.groupBy("source_key", "block").applyInPandas(_level(seed, landing), dealt.schema)
        flown = stored(flown.drop("block"), "flown")
        decided = (F.col("pi") == 0) | (F.col("pi") == 1)
        done.append(flown.where(decided))
        if landing:
            break
        rows = flown.where(~decided)
        # two of each block go on: the next blocks are as full again
        landing = rows.agg(F.max("blocks")).first()[0] in (None, 1)
        rows = rows.withColumn("blocks", F.ceil(F.col("blocks") * 2 / block_rows))
    out = done[0]
    for more in done[1:]:
        out = out.union(more)
    copies = (F.col("whole") + F.col("pi")).cast("long")
    source = F.when(F.col("source_key") != "", F.expr("substring(source_key, 2)")).alias("source")
    return out.select(F.nullif("doc_id", F.lit(_NO_ID)).alias("doc_id"), "size", "source_size", "target", (F.col("size") * copies).alias("taken"), copies.alias("copies"), source, *carried)
