"""Interval algebra over located features: ref, begin, end (closed, 1-based), strand.

Joins deal intervals into bins and join on (ref, bin). A pair is kept in one bin only, the one that holds the larger
begin, so no distinct follows. A bin bounds how many rows of one place meet in a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.session import cut

BIN = 1000


def binned(df: DataFrame, size: int = BIN, reach: int = 0, begin: str = "begin", end: str = "end", to: str = "bin") -> DataFrame:
    """One row for every bin that begin - reach .. end + reach touches."""
    first, last = (F.floor((F.col(begin) - reach) / size), F.floor((F.col(end) + reach) / size))
    return df.withColumn(to, F.explode(F.sequence(first, F.greatest(first, last))))


def overlap_pairs(
    probe: DataFrame, build: DataFrame, size: int = BIN, strand: str | None = None, mode: str = "overlap",
    reach: int = 0, percent: float | None = None, slop: int = 3,
) -> DataFrame:
    """Pairs of probe (p_*) and build (b_*) rows on one ref, with overlap (bases, at least 0 where near).

    strand: None, 'same' (unknown matches either) or 'opposite' (both known). mode: 'overlap', 'inside' (build
    within probe), 'same' (both ends within slop) or 'near' (overlapping or closer than reach). percent: least
    overlap over the shorter extent, extents being end - begin, or 1 where that is 0.
    """
    margin = reach if mode == "near" else slop if mode == "same" else 0
    p = binned(probe.select([F.col(c).alias(f"p_{c}") for c in probe.columns]), size, margin, "p_begin", "p_end")
    b = binned(build.select([F.col(c).alias(f"b_{c}") for c in build.columns]), size, 0, "b_begin", "b_end")
    pb, pe, bb, be = (F.col(c) for c in ("p_begin", "p_end", "b_begin", "b_end"))
    on = (F.col("p_ref") == F.col("b_ref")) & (p["bin"] == b["bin"]) & (pb - margin <= be) & (pe + margin >= bb)
    on &= p["bin"] == F.floor(F.greatest(pb - margin, bb) / size)
    if mode == "inside":
        on &= (pb <= bb) & (pe >= be)
    elif mode == "same":
        on &= (F.abs(pb - bb) <= slop) & (F.abs(pe - be) <= slop)
    elif mode == "near":
        on &= ((pb <= be) & (pe >= bb)) | (F.least(F.abs(pb - be), F.abs(bb - pe)) < reach)
    if strand == "same":
        on &= (F.col("p_strand") == F.col("b_strand")) | (F.col("p_strand") == ".") | (F.col("b_strand") == ".")
    elif strand == "opposite":
        on &= (F.col("p_strand") != F.col("b_strand")) & (F.col("p_strand") != ".") & (F.col("b_strand") != ".")
    shared = F.least(pe, be) - F.greatest(pb, bb) + 1
    if percent is not None:
        least = F.least(F.abs(pe - pb), F.abs(be - bb))
        on &= shared / F.when(least == 0, 1).otherwise(least) >= percent
    return p.join(b, on).drop("bin").withColumn("overlap", F.greatest(shared, F.lit(0)))


def running(df: DataFrame, keys: list[str], place: list[str], begin: str, block: int, sums: dict[str, Column] | None = None, most: dict[str, Column] | None = None) -> DataFrame:
    """Adds running totals before each row of its keys, in order of place: of sums (names with what they add up) and of most (highest values).

    Rows are dealt by keys and block, begin div block, so that no task has to hold one key's rows: windows run within a
    block, and a window over one row a block carries what the blocks before hold. place begins with begin.
    """
    sums, most = sums or {}, most or {}
    rows = cut(df.withColumn("_block", F.floor(F.col(begin) / block)))  # read twice below
    within = Window.partitionBy(*keys, "_block").orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy(*keys, "_block").agg(*[F.sum(c).alias(f"_{n}") for n, c in sums.items()], *[F.max(c).alias(f"_{n}") for n, c in most.items()])
    carried = totals.select(*keys, "_block", *[F.sum(f"_{n}").over(over).alias(f"_{n}") for n in sums], *[F.max(f"_{n}").over(over).alias(f"_{n}") for n in most])
    rows = rows.withColumns({n: F.sum(c).over(within) for n, c in sums.items()} | {n: F.max(c).over(within) for n, c in most.items()})
    left, right = rows.alias("l"), carried.alias("r")
    on = F.col("l._block") == F.col("r._block")
    for k in keys:
        on &= F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}"))
    both = {n: F.coalesce(F.col(f"l.{n}") + F.col(f"r._{n}"), F.col(f"l.{n}"), F.col(f"r._{n}"), F.lit(0)) for n in sums}
    both |= {n: F.greatest(f"l.{n}", f"r._{n}") for n in most}
    return left.join(right, on).select(*[F.col(f"l.{c}") for c in df.columns], *[c.alias(n) for n, c in both.items()])


def islands(df: DataFrame, keys: list[str], begin: str = "begin", end: str = "end", gap: int = 0, block: int | None = None) -> DataFrame:
    """Adds island: a number per keys, rows whose spans touch or lie at most gap bases apart sharing one.

    block: deal a key's rows by so many bases, for keys that hold more rows than a task should (a whole scaffold).
    """
    if block is not None:
        rows = running(df, keys, [begin, end], begin, block, most={"_before": F.col(end)})
        rows = rows.withColumn("_new", F.when(F.col("_before").isNull() | (F.col(begin) > F.col("_before") + 1 + gap), 1).otherwise(0))
        rows = running(rows, keys, [begin, end, F.desc("_new")], begin, block, sums={"_starts": F.col("_new")})
        return rows.withColumn("island", F.col("_starts") + F.col("_new")).drop("_before", "_new", "_starts")
    earlier = Window.partitionBy(*keys).orderBy(begin, end)
    before = F.max(end).over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(before.isNull() | (F.col(begin) > before + 1 + gap), 1).otherwise(0)
    return df.withColumn("_new", new).withColumn("island", F.sum("_new").over(earlier.rowsBetween(Window.unboundedPreceding, 0))).drop("_new")


def merged(df: DataFrame, keys: list[str], begin: str = "begin", end: str = "end", gap: int = 0, block: int | None = None) -> DataFrame:
    """Union of spans per keys: begin, end and the number of spans in each. block: as in islands."""
    rows = islands(df, keys, begin, end, gap, block).groupBy(*keys, "island")
    return rows.agg(F.min(begin).alias(begin), F.max(end).alias(end), F.count("*").alias("spans")).drop("island")


def union_bases(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Bases of each probe that any of its build rows covers."""
    clipped = pairs.withColumn("begin", F.greatest("p_begin", "b_begin")).withColumn("end", F.least("p_end", "b_end"))
    spans = merged(clipped.select(*keys, "begin", "end"), keys)
    return spans.groupBy(*keys).agg(F.sum(F.col("end") - F.col("begin") + 1).alias("union_bases"))


def covered(build: DataFrame, block: int = 1_000_000) -> DataFrame:
    """The bases of each ref that any span covers, as disjoint spans: ref, begin, end. Probes meet few of these, however deep spans lie."""
    return merged(build.where("end >= begin").select("ref", "begin", "end"), ["ref"], block=block).select("ref", "begin", "end")


def difference(probe: DataFrame, build: DataFrame, key: str, size: int = BIN) -> DataFrame:
    """Pieces of each probe outside all build spans: piece number, pieces, begin, end and length."""
    pairs = overlap_pairs(probe, covered(build), size)
    cuts = pairs.select(F.col(f"p_{key}").alias(key), F.greatest("p_begin", "b_begin").alias("begin"), F.least("p_end", "b_end").alias("end"))
    # a probe's own row stands before its cuts and brings its end
    edges = probe.select(key, F.col("begin").alias("from"), (F.col("begin") - 1).alias("end"), F.col("end").alias("stop"))
    points = cuts.select(key, F.col("begin").alias("from"), "end", F.lit(None).cast("long").alias("stop")).unionByName(edges)
    order = Window.partitionBy(key).orderBy("end", "from")
    rows = points.withColumn("next", F.lead("from").over(order)).withColumn("stop", F.max("stop").over(order))
    rows = rows.select(key, (F.col("end") + 1).alias("begin"), F.coalesce(F.col("next") - 1, F.col("stop")).alias("end")).where("begin <= end")
    number = Window.partitionBy(key).orderBy("begin")
    return rows.select(
        key, F.row_number().over(number).alias("piece"), F.count("*").over(Window.partitionBy(key)).alias("pieces"),
        "begin", "end", (F.col("end") - F.col("begin") + 1).alias("length"),
    )


def coverage(df: DataFrame, keys: list[str], value: str | Column = "score", block: int | None = None) -> DataFrame:
    """Step function of summed values: maximal runs of constant sum, zero runs left out. block: as in islands."""
    value = F.col(value) if isinstance(value, str) else value
    points = df.select(*keys, F.explode(F.array(F.struct(F.col("begin").alias("at"), value.alias("d")), F.struct((F.col("end") + 1).alias("at"), (-value).alias("d")))).alias("x"))
    points = points.groupBy(*keys, F.col("x.at").alias("at")).agg(F.sum("x.d").alias("d")).where("d <> 0")
    if block is None:
        order = Window.partitionBy(*keys).orderBy("at")
        rows = points.withColumn("value", F.sum("d").over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("next", F.lead("at").over(order))
    else:  # the sum so far, less the change at the next point, is looked at from there
        rows = running(points, keys, ["at"], "at", block, sums={"value": F.col("d")}, most={"next": F.col("at")})
        rows = rows.select(*keys, F.col("next").alias("at"), "value", F.col("at").alias("next")).where("at is not null")
    return rows.where("value <> 0 and next is not null").select(*keys, F.col("at").alias("begin"), (F.col("next") - 1).alias("end"), "value")


def window_density(df: DataFrame, window: int, kind: str = "type") -> DataFrame:
    """Per ref, window and kind: features, bases inside the window and score of those that touch it."""
    rows = binned(df, window, to="window")
    low = F.col("window") * window
    bases = F.least(F.col("end"), low + window - 1) - F.greatest(F.col("begin"), low) + 1
    return rows.groupBy("ref", "window", kind).agg(F.count("*").alias("features"), F.sum(bases).alias("bases"), F.sum("score").alias("score"))


def splice_matches(exons: DataFrame, introns: DataFrame, key: str, size: int = BIN) -> DataFrame:
    """Exons with an intron whose end abuts theirs: signed counts by strand and the introns' ids.

    An intron fits an exon's left end when it ends one base before it, its right end when it begins one after.
    """
    ends = exons.select(key, "ref", "strand", F.explode(F.array(F.struct(F.lit("L").alias("side"), (F.col("begin") - 1).alias("at")), F.struct(F.lit("R").alias("side"), (F.col("end") + 1).alias("at")))).alias("x"))
    ends = ends.select(key, "ref", F.col("strand").alias("x_strand"), "x.side", "x.at")
    sites = introns.select("ref", F.col("strand").alias("i_strand"), F.col("id").alias("i_id"), F.explode(F.array(F.struct(F.lit("L").alias("side"), F.col("end").alias("at")), F.struct(F.lit("R").alias("side"), F.col("begin").alias("at")))).alias("x"))
    sites = sites.select("ref", "i_strand", "i_id", "x.side", "x.at")
    hit = ends.join(sites, ["ref", "side", "at"])
    good = (F.col("x_strand") == F.col("i_strand")) | (F.col("x_strand") == ".") | (F.col("i_strand") == ".")
    return hit.groupBy(key).agg(F.count_if(good).alias("good"), F.count_if(~good).alias("bad"), F.array_join(F.array_sort(F.collect_set(F.col("i_id").cast("string"))), ",").alias("ids"))


def lifted(features: DataFrame, parts: DataFrame, size: int = 10 * BIN) -> DataFrame:
    """Features on contigs moved to scaffolds: parts has ref (contig), c_begin, c_end, scaffold, s_begin, s_end, orient.

    A reversed part turns coordinates about its span and flips known strands. Features must lie within one part.
    """
    build = parts.select("ref", F.col("c_begin").alias("begin"), F.col("c_end").alias("end"), "scaffold", "s_begin", "s_end", "orient")
    rows = overlap_pairs(features, build, size).where("p_begin >= b_begin and p_end <= b_end")
    back = F.col("b_orient") == "-"
    begin = F.when(back, F.col("b_s_end") - (F.col("p_end") - F.col("b_begin"))).otherwise(F.col("b_s_begin") + F.col("p_begin") - F.col("b_begin"))
    end = F.when(back, F.col("b_s_end") - (F.col("p_begin") - F.col("b_begin"))).otherwise(F.col("b_s_begin") + F.col("p_end") - F.col("b_begin"))
    strand = F.when(back, F.translate("p_strand", "+-", "-+")).otherwise(F.col("p_strand"))
    return rows.select("p_id", "b_scaffold", begin.alias("begin"), end.alias("end"), strand.alias("strand"))
