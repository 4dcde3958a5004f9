"""Strand segments of scaffolds from stranded introns, and partitions of about equal bases.

Windows of a scaffold vote for a strand; empty ones between take their neighbours' strand; neighbours of one strand become a segment.
Only windows with votes are rows: what lies between two of them is worked out from the two. Whatever looks at the row before or
after is dealt by (scaffold, block) with states carried from block to block, so that no task holds a scaffold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.session import cut

from .intervals import running


_PIECES = "array<struct<lo:bigint,hi:bigint,strand:int,fwd:bigint,rev:bigint>>"


def votes(introns: DataFrame, window: int, reach: int, least: int, share: float) -> DataFrame:
    """ref, bin, fwd, rev and strand (1, -1, 2 for both; null under `least`): support of the exons that introns (ref, strand, begin, end, score) end at."""
    one, b, e = F.lit(1), F.col("begin"), F.col("end")
    sides = F.array(F.struct(F.greatest(one, b - reach).alias("lo"), F.greatest(one, b - 1).alias("hi")), F.struct((e + 1).alias("lo"), (e + reach).alias("hi")))
    rows = introns.where(F.col("strand").isin("+", "-")).select("ref", "strand", "score", F.explode(sides).alias("s"))
    rows = rows.select("ref", "strand", "score", F.explode(F.sequence(F.floor(F.col("s.lo") / window), F.floor(F.col("s.hi") / window))).alias("bin"))
    total = lambda s: F.sum(F.when(F.col("strand") == s, F.col("score")).otherwise(0))
    bins = rows.groupBy("ref", "bin").agg(total("+").alias("fwd"), total("-").alias("rev"))
    f, r = (F.when(F.col(c) >= least, F.col(c)).otherwise(0) for c in ("fwd", "rev"))
    strand = F.when((f == 0) & (r == 0), None).when(f == 0, -1).when(r == 0, 1).when(f < share * r, -1).when(r < share * f, 1).otherwise(2)
    return bins.withColumn("strand", strand)


def _turn(last: Column, next_: Column, scan: int) -> Column:
    """The first window of the next one's strand between two voting windows; up to it the last one's goes on.

    The last strand goes on in whole stretches of scan + 1 windows; what is left is halved where strands differ and it holds
    more than two windows, and is the next one's otherwise.
    """
    gap = next_["bin"] - last["bin"] - 1
    begin = last["bin"] + 1 + F.floor(gap / (scan + 1)) * (scan + 1)
    left = next_["bin"] - begin
    half = F.floor((begin + next_["bin"]) / 2)
    return F.when((last["strand"] != next_["strand"]) & (left > 2), half).otherwise(begin).cast("long")


def segments(
    introns: DataFrame, sizes: DataFrame, window: int = 100, reach: int = 300, least: int = 6, share: float = 0.05, scan: int = 99, block: int = 10_000,
) -> DataFrame:
    """Segments of one strand: ref, segment (from 1), begin, end, fwd, rev, strand (1, -1, 2, 0 for none) and next, the strands that follow.

    sizes: ref, size. Votes of exon ends are summed by window; a strand under `share` of the other is ignored. Before a
    scaffold's first vote `scan` windows take its strand, those before have none; after the last one its strand goes on to the
    end. Scaffolds without votes of `least` have no segments. next: windows until the forward (or, for a reverse segment, the
    reverse) strand ends, 0 where it ends at once, -1 where it goes on for 50 or more. block: windows a task's share.
    """
    bins = votes(introns, window, reach, least, share)
    mark = F.when(F.col("strand").isNotNull(), F.struct("bin", "strand"))
    back = F.when(F.col("strand").isNotNull(), F.struct((-F.col("bin")).alias("back"), "strand"))
    rows = running(bins, ["ref"], ["bin"], "bin", block, most={"last": mark})
    rows = running(rows.withColumn("back", -F.col("bin")), ["ref"], ["back"], "back", block, most={"next": back}).drop("back")
    rows = rows.withColumn("next", F.when(F.col("next").isNotNull(), F.struct((-F.col("next.back")).alias("bin"), F.col("next.strand").alias("strand"))))
    rows = rows.join(sizes.select("ref", F.floor(F.col("size") / window).alias("top")), "ref").where(F.col("bin") <= F.col("top"))

    turn = _turn(F.struct("bin", "strand"), F.col("next"), scan)
    piece = lambda lo, hi, s, f, r: F.struct(lo.alias("lo"), hi.alias("hi"), s.cast("int").alias("strand"), f.alias("fwd"), r.alias("rev"))
    none, zero = F.lit(None).cast("long"), F.lit(0).cast("long")
    far = F.col("next").isNull() | (F.col("next.bin") > F.col("top"))
    own = piece(F.col("bin"), F.when(far, F.col("top")).otherwise(turn - 1), F.col("strand"), F.col("fwd"), F.col("rev"))
    rest = F.when(~far, piece(turn, F.col("next.bin") - 1, F.col("next.strand"), zero, zero))
    first = F.greatest(zero, F.col("bin") - scan)
    lead_in = F.when(F.col("last").isNull(), F.array(piece(zero, first - 1, F.lit(0), zero, zero), piece(first, F.col("bin") - 1, F.col("strand"), zero, zero)))
    voting = F.concat(F.coalesce(lead_in, F.array().cast(_PIECES)), F.array(own, rest))
    # a window below the threshold lies in a gap: it adds its votes to the segment there
    here = F.col("next").isNotNull() & (F.col("next.bin") <= F.col("top"))
    inner = F.when(F.col("last").isNull(), F.when(F.col("bin") >= F.col("next.bin") - scan, F.col("next.strand")).otherwise(0))
    inner = F.when(~here, F.col("last.strand")).otherwise(F.coalesce(inner, F.when(F.col("bin") >= _turn(F.col("last"), F.col("next"), scan), F.col("next.strand")).otherwise(F.col("last.strand"))))
    silent = F.array(piece(F.col("bin"), none, inner, F.col("fwd"), F.col("rev")))
    kept = rows.where("strand is not null or last is not null or next is not null")
    pieces = kept.select("ref", F.explode(F.when(F.col("strand").isNotNull(), voting).otherwise(silent)).alias("p")).where("p is not null").select("ref", "p.*")
    pieces = pieces.where("(hi is null or hi >= lo) and strand is not null").withColumn("order", F.when(F.col("hi").isNull(), 1).otherwise(0))

    order = ["lo", "order"]
    pieces = running(pieces, ["ref"], order, "lo", block, most={"before": F.struct("lo", "order", "strand")})
    pieces = pieces.withColumn("new", F.when(F.col("before").isNull() | (F.col("before.strand") != F.col("strand")), 1).otherwise(0)).drop("before")
    pieces = running(pieces, ["ref"], order, "lo", block, sums={"upto": F.col("new")})
    runs = pieces.groupBy("ref", (F.col("upto") + F.col("new")).alias("segment"), "strand").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("fwd").alias("fwd"), F.sum("rev").alias("rev"))
    return _followed(cut(runs), window, block)


def _followed(runs: DataFrame, window: int, block: int) -> DataFrame:
    """Adds next to runs of one strand: how far the ones behind keep to the run's strand."""
    rows = runs.withColumn("back", -F.col("lo"))
    ends = {
        name: F.when(~F.col("strand").isin(*keeps), F.col("back")) for name, keeps in (("no_fwd", (1, 2)), ("no_rev", (-1, 2)))
    }
    rows = running(rows, ["ref"], ["back"], "back", block, most={**ends, "last": F.col("back")})
    rows = rows.join(runs.groupBy("ref").agg((F.max("hi") + 1).alias("stop")), "ref")
    until = F.coalesce(-F.when(F.col("strand").isin(1, 2), F.col("no_fwd")).otherwise(F.col("no_rev")), F.col("stop")) - F.col("hi") - 1
    follow = F.when(F.col("last").isNull(), 0).when((F.col("strand") != 0) & (until < 50), until).otherwise(-1)
    return rows.select("ref", "segment", (F.col("lo") * window + 1).alias("begin"), ((F.col("hi") + 1) * window).alias("end"), "fwd", "rev", "strand", follow.cast("long").alias("next"))


def partitions(parts: DataFrame, sizes: DataFrame, part: int = 250_000, least: int = 6, block: int = 1_000_000) -> DataFrame:
    """Segments with the numbers of their forward and reverse partitions (null for none) and shown, the strand shown.

    Scaffolds go by size, the largest first, then by name. A strand's partitions fill up in turn: a segment's number is that of
    the bases so far, but a new number waits for the first segment behind which the strand breaks off.
    """
    weak = (F.col("fwd") < least) & (F.col("rev") < least)
    rows = out = cut(parts.withColumn("shown", F.when(weak, 0).otherwise(F.col("strand"))).withColumn("bases", F.col("end") - F.col("begin") + 1))
    for name, keeps in (("fwd_part", (1, 2)), ("rev_part", (-1, 2))):
        mine = rows.where(F.col("shown").isin(*keeps)).select("ref", "segment", "begin", "bases", "next")
        of_ref = mine.groupBy("ref").agg(F.sum("bases").alias("of_ref")).join(sizes, "ref")
        before = F.sum("of_ref").over(Window.orderBy(F.desc("size"), "ref").rowsBetween(Window.unboundedPreceding, -1))  # one row a scaffold
        mine = running(mine, ["ref"], ["begin"], "begin", block, sums={"upto": F.col("bases")})
        mine = mine.join(of_ref.select("ref", "size", F.coalesce(before, F.lit(0)).alias("base")), "ref").withColumn("at", F.col("base") + F.col("upto"))
        mine = mine.withColumn("raw", 1 + F.floor((F.col("at") + F.col("bases")) / part))
        # per number: where the strand first breaks off
        held = mine.groupBy("raw").agg(F.min(F.when(F.col("next") <= 0, F.col("at"))).alias("breaks"))
        order = Window.orderBy("raw")  # one row a partition
        held = held.withColumn("previous", F.lag("raw").over(order))
        sure = F.col("breaks").isNotNull() | F.coalesce(F.col("previous") != F.col("raw") - 1, F.lit(True))
        anchor = F.max(F.when(sure, F.col("raw"))).over(order)
        held = held.withColumn("reached", (F.col("raw") - anchor) % 2 == 0)  # numbers without a break are skipped every other time
        waits = F.coalesce((F.col("previous") == F.col("raw") - 1) & F.lag("reached").over(order), F.lit(False))
        held = held.withColumn("waits", waits)
        number = F.when(F.col("waits") & (F.col("breaks").isNull() | (F.col("at") < F.col("breaks"))), F.col("raw") - 1).otherwise(F.col("raw"))
        out = out.join(mine.join(held, "raw").select("ref", "segment", number.alias(name)), ["ref", "segment"], "left")
    return out.drop("bases")
