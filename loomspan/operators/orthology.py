"""Similarity pairs of proteins from alignment hits, and unique genes of ortholog groups."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import running

_FIELDS = ["q", "t", "qb", "qe", "tb", "te", "bits", "ident", "aln", "evalue"]


def _free(begin: np.ndarray, end: np.ndarray, slop: np.ndarray, b: int, e: int) -> np.ndarray:
    """Which of the spans begin..end don't overlap b..e, or do so only by going on to the right or left of it, but for their slop."""
    apart = (end < b) | (begin > e)
    right, left = (end > e) & (begin >= e - slop), (begin < b) & (end <= b + slop)
    return apart | right | left


def _parts(least: int, share: float, kinds: tuple):
    """Rows sorted by q, t and row_no: a pair's hits join unless they clash with joined ones on query or target.

    The first hit left joins and takes those that clash with it out, so that a pair costs a look at its hits for each one that joins.
    """
    names = ["q", "t", "parts", "bits", "ident", "align", "first_evalue", "spans"]

    def run(batches):
        now, held, sums, first = None, [], None, None

        def row():
            spans = ".".join(f"{i}:{a}-{b}:{c}-{d}" for i, (a, b, c, d) in enumerate(held, 1))
            return (*now, len(held), *sums, first, spans)

        for batch in batches:
            out = []
            q, t, qb, qe, tb, te, bits, ident, aln, evalue = (batch[c].to_numpy() for c in _FIELDS)
            qb, qe, tb, te = np.minimum(qb, qe), np.maximum(qb, qe), np.minimum(tb, te), np.maximum(tb, te)
            slop_q, slop_t = (np.maximum(least, (share * (1 + e - b)).astype(np.int64)) for b, e in ((qb, qe), (tb, te)))
            heads = np.flatnonzero(np.concatenate([[True], (q[1:] != q[:-1]) | (t[1:] != t[:-1])])) if len(q) else []
            for lo, hi in zip(heads, [*heads[1:], len(q)]):
                if (pair := (q[lo].item(), t[lo].item())) != now:
                    if now is not None:
                        out.append(row())
                    now, held, sums, first = pair, [], (0.0, 0.0, 0.0), evalue[lo].item()
                rows = np.arange(lo, hi)
                free = lambda r, h: r[_free(qb[r], qe[r], slop_q[r], h[0], h[1]) & _free(tb[r], te[r], slop_t[r], h[2], h[3])]
                for h in held:  # of the batch before
                    rows = free(rows, h)
                while len(rows):
                    k = rows[0]
                    held.append(tuple(x[k].item() for x in (qb, qe, tb, te)))
                    sums = tuple(x + y[k].item() for x, y in zip(sums, (bits, ident, aln)))
                    rows = free(rows[1:], held[-1])
            yield pd.DataFrame(out, columns=names).astype(dict(zip(("q", "t"), kinds)))
        if now is not None:
            yield pd.DataFrame([row()], columns=names)

    return run


def evalue_of(bits: Column, length: Column, database: int) -> Column:
    """The expected number of chance matches of that score, to one digit; 1 where there is no score, length or database."""
    x = F.format_string("%.0e", length * F.lit(float(database)) / F.pow(F.lit(2.0), bits)).cast("double")
    return F.when((bits < 0) | (length <= 0) | F.lit(database <= 0), 1.0).otherwise(x)


def similarity_pairs(
    hits: DataFrame, lengths: DataFrame, database: int = 10_000_000, least_bits: float = 0, most_evalue: float | None = 1e-5, least_align: float = 0,
    slop: int = 6, slop_share: float = 0.02, mirror: bool = False, block: int = 10_000,
) -> DataFrame:
    """number, q, q_len, t, t_len, evalue, pident, bits, parts, spans: pairs of proteins in the order of an all-against-all table.

    hits: q, t (numbers), qb, qe, tb, te, bits, ident, aln, evalue, row_no. lengths: id, len (0 where missing). Hits of a pair that don't
    overlap earlier ones beyond a slop (bases, or a share of the hit) add up. The e-value of one hit is its own; that of
    several is worked out again from their summed score, the shorter known length and the database's size. Pairs of less score, larger
    e-value or less aligned percent of the longer length go. Each query's pairs come by score, then target; with mirror
    each of a query's pairs is followed, after all of them, by its reverse. number counts them over all queries.
    """
    kinds = tuple(hits.schema[c].dataType.simpleString() for c in ("q", "t"))
    plain = hits.select(*[F.col(c) for c in ("q", "t", "qb", "qe", "tb", "te")], *[F.col(c).cast("double") for c in ("bits", "ident", "aln", "evalue")], "row_no")
    schema = f"q {kinds[0]}, t {kinds[1]}, parts long, bits double, ident double, align double, first_evalue double, spans string"
    pandas_kinds = tuple("int32" if k == "int" else "int64" for k in kinds)
    rows = plain.repartition("q", "t").sortWithinPartitions("q", "t", "row_no").mapInPandas(_parts(slop, slop_share, pandas_kinds), schema)
    for side in ("q", "t"):
        rows = rows.join(lengths.select(F.col("id").alias(side), F.col("len").alias(f"{side}_len")), side, "left")
    rows = rows.fillna(0, ["q_len", "t_len"])
    known = F.when(F.least("q_len", "t_len") > 0, F.least("q_len", "t_len")).otherwise(F.greatest("q_len", "t_len"))
    evalue = F.when(F.col("parts") <= 1, F.col("first_evalue")).otherwise(evalue_of(F.col("bits"), known, database))
    pident = F.when(F.col("align") > 0, F.floor(100 * F.col("ident") / F.col("align"))).otherwise(0)
    rows = rows.withColumn("evalue", evalue).withColumn("pident", pident.cast("long"))
    keep = F.col("bits") >= least_bits
    if most_evalue is not None:
        keep &= F.col("evalue") <= most_evalue
    if least_align:
        keep &= 100 * F.col("align") / F.greatest("q_len", "t_len") >= least_align
    rows = rows.where(keep).withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("bits"), "t"))).withColumn("of", F.col("q"))
    rows = rows.select("of", F.lit(0).alias("turned"), "rank", "q", "q_len", "t", "t_len", "evalue", "pident", "bits", "parts", "spans")
    if mirror:
        back = F.regexp_replace("spans", r"(\d+:)(\d+-\d+):(\d+-\d+)", "$1$3:$2")
        rows = rows.union(rows.select("of", F.lit(1), "rank", F.col("t"), F.col("t_len"), F.col("q"), F.col("q_len"), "evalue", "pident", "bits", "parts", back))
    rows = running(rows.withColumn("one", F.lit(1)), ["one"], ["of", "turned", "rank"], "of", block, sums={"before": F.col("one")})
    return rows.select((F.col("before") + 1).alias("number"), *rows.columns[3:12])


def group_genes(hits: DataFrame, margin: float = 2) -> DataFrame:
    """One gene an ortholog group at most, and one group a gene: gene, member, grp, bits, size, median, diff, outlier.

    hits: gene, member, grp, bits, size (of the gene), member_size. A group asks for its best gene by score (ties to the smaller gene,
    then member). Groups whose score is within margin of the gene's best over all groups come first, then the smaller group;
    the first that asks gets it. median is the upper one of the group's hits' member sizes; outlier: 2 beyond 1.9 of it, -2 below 0.65.
    """
    best = hits.groupBy("grp").agg(F.min(F.struct((-F.col("bits")).alias("minus"), "gene", "member", "bits", "size")).alias("b")).select("grp", "b.gene", "b.member", "b.bits", "b.size")
    top = hits.groupBy("gene").agg(F.max("bits").alias("top"))
    near = (F.col("top") <= F.col("bits") + margin).cast("int")
    asked = best.join(top, "gene").withColumn("rank", F.row_number().over(Window.partitionBy("gene").orderBy(near.desc(), "grp"))).where("rank = 1")
    # medians from counts of equal sizes: a large group is as many rows as it has sizes
    counts = hits.groupBy("grp", "member_size").agg(F.count("*").alias("n"))
    by = Window.partitionBy("grp").orderBy(F.desc("member_size"))
    counts = counts.withColumn("upto", F.sum("n").over(by)).withColumn("all", F.sum("n").over(Window.partitionBy("grp")))
    median = counts.where("upto > floor(all / 2)").groupBy("grp").agg(F.max("member_size").alias("median"))
    outlier = F.when(F.col("size") > 1.9 * F.col("median"), 2).when(F.col("size") < 0.65 * F.col("median"), -2).otherwise(0)
    return asked.join(median, "grp").select("gene", "member", "grp", "bits", "size", "median", (F.col("size") - F.col("median")).alias("diff"), outlier.alias("outlier"))
