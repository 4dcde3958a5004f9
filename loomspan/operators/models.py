"""Gene models from alignment hits: the best hit that is left seeds a gene, collinear neighbours join it on both sides.

What a seed may reach is bounded by the longest intron, and saved hits matter to overlapping ones only, so the work is
dealt by query, scaffold and stretch: hits with no hit of the query nearer than that are apart. The highest score of a query and
the limit of genes a query are the only things stretches share; both come from aggregates and windows around the walk. A stretch
stops at the limit, so its walk costs its hits times a fixed number of genes.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .intervals import islands

#: Bases that neighbours may share in the query, and that parts of one gene may share on the scaffold.
SLOP = 5


def _overlaps(begin, end, b, e, most: float):
    """Whether begin..end lies in b..e, or shares more than a part `most` of the larger with it. Scalars or arrays."""
    touch = (begin < e) & (end > b)
    inside = (begin >= b) & (end <= e)
    shared = np.minimum(e - begin, end - b) / np.maximum(e - b + 1, end - begin + 1)
    return touch & (inside | (shared > most))


def _near(begin, end, b: int, e: int, gap: int):
    """Whether begin..end lies beside b..e, less than gap away, without overlapping it."""
    apart = (begin >= e - SLOP) | (end <= b + SLOP)
    return apart & (((begin >= e) & (begin - e < gap)) | ((b >= end) & (b - end < gap)))


def _stitched(longest: int, low: float, query_share: float, place_share: float, gap: int, most_genes: int):
    """The hits of one stretch that genes use, with their gene's seed (row_no of its best hit).

    Genes come best seed first, so what follows the first most_genes of a stretch can't be among its query's first ones.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # by scaffold place, longer first
        rows = rows.iloc[np.lexsort((rows["row_no"], -rows["te"], rows["tb"]))].reset_index(drop=True)
        qb, qe, tb, te, bits = (rows[c].to_numpy() for c in ("qb", "qe", "tb", "te", "bits"))
        same = rows.groupby(["strand", "qb", "tb", "te", "bits"], sort=False).ngroup().to_numpy()  # equal hits are used once
        strand = rows["strand"].to_numpy()
        strands = {s: np.flatnonzero(strand == s) for s in set(strand)}
        weak = bits < low * rows["most_bits"].to_numpy()
        widest = (te - tb).max()
        done, taken = np.zeros(len(rows), bool), np.zeros(len(rows), bool)  # done is by number of equal hits; taken: overlaps a saved hit
        seeds, used_hits, genes = [], [], 0
        for seed in np.lexsort((rows["row_no"], -bits)):
            if done[same[seed]]:
                continue
            done[same[seed]] = True
            if weak[seed] and taken[seed]:
                continue
            mine = strands[strand[seed]]
            mine = mine[np.searchsorted(tb[mine], tb[seed] - longest, "right") :]
            mine = mine[: np.searchsorted(tb[mine], te[seed] + longest)]
            mine = mine[(te[mine] < te[seed] + longest) & (same[mine] != same[seed])]
            ahead = te[mine] <= tb[seed] + SLOP
            left = np.concatenate([mine[~ahead & (tb[mine] >= te[seed] - SLOP)], mine[ahead][::-1]])
            lower = (te[left] <= tb[seed] + SLOP) != (strand[seed] == "-")  # in the query: before the seed on the plus strand, after it on the minus strand
            low_q, high_q, low_t, high_t, members = qb[seed], qe[seed], tb[seed], te[seed], []
            while True:
                # the query span only grows: what doesn't lie beside it now never will
                beside = np.where(lower, qe[left] - SLOP <= low_q, qb[left] + SLOP >= high_q)
                left, lower = left[beside], lower[beside]
                used = done[same[left]] | taken[left]
                fit = ~_overlaps(qb[left], qe[left], low_q, high_q, query_share) & (~used | _near(tb[left], te[left], low_t, high_t, gap))
                k = int(fit.argmax()) if len(fit) else 0
                if not len(fit) or not fit[k]:
                    break
                i = left[k]
                low_q, high_q = (min(low_q, qb[i]), high_q) if lower[k] else (low_q, max(high_q, qe[i]))
                if not used[k]:
                    members.append(i)
                    low_t, high_t = (tb[i], high_t) if te[i] <= tb[seed] + SLOP else (low_t, te[i])
                left, lower = left[k + 1 :], lower[k + 1 :]
            done[same[members]] = True
            for i in (seed, *members):
                seeds.append(seed)
                used_hits.append(i)
                touched = slice(np.searchsorted(tb, tb[i] - widest), np.searchsorted(tb, te[i]))
                taken[touched] |= _overlaps(tb[touched], te[touched], tb[i], te[i], place_share)
            genes += 1
            if genes == most_genes:
                break
        out = rows.iloc[used_hits].drop(columns=["island", "most_bits"])
        return out.assign(seed=rows["row_no"].to_numpy()[seeds], seed_bits=bits[seeds])

    return run


def _stretches(hits: DataFrame, longest: int) -> DataFrame:
    """Adds island: hits of a query and scaffold that lie no further than longest apart share one.

    Hits that begin in one cell are never apart, so cells with their outermost ends tell: a row a cell is ordered, not a row a hit.
    """
    rows = hits.withColumn("_cell", F.floor(F.col("tb") / max(1, longest)))
    cells = rows.groupBy("q", "ref", "_cell").agg(F.min("tb").alias("begin"), F.max("te").alias("end"))
    cells = islands(cells, ["q", "ref"], gap=longest).select("q", "ref", "_cell", "island")
    return rows.join(cells, ["q", "ref", "_cell"]).drop("_cell")


def stitch(
    hits: DataFrame, longest: int = 200_000, low: float = 0.33, query_share: float = 0.15, place_share: float = 0.05, gap: int = 5_000, most_genes: int = 49,
) -> DataFrame:
    """Hits with the gene they belong to: the columns of hits, gene (number in the query, best seed first).

    hits: q, ref, strand, qb, qe, tb, te, bits, row_no (unique within a query, which decides ties). A seed whose score is below
    a part `low` of the query's best is skipped where it overlaps hits of saved genes on its scaffold. A neighbour on the
    scaffold and strand joins if it is in query order and shares little of the query span so far; one that is taken, or
    overlaps a saved hit, doesn't join, but if it lies close by it uses up its span of the query.
    """
    most = hits.groupBy("q").agg(F.max("bits").alias("most_bits"))
    rows = _stretches(hits, longest).join(most, "q")
    kinds = {f.name: f.dataType.simpleString() for f in hits.schema.fields}
    schema = ", ".join(f"`{n}` {k}" for n, k in (kinds | {"seed": kinds["row_no"], "seed_bits": kinds["bits"]}).items())
    parts = rows.select(*hits.columns, "most_bits", "island").groupBy("q", "ref", "island").applyInPandas(_stitched(longest, low, query_share, place_share, gap, most_genes), schema)
    gene = F.dense_rank().over(Window.partitionBy("q").orderBy(F.desc("seed_bits"), "seed"))
    return parts.withColumn("gene", gene).where(F.col("gene") <= most_genes).drop("seed", "seed_bits")


def gene_models(parts: DataFrame, low: float = 0.33, least_bits: float = 1) -> DataFrame:
    """One row a gene of stitch(): its place, query span, hits, summed score, aligned length and identity.

    Genes of less than a part `low` of the best summed score among the query's earlier ones and itself are left out.
    """
    identity = F.when(F.sum("aln") < 1, 0).otherwise(F.floor(100 * F.sum("ident") / F.sum("aln")))
    genes = parts.groupBy("q", "gene", "ref", "strand").agg(
        F.min("tb").alias("begin"), F.max("te").alias("end"), F.min("qb").alias("q_begin"), F.max("qe").alias("q_end"),
        F.count("*").alias("hits"), F.sum("bits").alias("bits"), F.sum("aln").alias("align"), identity.cast("long").alias("pident"),
    )
    best = F.max("bits").over(Window.partitionBy("q").orderBy("gene").rowsBetween(Window.unboundedPreceding, 0))
    return genes.withColumn("best", best).where((F.col("bits") >= low * F.col("best")) & (F.col("bits") >= least_bits)).drop("best")
