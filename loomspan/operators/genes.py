"""Gene records: genes (gid) made of exons with begin, end, kind; structure, evidence sums, similarity, selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.session import cut

from .intervals import overlap_pairs


def _in_place():
    return Window.partitionBy("gid").orderBy("begin", "end")


def introns(exons: DataFrame) -> DataFrame:
    """Gaps between neighbouring exons of a gene: gid, ref, strand, id, begin, end."""
    rows = exons.withColumn("next", F.lead("begin").over(_in_place())).where(F.col("next") > F.col("end") + 1)
    return rows.select("gid", "ref", "strand", (F.col("gid") * 100 + F.col("exon_no")).alias("id"), (F.col("end") + 1).alias("begin"), (F.col("next") - 1).alias("end"))


def spans(exons: DataFrame) -> DataFrame:
    """One row a gene: its place, exon and CDS lengths, exon count and summed score."""
    length = F.col("end") - F.col("begin") + 1
    return exons.groupBy("gid", "ref", "strand").agg(
        F.min("begin").alias("begin"), F.max("end").alias("end"), F.count("*").alias("n_exons"), F.sum(length).alias("exon_len"),
        F.sum(F.when(F.col("kind") == "CDS", length).otherwise(0)).alias("cds_len"),
        F.sum(F.when(F.col("kind") == "exon", F.col("score")).otherwise(0)).alias("score"),
    )


def joined_exons(exons: DataFrame, least: int) -> DataFrame:
    """Exons of a gene less than least bases apart become one."""
    # the row that ends an island tells all of it by running values: one sort serves the windows, and no table of islands is built in a task
    order = Window.partitionBy("gid", "ref", "strand").orderBy("begin", "end")
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = before.isNull() | F.coalesce(F.col("begin") > before + least, F.lit(False))
    rows = exons.select("gid", "ref", "strand", "begin", "end").withColumns({"new": new, "n": F.row_number().over(order)})
    island, first = F.sum(F.col("new").cast("long")).over(so_far), F.max(F.when(F.col("new"), F.col("n"))).over(so_far)
    rows = rows.withColumns({"island": island, "parts": F.col("n") - first + 1, "last": F.coalesce(F.lead("new").over(order), F.lit(True))})
    # numbers of islands rise, so the largest pair belongs to the one at hand
    most = lambda c: F.max(F.struct("island", c.alias("x"))).over(so_far)["x"]
    rows = rows.select("gid", "ref", "strand", "island", (-most(-F.col("begin"))).alias("begin"), most(F.col("end")).alias("end"), F.col("parts").cast("long").alias("parts"), "last")
    return rows.where("last").drop("last").withColumnRenamed("island", "exon_no")


def distances(genes: DataFrame) -> DataFrame:
    """Bases between a gene and the one before it on its ref; 0 where they overlap, null for the first."""
    before = Window.partitionBy("ref").orderBy("begin", F.desc("end"), "gid").rowsBetween(Window.unboundedPreceding, -1)
    return genes.withColumn("distance", F.greatest(F.col("begin") - F.max("end").over(before) - 1, F.lit(0)))


def utr_score(exon_len: Column, cds_len: Column, utr_exons: Column) -> Column:
    """Points for a plausible share of UTR, less for many UTR exons."""
    share = F.when(exon_len > 0, (exon_len - cds_len) / exon_len).otherwise(0.0)
    base = F.when(share > 0.66, -1).when(share > 0.5, 0).when(share > 0.05, 2).otherwise(1)
    return base - F.when(utr_exons > 4, 2).when(utr_exons > 2, 1).otherwise(0)


def weighted_sum(fields: dict[str, float]) -> Column:
    """Whole part of the weighted sum of score columns, nulls counting 0."""
    total = F.lit(0.0)
    for name, w in fields.items():
        total = total + F.coalesce(F.col(name).cast("double"), F.lit(0.0)) * w
    return F.when(total < 0, F.ceil(total)).otherwise(F.floor(total)).cast("long")


def drop_rule(rules: list[tuple[str, float, str]]) -> Column:
    """True where a row is kept. rules: (column, threshold, sign) in order.

    '' : one such field at its threshold is enough; '+': must reach it; '-': must not reach it; '*': keeps at once.
    A failed '+' or '-' can be undone by nothing but a later '*'.
    """
    state = F.lit(0)  # 0 undecided, 1 kept, -1 dropped, 2 kept for good
    for name, least, sign in rules:
        reached = F.coalesce(F.col(name), F.lit(0)) >= least
        if sign == "*":
            now = F.when(reached, 2).otherwise(state)
        elif sign == "+":
            now = F.when(reached, state).otherwise(-1)
        elif sign == "-":
            now = F.when(reached, -1).otherwise(state)
        else:
            now = F.when(reached & (state >= 0), 1).otherwise(state)
        state = F.when(state == 2, 2).otherwise(now)
    return state >= 1


def best_evidence(pairs: DataFrame) -> DataFrame:
    """Per gene the evidence id with the largest summed overlap, ties to the smaller id, and its share of all."""
    sums = pairs.groupBy(F.col("p_gid").alias("gid"), F.col("b_id").alias("id")).agg(F.sum("overlap").alias("bases"))
    return sums.groupBy("gid").agg(F.max_by("id", F.struct("bases", -F.col("id"))).alias("best"), F.max("bases").alias("best_bases"), F.sum("bases").alias("bases"))


def compared_genes(exons: DataFrame, against: DataFrame | None = None, strand: str | None = "same", sizes: DataFrame | None = None) -> DataFrame:
    """similar_genes with both genes' lengths: p_exon, p_cds, b_exon and b_cds. sizes: spans of all genes, where they are at hand."""
    rows = exons.select("gid", "ref", "strand", "begin", "end", "kind")
    both = overlap_pairs(rows, rows if against is None else against.select(*rows.columns), strand=strand)
    both = both.where("p_gid < b_gid") if against is None else both
    coding = (F.col("p_kind") == "CDS") & (F.col("b_kind") == "CDS")
    shared = both.groupBy("p_gid", "b_gid").agg(F.sum("overlap").alias("exon_shared"), F.sum(F.when(coding, F.col("overlap")).otherwise(0)).alias("cds_shared"))

    def lengths(df: DataFrame, side: str) -> DataFrame:
        rows = spans(df) if sizes is None else sizes
        return rows.select(F.col("gid").alias(f"{side}_gid"), F.col("exon_len").alias(f"{side}_exon"), F.col("cds_len").alias(f"{side}_cds"))

    out = shared.join(lengths(exons, "p"), "p_gid").join(lengths(exons if against is None else against, "b"), "b_gid")
    percent = lambda part, whole: F.floor(100 * F.col(part) / F.greatest(F.lit(1), F.greatest(*whole)) + 0.5).cast("long")
    return out.select(
        F.col("p_gid").alias("gid"), F.col("b_gid").alias("other"), "exon_shared", "cds_shared",
        percent("cds_shared", ("p_cds", "b_cds")).alias("cds_pct"), percent("exon_shared", ("p_exon", "b_exon")).alias("exon_pct"),
        "p_exon", "p_cds", "b_exon", "b_cds",
    )


def similar_genes(exons: DataFrame, against: DataFrame | None = None, strand: str | None = "same") -> DataFrame:
    """Pairs of genes on one ref with shared exon and CDS bases and their percent of the larger gene.

    Exon overlaps are summed by (gene, gene), so genes that share no exon never meet.
    """
    return compared_genes(exons, against, strand).drop("p_exon", "p_cds", "b_exon", "b_cds")


def fingerprint(exons: DataFrame, kinds: tuple | None = None) -> DataFrame:
    """gid, ref, strand and the model: its sorted spans as text. Equal models have equal text."""
    rows = exons if kinds is None else exons.where(F.col("kind").isin(*kinds))
    span = F.struct("begin", "end")
    model = F.array_join(F.transform(F.sort_array(F.collect_list(span)), lambda x: F.concat(x["begin"].cast("string"), F.lit("-"), x["end"].cast("string"))), ",")
    return rows.groupBy("gid", "ref", "strand").agg(model.alias("model"))


def joined_by(exons: DataFrame, joiners: DataFrame, widest: int = 500_000, least: int = 3) -> DataFrame:
    """Pairs of exons (a, b) that at least so many joiners no wider than widest both touch, with their count."""
    short = joiners.where(F.col("end") - F.col("begin") < widest)
    touched = overlap_pairs(exons, short).select(F.col("b_id").alias("joiner"), F.col("p_xid").alias("xid")).distinct()
    x, y = touched.select("joiner", F.col("xid").alias("a")), touched.select("joiner", F.col("xid").alias("b"))
    return x.join(y, "joiner").where("a < b").groupBy("a", "b").agg(F.count("*").alias("joins")).where(F.col("joins") >= least)


def intron_chain_quality(exons: DataFrame, sites: DataFrame) -> DataFrame:
    """Per gene: exons with supported ends, neighbours that one intron joins, and a word for the chain.

    sites: gid, exon_no, intron id. complete: every neighbouring pair is joined; good: half or more; ok: any; poor:
    support without a join; none: no support.
    """
    ids = sites.groupBy("gid", "exon_no").agg(F.collect_set("intron").alias("ids"))
    rows = exons.join(ids, ["gid", "exon_no"], "left")
    joins = F.arrays_overlap("ids", F.lag("ids").over(Window.partitionBy("gid").orderBy("begin", "end")))
    counts = rows.withColumn("joined", F.coalesce(joins, F.lit(False))).groupBy("gid").agg(
        F.count("*").alias("n_exons"), F.count("ids").alias("supported"), F.count_if("joined").alias("joins")
    )
    word = (
        F.when(F.col("supported") == 0, "none").when((F.col("n_exons") > 1) & (F.col("joins") == F.col("n_exons") - 1), "complete")
        .when(2 * F.col("joins") >= F.col("n_exons") - 1, "good").when(F.col("joins") > 0, "ok").otherwise("poor")
    )
    return counts.withColumn("chain", word)


def taken_bases(exons: DataFrame, ranked: DataFrame) -> DataFrame:
    """Bases that exons of a higher-ranked gene (winner) share with those of a lower-ranked one (gid), for each such pair."""
    rows = exons.select("gid", "ref", "begin", "end").join(ranked.select("gid", "place"), "gid")
    pairs = overlap_pairs(rows, rows).where("p_place < b_place")
    return pairs.groupBy(F.col("p_gid").alias("winner"), F.col("b_gid").alias("gid")).agg(F.sum("overlap").alias("bases"))


def select_best(exons: DataFrame, totals: DataFrame, most: float = 0.1) -> DataFrame:
    """Greedy best set: genes by total desc, then place; one is kept if at most that share of its bases is taken by kept ones.

    exons: gid, ref, begin, end. totals: gid, total; genes with last set (optional) come after all others. Rounds of joins
    over the pairs of overlapping genes take the place of a walk along a chromosome: a gene is decided once what open genes
    above it may still take can't change its verdict. The highest open gene always is, and rounds grow with the longest
    descending run of overlapping genes, not with a chromosome's length.
    """
    last = F.coalesce("last", F.lit(False)) if "last" in totals.columns else F.lit(False)
    size = F.sum(F.col("end") - F.col("begin") + 1).alias("size")
    genes = exons.groupBy("gid").agg(size, F.min("begin").alias("begin"), F.max("end").alias("end")).join(totals, "gid")
    genes = cut(genes.select("gid", "size", "total", F.struct(last.alias("last"), (-F.col("total")).alias("minus"), "begin", "end", "gid").alias("place")))
    pairs = edges = cut(taken_bases(exons, genes))
    decided, left = None, genes.select("gid", "size", F.lit(0).cast("long").alias("taken"))
    while True:
        waiting = edges.groupBy("gid").agg(F.sum("bases").alias("waiting"))
        limit, certain, possible = most * F.col("size"), F.col("taken"), F.col("taken") + F.coalesce("waiting", F.lit(0))
        verdict = cut(left.join(waiting, "gid", "left").select("gid", "size", "taken", F.when(possible <= limit, True).when(certain > limit, False).alias("kept")))
        done = verdict.where("kept is not null").select("gid", "kept")
        decided = done if decided is None else decided.union(done)
        left = verdict.where("kept is null").select("gid", "size", "taken")
        if left.isEmpty():
            break
        known = verdict.select(F.col("gid").alias("winner"), F.col("kept").alias("won"))
        edges = cut(edges.join(left.select("gid"), "gid", "left_semi").join(known, "winner"))
        won = edges.where("won").groupBy("gid").agg(F.sum("bases").alias("more"))
        left = left.join(won, "gid", "left").select("gid", "size", (F.col("taken") + F.coalesce("more", F.lit(0))).alias("taken"))
        edges = edges.where("won is null").drop("won")
    winners = decided.where("kept").select(F.col("gid").alias("winner"))
    taken = pairs.join(winners, "winner", "left_semi").groupBy("gid").agg(F.sum("bases").alias("taken"))
    rows = genes.select("gid", F.col("total").cast("long").alias("total")).join(decided, "gid").join(taken, "gid", "left")
    return rows.select("gid", "total", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"), "kept")


def placed_offsets(exons: DataFrame, first: int, last: int) -> DataFrame:
    """Pieces of exons that hold transcript offsets first..last, exons being laid end to end in place order."""
    size = F.col("end") - F.col("begin") + 1
    rows = exons.withColumn("upto", F.sum(size).over(_in_place().rowsBetween(Window.unboundedPreceding, 0))).withColumn("before", F.col("upto") - size)
    rows = rows.where((F.col("upto") >= first) & (F.col("before") < last))
    begin = F.col("begin") + F.greatest(F.lit(0), first - F.col("before") - 1)
    return rows.select("gid", "ref", "strand", begin.alias("begin"), (F.col("end") - F.greatest(F.lit(0), F.col("upto") - last)).alias("end"))
