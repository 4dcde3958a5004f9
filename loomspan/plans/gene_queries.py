"""Queries over gene records: structure, evidence sums, model similarity, greedy selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomspan.operators import genes as g
from loomspan.operators.genes import introns
from loomspan.operators.intervals import overlap_pairs

from .adapters import ctes, evidence, exons
from .registry import query

_SPANS = """SELECT gid, ref, strand, min(b) AS b, max(e) AS e, count(*) AS n_exons, sum(e - b + 1) AS exon_len, sum(CASE WHEN kind = 'CDS' THEN e - b + 1 ELSE 0 END) AS cds_len,
sum(CASE WHEN kind = 'exon' THEN score ELSE 0 END) AS score, count(*) FILTER (WHERE kind = 'exon') AS utr_exons FROM exons GROUP BY gid, ref, strand"""
_INTRONS = "SELECT gid, ref, strand, gid * 100 + exon_no AS id, e + 1 AS b, nb - 1 AS e FROM (SELECT *, lead(b) OVER (PARTITION BY gid ORDER BY b, e) AS nb FROM exons) WHERE nb > e + 1"


@query("agg06_gene_score_sums", ctes("exons", genes=_SPANS) + "SELECT gid, CAST(score AS BIGINT) AS score, CAST(exon_len AS BIGINT) AS exon_len, CAST(cds_len AS BIGINT) AS cds_len, n_exons FROM genes")
def gene_score_sums(spark, sf):
    """AGG-06: exon scores summed to genes, coding parts left out."""
    return g.spans(exons(spark, sf)).select("gid", "score", "exon_len", "cds_len", "n_exons")


@query("agg07_weighted_score", ctes("exons", genes=_SPANS) + "SELECT gid, CAST(trunc(score * 0.01 + cds_len * 2.5 - n_exons * 3.75) AS BIGINT) AS total FROM genes")
def weighted_score(spark, sf):
    """AGG-07: whole part of a weighted sum."""
    return g.spans(exons(spark, sf)).select("gid", g.weighted_sum({"score": 0.01, "cds_len": 2.5, "n_exons": -3.75}).alias("total"))


@query("agg08_best_evidence", ctes("exons", "evidence", sums="SELECT x.gid, v.id, sum(least(x.e, v.e) - greatest(x.b, v.b) + 1) AS bases FROM exons x JOIN evidence v ON x.ref = v.ref AND x.b <= v.e AND x.e >= v.b GROUP BY x.gid, v.id")
       + "SELECT gid, arg_max(id, bases * 10000000000 - id) AS best, CAST(max(bases) AS BIGINT) AS best_bases, CAST(sum(bases) AS BIGINT) AS bases FROM sums GROUP BY gid")
def best_evidence(spark, sf):
    """AGG-08: the evidence with the largest summed overlap of each gene."""
    return g.best_evidence(overlap_pairs(exons(spark, sf), evidence(spark, sf)))


@query("agg09_utr_score", ctes("exons", genes=_SPANS, parts="SELECT gid, (exon_len - cds_len) / exon_len AS share, utr_exons FROM genes") + """SELECT gid, CAST(CASE WHEN share > 0.66 THEN -1 WHEN share > 0.5 THEN 0 WHEN share > 0.05 THEN 2 ELSE 1 END
 - CASE WHEN utr_exons > 4 THEN 2 WHEN utr_exons > 2 THEN 1 ELSE 0 END AS INTEGER) AS utr FROM parts""")
def utr_scores(spark, sf):
    """AGG-09: a piecewise score of UTR share and exons."""
    xs = exons(spark, sf)
    rows = g.spans(xs).join(xs.groupBy("gid").agg(F.count_if(F.col("kind") == "exon").alias("utr_exons")), "gid")
    return rows.select("gid", g.utr_score(F.col("exon_len"), F.col("cds_len"), F.col("utr_exons")).alias("utr"))


@query("flt06_drop_rule", ctes("exons", genes=_SPANS) + "SELECT gid, score >= 200000 OR (cds_len >= 100 AND n_exons < 7 AND score >= 20000) AS kept FROM genes")
def drop_rule(spark, sf):
    """FLT-06: thresholds with OR, AND, NOT and MUST signs folded in field order."""
    rules = [("score", 20_000, ""), ("cds_len", 100, "+"), ("n_exons", 7, "-"), ("score", 200_000, "*")]
    return g.spans(exons(spark, sf)).select("gid", g.drop_rule(rules).alias("kept"))


@query("agg38_gene_structure", ctes("exons", genes=_SPANS, gaps=_INTRONS) + """, sizes AS (SELECT gid, count(*) AS n_introns, sum(e - b + 1) AS bases, max(e - b + 1) AS longest FROM gaps GROUP BY gid)
SELECT g.gid, n_exons, coalesce(n_introns, 0) AS n_introns, CAST(coalesce(s.bases, 0) AS BIGINT) AS intron_len, CAST(coalesce(longest, 0) AS BIGINT) AS longest_intron,
CAST(greatest(b - max(e) OVER (PARTITION BY ref ORDER BY b, e DESC, g.gid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 1,
 CASE WHEN row_number() OVER (PARTITION BY ref ORDER BY b, e DESC, g.gid) = 1 THEN NULL ELSE 0 END) AS BIGINT) AS distance
FROM genes g LEFT JOIN sizes s ON g.gid = s.gid""")
def gene_structure(spark, sf):
    """AGG-38 and WIN-02: introns of each gene and its distance from the gene before."""
    xs = exons(spark, sf)
    size = F.col("end") - F.col("begin") + 1
    gaps = introns(xs).groupBy("gid").agg(F.count("*").alias("n_introns"), F.sum(size).alias("intron_len"), F.max(size).alias("longest_intron"))
    rows = g.distances(g.spans(xs)).join(gaps, "gid", "left")
    first = F.row_number().over(g.Window.partitionBy("ref").orderBy("begin", F.desc("end"), "gid")) == 1
    rows = rows.withColumn("distance", F.when(~first, F.col("distance")))
    return rows.select("gid", "n_exons", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_introns", "intron_len", "longest_intron")], "distance")


@query("win07_merge_short_introns", ctes("exons", marked="""SELECT *, CASE WHEN max(e) OVER w IS NULL OR b > max(e) OVER w + 120 THEN 1 ELSE 0 END AS new FROM exons
WINDOW w AS (PARTITION BY gid ORDER BY b, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)""", numbered="SELECT *, sum(new) OVER (PARTITION BY gid ORDER BY b, e ROWS UNBOUNDED PRECEDING) AS island FROM marked")
       + "SELECT gid, CAST(island AS BIGINT) AS exon_no, min(b) AS begin, max(e) AS stop, count(*) AS parts FROM numbered GROUP BY gid, island")
def merge_short_introns(spark, sf):
    """WIN-07: exons less than 120 bases apart become one."""
    rows = g.joined_exons(exons(spark, sf), 120)
    return rows.select("gid", F.col("exon_no").cast("long"), "begin", F.col("end").alias("stop"), "parts")


@query("join09_similar_genes", ctes("exons", genes=_SPANS) + """, shared AS (SELECT x.gid, y.gid AS other, sum(least(x.e, y.e) - greatest(x.b, y.b) + 1) AS ex, sum(CASE WHEN x.kind = 'CDS' AND y.kind = 'CDS' THEN least(x.e, y.e) - greatest(x.b, y.b) + 1 ELSE 0 END) AS cd
 FROM exons x JOIN exons y ON x.ref = y.ref AND x.gid < y.gid AND x.strand = y.strand AND x.b <= y.e AND x.e >= y.b GROUP BY x.gid, y.gid)
SELECT s.gid, other, CAST(ex AS BIGINT) AS exon_shared, CAST(cd AS BIGINT) AS cds_shared, CAST(floor(100 * cd / greatest(1, p.cds_len, q.cds_len) + 0.5) AS BIGINT) AS cds_pct,
CAST(floor(100 * ex / greatest(1, p.exon_len, q.exon_len) + 0.5) AS BIGINT) AS exon_pct FROM shared s JOIN genes p ON p.gid = s.gid JOIN genes q ON q.gid = s.other""")
def similar_genes(spark, sf):
    """JOIN-09: shared exon and CDS bases of overlapping genes."""
    return g.similar_genes(exons(spark, sf))


@query("join10_identical_models", ctes("exons", models="SELECT gid, ref, strand, string_agg((b - (gid // 50) * 2000) || '-' || (e - (gid // 50) * 2000), ',' ORDER BY b, e) AS model FROM exons WHERE kind = 'CDS' GROUP BY gid, ref, strand")
       + "SELECT model, strand, min(gid) AS first_gid, count(*) AS genes FROM models GROUP BY model, strand HAVING count(*) > 1")
def identical_models(spark, sf):
    """JOIN-10, JOIN-11 and SET-02: genes of one coding model (places taken relative to the gene); the first stands for them."""
    xs = exons(spark, sf)
    base = F.floor(F.col("gid") / 50) * 2000
    rel = xs.withColumn("begin", F.col("begin") - base).withColumn("end", F.col("end") - base)
    same = g.fingerprint(rel, ("CDS",)).groupBy("model", "strand").agg(F.min("gid").alias("first_gid"), F.count("*").alias("genes"))
    return same.where("genes > 1")


@query("set03_drop_identical", ctes("exons", models="SELECT gid, strand, string_agg((b - (gid // 50) * 2000) || '-' || (e - (gid // 50) * 2000), ',' ORDER BY b, e) AS model FROM exons WHERE kind = 'CDS' GROUP BY gid, strand")
       + "SELECT gid FROM models m WHERE gid % 2 = 0 AND NOT EXISTS (SELECT 1 FROM models o WHERE o.gid % 2 = 1 AND o.model = m.model AND o.strand = m.strand)")
def drop_identical(spark, sf):
    """SET-03: genes of one set without a twin in another, by anti join on the model."""
    xs = exons(spark, sf)
    base = F.floor(F.col("gid") / 50) * 2000
    models = g.fingerprint(xs.withColumn("begin", F.col("begin") - base).withColumn("end", F.col("end") - base), ("CDS",))
    return models.where("gid % 2 = 0").join(models.where("gid % 2 = 1"), ["model", "strand"], "left_anti").select("gid")


@query("agg24_equality_summary", ctes("exons", genes=_SPANS) + """, shared AS (SELECT x.gid, y.gid AS other, sum(CASE WHEN x.kind = 'CDS' AND y.kind = 'CDS' THEN least(x.e, y.e) - greatest(x.b, y.b) + 1 ELSE 0 END) AS cd
 FROM exons x JOIN exons y ON x.ref = y.ref AND x.gid < y.gid AND x.strand = y.strand AND x.b <= y.e AND x.e >= y.b GROUP BY x.gid, y.gid),
 pct AS (SELECT s.gid, other, CAST(floor(100 * cd / greatest(1, p.cds_len, q.cds_len) + 0.5) AS BIGINT) AS c FROM shared s JOIN genes p ON p.gid = s.gid JOIN genes q ON q.gid = s.other)
SELECT count(*) AS pairs, count(DISTINCT gid) AS genes, """ + ", ".join(f"count(*) FILTER (WHERE c >= {c}) AS c{c}" for c in (10, 33, 50, 66, 75, 90)) + " FROM pct")
def equality_summary(spark, sf):
    """AGG-24: similar pairs counted above percent cuts."""
    rows = g.similar_genes(exons(spark, sf))
    return rows.agg(F.count("*").alias("pairs"), F.count_distinct("gid").alias("genes"), *[F.count_if(F.col("cds_pct") >= c).alias(f"c{c}") for c in (10, 33, 50, 66, 75, 90)])


@query("join15_joined_exons", ctes("exons", "evidence") + """, touched AS (SELECT DISTINCT v.id AS joiner, x.gid * 100 + x.exon_no AS xid FROM exons x JOIN evidence v ON x.ref = v.ref AND x.b <= v.e AND x.e >= v.b)
SELECT a.xid AS a, b.xid AS b, count(*) AS joins FROM touched a JOIN touched b ON a.joiner = b.joiner AND a.xid < b.xid GROUP BY a.xid, b.xid HAVING count(*) >= 3""")
def joined_exons(spark, sf):
    """JOIN-15: exon pairs that three joiners or more span."""
    xs = exons(spark, sf).withColumn("xid", F.col("gid") * 100 + F.col("exon_no"))
    return g.joined_by(xs, evidence(spark, sf))


@query("join16_mate_cover", ctes("exons", "evidence") + """, clipped AS (SELECT x.gid, greatest(x.b, v.b) AS b, least(x.e, v.e) AS e FROM exons x JOIN evidence v ON x.ref = v.ref AND x.b <= v.e AND x.e >= v.b),
bases AS (SELECT DISTINCT gid, unnest(range(b, e + 1)) AS pos FROM clipped), lens AS (SELECT gid, count(DISTINCT pos) AS n FROM (SELECT gid, unnest(range(b, e + 1)) AS pos FROM exons) GROUP BY gid)
SELECT l.gid, l.n AS bases, coalesce(c.n, 0) AS covered, l.n - coalesce(c.n, 0) AS uncovered FROM lens l LEFT JOIN (SELECT gid, count(*) AS n FROM bases GROUP BY gid) c USING (gid)""")
def mate_cover(spark, sf):
    """JOIN-16: exon bases of each gene that mates cover or leave."""
    from loomspan.operators.intervals import merged, union_bases

    xs = exons(spark, sf)
    size = F.sum(F.col("end") - F.col("begin") + 1)
    whole = merged(xs, ["gid"]).groupBy("gid").agg(size.alias("bases"))
    flat = merged(xs, ["gid", "ref"])
    covered = union_bases(overlap_pairs(flat, evidence(spark, sf)), ["p_gid"]).select(F.col("p_gid").alias("gid"), F.col("union_bases").alias("covered"))
    rows = whole.join(covered, "gid", "left").withColumn("covered", F.coalesce("covered", F.lit(0)))
    return rows.select("gid", "bases", "covered", (F.col("bases") - F.col("covered")).alias("uncovered"))


@query("agg22_intron_chain", ctes("exons", sites="SELECT gid, exon_no, b // 400 AS k FROM exons") + """, joined AS (SELECT gid, exon_no, k % 3 <> 0 AS sup, CASE WHEN k % 3 <> 0 AND lag(k % 3 <> 0) OVER w AND lag(k) OVER w = k THEN 1 ELSE 0 END AS j FROM sites WINDOW w AS (PARTITION BY gid ORDER BY exon_no)),
c AS (SELECT gid, count(*) AS n_exons, count(*) FILTER (WHERE sup) AS supported, CAST(sum(j) AS BIGINT) AS joins FROM joined GROUP BY gid)
SELECT *, CASE WHEN supported = 0 THEN 'none' WHEN n_exons > 1 AND joins = n_exons - 1 THEN 'complete' WHEN 2 * joins >= n_exons - 1 THEN 'good' WHEN joins > 0 THEN 'ok' ELSE 'poor' END AS chain FROM c""")
def intron_chain(spark, sf):
    """AGG-22 and WIN-01: how introns chain the exons of each gene."""
    xs = exons(spark, sf)
    sites = xs.withColumn("intron", F.floor(F.col("begin") / 400)).where(F.col("intron") % 3 != 0).select("gid", "exon_no", "intron")
    return g.intron_chain_quality(xs, sites)


@query("join12_update_compare", ctes("exons", before="SELECT gid, count(*) AS n, min(b) AS b, max(e) AS e FROM exons WHERE gid % 5 <> 0 GROUP BY gid", after="SELECT gid, count(*) AS n, min(b) AS b, max(e) AS e FROM exons WHERE gid % 7 <> 0 AND exon_no < 5 GROUP BY gid")
       + "SELECT coalesce(x.gid, y.gid) AS gid, CASE WHEN x.gid IS NULL THEN 'new' WHEN y.gid IS NULL THEN 'gone' WHEN x.n <> y.n THEN 'exons' WHEN x.b <> y.b OR x.e <> y.e THEN 'moved' ELSE 'same' END AS change, coalesce(y.n, 0) - coalesce(x.n, 0) AS more FROM before x FULL JOIN after y ON x.gid = y.gid")
def update_compare(spark, sf):
    """JOIN-12: two versions of a gene set compared by id."""
    xs = exons(spark, sf)
    place = lambda df, k: df.groupBy("gid").agg(F.count("*").alias(f"n{k}"), F.min("begin").alias(f"b{k}"), F.max("end").alias(f"e{k}"))
    rows = place(xs.where("gid % 5 <> 0"), 1).join(place(xs.where("gid % 7 <> 0 and exon_no < 5"), 2), "gid", "full")
    change = F.expr("case when n1 is null then 'new' when n2 is null then 'gone' when n1 <> n2 then 'exons' when b1 <> b2 or e1 <> e2 then 'moved' else 'same' end")
    return rows.select("gid", change.alias("change"), (F.coalesce("n2", F.lit(0)) - F.coalesce("n1", F.lit(0))).alias("more"))


@query("sel06_greedy_selection")
def greedy_selection(spark, sf):
    """SEL-03 to SEL-06: weighted totals, then the greedy best set without overlap."""
    xs = exons(spark, sf)
    totals = g.spans(xs).select("gid", g.weighted_sum({"score": 0.01, "cds_len": 2.5}).alias("total"))
    return g.select_best(xs, totals)


@query("agg18_gene_set_statistics", ctes("exons", genes=_SPANS) + """SELECT count(*) AS genes, count(*) FILTER (WHERE cds_len / exon_len <= 0.33 OR cds_len < 120) AS noncoding, round(avg(n_exons), 6) AS mean_exons,
 list_sort(list(CAST(exon_len AS BIGINT)))[count(*) // 2 + 1] AS median_len, CAST(max(exon_len) AS BIGINT) AS longest FROM genes""")
def gene_set_statistics(spark, sf):
    """AGG-18 and AGG-16: lengths, exons and noncoding genes of a set; the median is the upper one."""
    from .statistics_queries import upper_median

    rows = g.spans(exons(spark, sf))
    noncoding = F.count_if((F.col("cds_len") / F.col("exon_len") <= 0.33) | (F.col("cds_len") < 120))
    median = upper_median(rows, "exon_len").scalar()
    return rows.agg(F.count("*").alias("genes"), noncoding.alias("noncoding"), F.round(F.avg("n_exons"), 6).alias("mean_exons"), F.max("exon_len").alias("longest")).select("*", median.alias("median_len"))


@query("seq07_cds_places", ctes("exons", lens="SELECT *, sum(e - b + 1) OVER (PARTITION BY gid ORDER BY b, e ROWS UNBOUNDED PRECEDING) AS upto FROM exons")
       + "SELECT gid, b + greatest(0, 31 - (upto - (e - b + 1)) - 1) AS begin, e - greatest(0, upto - 300) AS stop FROM lens WHERE upto >= 31 AND upto - (e - b + 1) < 300")
def cds_places(spark, sf):
    """SEQ-07: places on the genome of transcript offsets 31 to 300, from running exon lengths."""
    return g.placed_offsets(exons(spark, sf), 31, 300).select("gid", "begin", F.col("end").alias("stop"))
