"""Queries over alignment hits and ortholog groups."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from loomspan.functions.statistics import evalue_weight
from loomspan.operators import groups as gr
from loomspan.operators import hits as h

from .adapters import ctes, hits, members, taxon_hits
from .registry import query

_BEST = "SELECT q, t, sum(bits) AS bits, sum(aln) AS aln FROM hits GROUP BY q, t"


@query("agg03_chain_sums")
def chain_sums(spark, sf):
    """AGG-03: summed scores of hits that don't overlap accepted ones."""
    return h.chain_sums(hits(spark, sf))


@query("agg04_best_target", ctes("hits", sums=_BEST) + "SELECT q, t, CAST(bits AS BIGINT) AS bits FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY bits DESC, t) AS r FROM sums) WHERE r = 1")
def best_target(spark, sf):
    """AGG-04: the target with the highest summed bits, ties to the smaller id."""
    sums = hits(spark, sf).groupBy("q", "t").agg(F.sum("bits").alias("bits"))
    return h.best_targets(sums).select("q", "t", "bits")


@query("agg05_preferred_best", ctes("hits", sums=_BEST) + "SELECT q, t, CAST(bits AS BIGINT) AS bits FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY CASE WHEN t = 2 THEN 1 ELSE 0 END DESC, bits DESC, t) AS r FROM sums) WHERE r = 1")
def preferred_best(spark, sf):
    """AGG-05: the best within a preferred group where there is one."""
    sums = hits(spark, sf).groupBy("q", "t").agg(F.sum("bits").alias("bits"))
    return h.preferred_best(sums, F.col("t") == 2).select("q", "t", "bits")


@query("flt10_running_prune", ctes("hits") + """, strong AS (SELECT *, bits > 0.3 * max(bits) OVER (PARTITION BY q ORDER BY row_no ROWS UNBOUNDED PRECEDING) AS s FROM hits),
seen AS (SELECT *, bool_or(s) OVER (PARTITION BY q, t ORDER BY row_no ROWS UNBOUNDED PRECEDING) AS k FROM strong) SELECT q, t, row_no, bits FROM seen WHERE k""")
def running_prune(spark, sf):
    """FLT-10: hits weak against the best so far go, unless their target has one already."""
    return h.pruned(hits(spark, sf)).select("q", "t", "row_no", "bits")


@query("top04_limit_per_query", ctes("hits") + "SELECT q, t, row_no FROM (SELECT *, row_number() OVER (PARTITION BY q ORDER BY bits DESC, row_no) AS r FROM hits) WHERE r <= 3")
def limit_per_query(spark, sf):
    """TOP-04 and WIN-08: the best three hits of each query."""
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("bits"), "row_no"))
    return hits(spark, sf).withColumn("r", rank).where("r <= 3").select("q", "t", "row_no")


@query("flt04_identity_filters", ctes("hits") + "SELECT t, count(*) AS n FROM hits WHERE floor(100 * ident / aln + 0.5) >= 90 AND regexp_matches(CAST(q AS VARCHAR), '^1') AND NOT regexp_matches(CAST(q AS VARCHAR), '7$') GROUP BY t")
def identity_filters(spark, sf):
    """FLT-03 to FLT-05: patterns on ids and a least identity in rounded percent."""
    q = F.col("q").cast("string")
    keep = (F.floor(100 * F.col("ident") / F.col("aln") + 0.5) >= 90) & q.rlike("^1") & ~q.rlike("7$")
    return hits(spark, sf).where(keep).groupBy("t").agg(F.count("*").alias("n"))


@query("cls09_pair_table", ctes("hits", sums="SELECT q, t, sum(aln) AS aln, sum(ident) AS ident, sum(bits) AS bits FROM (SELECT q, q + t + 1 AS t, aln, ident, bits FROM hits) GROUP BY q, t", lens="SELECT o_orderkey AS id, 60 + o_custkey % 240 AS length FROM orders") + """,
kept AS (SELECT s.q, l.length AS q_len, s.t, m.length AS t_len, s.aln, s.ident, s.bits FROM sums s JOIN lens l ON l.id = s.q JOIN lens m ON m.id = s.t WHERE s.q <> s.t AND 100 * s.aln / least(l.length, m.length) >= 25)
SELECT q, q_len, t, t_len, CAST(aln AS DOUBLE) AS aln, CAST(ident AS DOUBLE) AS ident, CAST(bits AS DOUBLE) AS bits FROM kept
UNION ALL SELECT id, length, id, length, length, length, length FROM lens WHERE id NOT IN (SELECT q FROM kept)""")
def pair_table(spark, sf):
    """CLS-09: alignment pairs above a share of the shorter sequence; a row against itself for the rest."""
    from loomspan.session import table

    rows = hits(spark, sf).select("q", (F.col("q") + F.col("t") + 1).alias("t"), "aln", "ident", "bits")
    sums = rows.groupBy("q", "t").agg(*[F.sum(c).cast("double").alias(c) for c in ("aln", "ident", "bits")])
    lengths = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), (60 + F.col("o_custkey") % 240).alias("length"))
    return h.pair_table(sums, lengths)


_E = "*, CASE WHEN power >= 150 THEN 0 ELSE pow(10, -power) END AS evalue"


def _taxon(spark, sf):
    return taxon_hits(spark, sf).withColumn("evalue", F.when(F.col("power") >= 150, 0.0).otherwise(F.pow(F.lit(10.0), -F.col("power"))))


_ORTHO = ctes("taxon_hits", e=f"SELECT {_E} FROM taxon_hits", first="SELECT * FROM (SELECT *, rank() OVER (PARTITION BY q, t_sp ORDER BY evalue) AS r FROM e WHERE q_sp <> t_sp) WHERE r = 1")
_W = "CASE WHEN {0} = 0 THEN 316 ELSE -log10({0}) END"


@query("ort03_orthologs", _ORTHO + f"SELECT x.q AS a, x.t AS b, round(({_W.format('x.evalue')} + {_W.format('y.evalue')}) / 2, 3) AS w FROM first x JOIN first y ON x.q = y.t AND x.t = y.q WHERE x.q < x.t")
def orthologs(spark, sf):
    """ORT-03, ORT-05, JOIN-19, WIN-11 and WIN-12: reciprocal best hits between species, ties kept."""
    return h.orthologs(_taxon(spark, sf))


@query("ort02_inparalogs", _ORTHO + f""", other AS (SELECT q, min(evalue) AS best FROM e WHERE q_sp <> t_sp GROUP BY q), own AS (SELECT e.* FROM e LEFT JOIN other o ON o.q = e.q WHERE q_sp = t_sp AND e.q <> t AND (best IS NULL OR evalue < best))
SELECT x.q AS a, x.t AS b, round(({_W.format('x.evalue')} + {_W.format('y.evalue')}) / 2, 3) AS w FROM own x JOIN own y ON x.q = y.t AND x.t = y.q WHERE x.q < x.t""")
def inparalogs(spark, sf):
    """ORT-02: reciprocal hits within a species better than any outside it."""
    return h.inparalogs(_taxon(spark, sf))


@query("join20_coorthologs", _ORTHO + f""", ortho AS (SELECT x.q AS a, x.t AS b FROM first x JOIN first y ON x.q = y.t AND x.t = y.q WHERE x.q < x.t),
other AS (SELECT q, min(evalue) AS best FROM e WHERE q_sp <> t_sp GROUP BY q), own AS (SELECT e.* FROM e LEFT JOIN other o ON o.q = e.q WHERE q_sp = t_sp AND e.q <> t AND (best IS NULL OR evalue < best)),
para AS (SELECT x.q AS a, x.t AS b FROM own x JOIN own y ON x.q = y.t AND x.t = y.q WHERE x.q < x.t),
kin AS (SELECT a AS o, b AS k FROM para UNION SELECT b, a FROM para UNION SELECT a, a FROM ortho UNION SELECT b, b FROM ortho),
more AS (SELECT DISTINCT least(x.k, y.k) AS a, greatest(x.k, y.k) AS b FROM ortho o JOIN kin x ON x.o = o.a JOIN kin y ON y.o = o.b WHERE x.k <> y.k EXCEPT SELECT a, b FROM ortho)
SELECT m.a, m.b, round(({_W.format('x.evalue')} + {_W.format('y.evalue')}) / 2, 3) AS w FROM more m JOIN e x ON x.q = m.a AND x.t = m.b JOIN e y ON y.q = m.b AND y.t = m.a""")
def coorthologs(spark, sf):
    """JOIN-20 and ORT-06: edges that in-paralogs of ortholog pairs add."""
    rows = _taxon(spark, sf)
    return h.coorthologs(h.orthologs(rows), h.inparalogs(rows), rows)


@query("ort07_normalised_weights", _ORTHO + f""", edges AS (SELECT x.q AS a, x.t AS b, least(x.q_sp, x.t_sp) AS s, greatest(x.q_sp, x.t_sp) AS u, round(({_W.format('x.evalue')} + {_W.format('y.evalue')}) / 2, 3) AS w
FROM first x JOIN first y ON x.q = y.t AND x.t = y.q WHERE x.q < x.t) SELECT a, b, s, u, round(w / avg(w) OVER (PARTITION BY s, u), 3) AS w FROM edges""")
def normalised_weights(spark, sf):
    """ORT-06 and ORT-07: weights over their species pair's mean."""
    edges = h.orthologs(_taxon(spark, sf)).withColumn("a_sp", F.col("a") % 4).withColumn("b_sp", F.col("b") % 4)
    return h.normalised(edges)


@query("ort04_percent_match", ctes("hits", side="""SELECT q, t, CASE WHEN t_len >= q_len THEN q_len ELSE t_len END AS length, CASE WHEN t_len >= q_len THEN qb ELSE tb END AS b, CASE WHEN t_len >= q_len THEN qe ELSE te END AS e
        FROM (SELECT h.*, 300 + o_custkey % 600 AS q_len, 400 + 300 * t AS t_len FROM hits h JOIN orders ON o_orderkey = q)""",
    bases="SELECT DISTINCT q, t, length, unnest(generate_series(b, e)) AS base FROM side") + "SELECT q, t, 100 * count(*) / max(length) AS match FROM bases GROUP BY q, t")
def percent_match(spark, sf):
    """ORT-04: percent of the shorter sequence that a pair's hits cover, bases counted once."""
    from loomspan.session import table

    lengths = table(spark, sf, "orders").select(F.col("o_orderkey").alias("q"), (300 + F.col("o_custkey") % 600).alias("q_len"))
    return h.percent_match(hits(spark, sf).join(lengths, "q").withColumn("t_len", 400 + 300 * F.col("t")))


@query("ort08_clusters")
def clusters(spark, sf):
    """ORT-08: Markov clusters of the ortholog graph."""
    return h.clusters(h.orthologs(_taxon(spark, sf)))


@query("mth03_evalue_weight", ctes("taxon_hits", e=f"SELECT {_E} FROM taxon_hits") + f"SELECT q_sp, t_sp, count(*) AS n, round(sum({_W.format('evalue')}), 3) AS w FROM e GROUP BY q_sp, t_sp")
def evalue_weights(spark, sf):
    """MTH-03: weights of e-values."""
    return _taxon(spark, sf).groupBy("q_sp", "t_sp").agg(F.count("*").alias("n"), F.round(F.sum(evalue_weight(F.col("evalue"))), 3).alias("w"))


@query("agg30_group_matrix", ctes("members") + "SELECT grp, count(*) AS genes, count(DISTINCT species) AS taxa, " + ", ".join(f"count(*) FILTER (WHERE species = {s}) AS s{s}" for s in range(25)) + " FROM members GROUP BY grp")
def group_matrix(spark, sf):
    """AGG-30: genes of each species in each group."""
    return gr.matrix(members(spark, sf), list(range(25)))


@query("agg30_species_classes", ctes("members", cell="SELECT grp, species, count(*) AS n FROM members GROUP BY grp, species", taxa="SELECT grp, count(*) AS taxa FROM cell GROUP BY grp") + """SELECT species, CAST(sum(n) AS BIGINT) AS in_gene, count(*) AS n_group, CAST(sum(CASE WHEN taxa = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_genes,
count(*) FILTER (WHERE taxa > 1 AND n = 1) AS orth1, count(*) FILTER (WHERE taxa > 1 AND n > 1) AS or_dup, CAST(max(n) AS BIGINT) AS g_max FROM cell JOIN taxa USING (grp) GROUP BY species""")
def species_classes(spark, sf):
    """AGG-30 and ORT-09: class counts of each species' genes."""
    return gr.species_classes(members(spark, sf))


@query("agg26_common_groups", ctes("members", sets="SELECT *, species % 3 AS s FROM members", common="SELECT grp FROM (SELECT grp, count(DISTINCT species % 3) AS n FROM members GROUP BY grp) WHERE n = 3") + """SELECT s, 'all' AS level, count(*) AS genes, count(DISTINCT grp) AS groups, round(avg(size), 6) AS mean_size FROM sets GROUP BY s
UNION ALL SELECT s, 'common', count(*), count(DISTINCT grp), round(avg(size), 6) FROM sets WHERE grp IN (SELECT grp FROM common) GROUP BY s""")
def common_groups(spark, sf):
    """AGG-26: averages of gene sets over all groups and over those that all sets share."""
    return gr.set_averages(members(spark, sf).withColumn("s", F.col("species") % 3), "s")


@query("agg25_size_outliers", ctes("members", med="SELECT grp, list_reverse_sort(list(size))[count(*) // 2 + 1] AS median FROM members GROUP BY grp") + """SELECT gene, grp, size, median, CASE WHEN size > 1.9 * median THEN 2 WHEN size < 0.65 * median THEN -2 ELSE 0 END AS outlier FROM members JOIN med USING (grp)""")
def size_outliers(spark, sf):
    """AGG-25: members far from their group's median size."""
    return gr.outliers(members(spark, sf))


@query("agg28_best_set_per_group", ctes("members", best="SELECT grp, species % 3 AS s, max(size) AS size FROM members GROUP BY grp, species % 3", top="SELECT grp, max(size) AS top FROM best GROUP BY grp") + """, cls AS (SELECT grp, s, size, CASE WHEN size = top THEN 'best' WHEN size >= 0.95 * top THEN 'same' ELSE 'diff' END AS class FROM best JOIN top USING (grp))
SELECT s, class, count(*) AS n, round(avg(size), 6) AS mean FROM cls GROUP BY s, class""")
def best_set_per_group(spark, sf):
    """AGG-28: how each set's best member compares with the best of all in its group."""
    return gr.best_by_set(members(spark, sf).withColumn("s", F.col("species") % 3), "s")


@query("agg31_mean_match", ctes("members", pairs="SELECT a.grp, least(a.size, b.size) / greatest(a.size, b.size) AS m FROM members a JOIN members b ON a.grp = b.grp AND a.gene < b.gene") + "SELECT grp, count(*) AS pairs, round(avg(m), 6) AS mean FROM pairs GROUP BY grp")
def mean_match(spark, sf):
    """AGG-31: mean likeness of the pairs within a group."""
    return gr.mean_match(members(spark, sf))
