"""Queries of statistics, read counts and wide tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomspan.functions import statistics as st
from loomspan.functions.statistics import upper_median
from loomspan.operators import reads as rd

from .adapters import ctes, evidence, features, hits, members, reads
from .registry import query

_GROUPS = ["click", "error", "purchase", "signup", "view"]
_CUTS = [0, 0.001, 0.33, 0.66, 0.95]


@query("agg12_count_by_group", ctes("reads") + "SELECT feature, " + ", ".join(f"count(*) FILTER (WHERE grp = '{g}') AS \"{g}\"" for g in _GROUPS) + " FROM reads GROUP BY feature")
def count_by_group(spark, sf):
    """AGG-12: reads per feature and read group."""
    return rd.counts_by_group(reads(spark, sf), "feature", "grp", _GROUPS)


@query("join23_table_paste", ctes("reads") + "SELECT CASE WHEN grouping(feature) = 1 THEN '#TOTAL' ELSE CAST(feature AS VARCHAR) END AS feature, " + ", ".join(f"count(*) FILTER (WHERE grp = '{g}') AS \"{g}\"" for g in _GROUPS) + " FROM reads GROUP BY ROLLUP (feature)")
def table_paste(spark, sf):
    """JOIN-23: sample counts side by side with a total row."""
    counts = reads(spark, sf).groupBy("feature", "grp").agg(F.count("*").alias("n"))
    return rd.pasted(counts, "feature", "grp", "n", _GROUPS)


@query("agg13_tile_log_ratios", ctes("reads") + """, tiles AS (SELECT pos // 86400 AS tile, count(*) FILTER (WHERE grp = 'view') AS e, count(*) FILTER (WHERE grp = 'click') AS c FROM reads GROUP BY pos // 86400),
logs AS (SELECT *, CASE WHEN e < 1 THEN 0 ELSE ln(e) END AS le, CASE WHEN c < 1 THEN 0 ELSE ln(c) END AS lc FROM tiles)
SELECT tile, e AS views, c AS clicks, round((le + lc) / 2, 6) AS a, round(le - lc, 6) AS m FROM logs""")
def tile_log_ratios(spark, sf):
    """AGG-13: mean log and log ratio of two groups per tile."""
    rows = reads(spark, sf).groupBy(F.floor(F.col("at") / 86400).alias("tile")).agg(F.count_if(F.col("grp") == "view").alias("views"), F.count_if(F.col("grp") == "click").alias("clicks"))
    a, m = st.log_mean_ratio(F.col("views"), F.col("clicks"))
    return rows.select("tile", "views", "clicks", F.round(a, 6).alias("a"), F.round(m, 6).alias("m"))


@query("agg16_medians", ctes("members") + """SELECT species, count(*) AS n, CAST(min(size) AS BIGINT) AS least, list_sort(list(size))[count(*) // 2 + 1] AS median, list_reverse_sort(list(size))[count(*) // 2 + 1] AS low_median,
CAST(max(size) AS BIGINT) AS most, CAST(floor(avg(size)) AS BIGINT) AS mean FROM members GROUP BY species""")
def medians(spark, sf):
    """AGG-16 and AGG-25: sizes per species with upper and lower medians."""
    rows = members(spark, sf)
    whole = rows.groupBy("species").agg(F.count("*").alias("n"), F.min("size").alias("least"), F.max("size").alias("most"), F.floor(F.avg("size")).alias("mean"))
    return whole.join(upper_median(rows, "size", ["species"]), "species").join(st.lower_median(rows, "size", ["species"], "low_median"), "species")


@query("agg17_cut_counts", ctes("hits") + "SELECT t, " + ", ".join(f"count(*) FILTER (WHERE ident / aln >= {c}) AS ge_{i}" for i, c in enumerate(_CUTS)) + " FROM hits GROUP BY t")
def cut_counts(spark, sf):
    """AGG-17: values that reach each cut."""
    return hits(spark, sf).groupBy("t").agg(*st.cut_counts(F.col("ident") / F.col("aln"), _CUTS))


@query("agg29_mean_and_deviation", ctes("members") + """SELECT grp, count(*) AS n, round(avg(size), 4) AS mean, round(CASE WHEN count(*) < 3 OR var_samp(size) < 1 THEN 0 ELSE stddev_samp(size) END, 4) AS sd,
round(CASE WHEN count(*) < 3 OR var_samp(size) < 1 THEN 0 ELSE stddev_samp(size) END / sqrt(count(*)), 4) AS sem FROM members GROUP BY grp""")
def mean_and_deviation(spark, sf):
    """AGG-29: mean, deviation and standard error."""
    rows = members(spark, sf).groupBy("grp").agg(F.count("*").alias("n"), F.round(F.avg("size"), 4).alias("mean"), st.deviation("size").alias("raw"))
    return rows.select("grp", "n", "mean", F.round("raw", 4).alias("sd"), F.round(F.col("raw") / F.sqrt("n"), 4).alias("sem"))


@query("top01_longest", ctes("members") + "SELECT gene, size FROM members ORDER BY size DESC, gene LIMIT 1000")
def longest(spark, sf):
    """TOP-01: the thousand largest."""
    return members(spark, sf).select("gene", "size").orderBy(F.desc("size"), "gene").limit(1000)


@query("agg39_longest_summary", ctes("members") + "SELECT count(*) AS n, CAST(floor(avg(size)) AS BIGINT) AS mean, list_sort(list(size))[count(*) // 2 + 1] AS median, min(size) AS least, max(size) AS most FROM (SELECT size FROM members ORDER BY size DESC, gene LIMIT 1000)")
def longest_summary(spark, sf):
    """AGG-39: summary of the thousand largest."""
    rows = longest(spark, sf)
    median = upper_median(rows, "size").scalar()
    return rows.agg(F.count("*").alias("n"), F.floor(F.avg("size")).alias("mean"), F.min("size").alias("least"), F.max("size").alias("most")).select("*", median.alias("median"))


@query("agg40_class_counts", """WITH c AS (SELECT source, CASE WHEN quality = 1 AND toxic = 0 THEN 'okay' ELSE 'drop' END AS class FROM documents JOIN labels USING (doc_id))
SELECT CASE WHEN grouping(source) = 1 THEN 'total' ELSE source END AS source, count(*) FILTER (WHERE class = 'okay') AS okay, count(*) FILTER (WHERE class = 'drop') AS dropped,
floor(1000 * count(*) FILTER (WHERE class = 'okay') / count(*)) / 10 AS pct_okay FROM c GROUP BY ROLLUP (source)""")
def class_counts(spark, sf):
    """AGG-40: kept and dropped per group, with a total row and percents cut to one decimal."""
    from loomspan.session import table

    rows = table(spark, sf, "documents").select("doc_id", "source").join(table(spark, sf, "labels"), "doc_id")
    ok = (F.col("quality") == 1) & (F.col("toxic") == 0)
    sums = rows.rollup("source").agg(F.count_if(ok).alias("okay"), F.count_if(~ok).alias("dropped"), F.count("*").alias("n"), F.grouping("source").alias("all"))
    return sums.select(F.when(F.col("all") == 1, "total").otherwise(F.col("source")).alias("source"), "okay", "dropped", (F.floor(1000 * F.col("okay") / F.col("n")) / 10).alias("pct_okay"))


@query("agg43_distinct", ctes("hits") + "SELECT t, count(DISTINCT q) AS queries, count(DISTINCT bits) AS scores FROM hits GROUP BY t")
def distinct(spark, sf):
    """AGG-43: exact distinct counts."""
    return hits(spark, sf).groupBy("t").agg(F.count_distinct("q").alias("queries"), F.count_distinct("bits").alias("scores"))


@query("join14_read_counts", ctes("features", "evidence") + """, pairs AS (SELECT v.id, f.fid, f.type, f.source FROM evidence v JOIN features f ON f.ref = v.ref AND f.b <= v.e AND f.e >= v.b),
barred AS (SELECT DISTINCT id FROM pairs WHERE source = 'N') SELECT fid, count(DISTINCT id) AS reads FROM pairs WHERE id NOT IN (SELECT id FROM barred) GROUP BY fid""")
def read_counts(spark, sf):
    """JOIN-14: reads per feature; reads that touch a barred type count nowhere."""
    feats = features(spark, sf).drop("type").withColumnRenamed("source", "type")
    return rd.count_reads(evidence(spark, sf), feats, "^N$").withColumnRenamed("b_fid", "fid")


@query("flt13_read_filter", ctes("features", "evidence") + """SELECT id, EXISTS (SELECT 1 FROM features f WHERE f.type = 'F' AND f.ref = v.ref AND f.b <= v.e AND f.e >= v.b) AS inside FROM evidence v""")
def read_filter(spark, sf):
    """FLT-13: the overlap set and its complement."""
    ev, feats = evidence(spark, sf), features(spark, sf).where("type = 'F'")
    return rd.filtered(ev, feats).select("id", F.lit(True).alias("inside")).union(rd.filtered(ev, feats, inside=False).select("id", F.lit(False)))


@query("win04_alternate_numbers", ctes("members") + "SELECT gene, grp, row_number() OVER (PARTITION BY grp ORDER BY size DESC, gene) AS alt FROM members")
def alternate_numbers(spark, sf):
    """WIN-04: alternates of a gene numbered by size."""
    from pyspark.sql import Window

    alt = F.row_number().over(Window.partitionBy("grp").orderBy(F.desc("size"), "gene"))
    return members(spark, sf).select("gene", "grp", alt.cast("long").alias("alt"))


@query("win03_running_maximum", ctes("members") + """SELECT gene, grp, size FROM (SELECT *, max(size) OVER (PARTITION BY grp ORDER BY gene ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS best FROM members) WHERE best IS NULL OR size >= 0.9 * best""")
def running_maximum(spark, sf):
    """WIN-03: rows close to the best seen so far in their group."""
    from pyspark.sql import Window

    best = F.max("size").over(Window.partitionBy("grp").orderBy("gene").rowsBetween(Window.unboundedPreceding, -1))
    return members(spark, sf).withColumn("best", best).where("best is null or size >= 0.9 * best").select("gene", "grp", "size")


@query("str06_human_bases", ctes("members") + """, t AS (SELECT gene, size * 37 AS n FROM members), w AS (SELECT gene, n, CASE WHEN n >= 1000000 THEN CAST(floor(n / 100000) / 10 AS VARCHAR) || 'Mb' WHEN n >= 1000 THEN CAST(floor(n / 100) / 10 AS VARCHAR) || 'Kb' ELSE CAST(n AS VARCHAR) END AS text FROM t)
SELECT gene, text, CAST(round(CAST(regexp_extract(text, '^([0-9.]+)', 1) AS DOUBLE) * CASE WHEN text LIKE '%Mb' THEN 1000000 WHEN text LIKE '%Kb' THEN 1000 ELSE 1 END) AS BIGINT) AS back FROM w""")
def human_bases(spark, sf):
    """STR-06: base counts written for people, and read again."""
    rows = members(spark, sf).select("gene", st.human_bases(F.col("size") * 37).alias("text"))
    return rows.select("gene", "text", st.bases_of(F.col("text")).alias("back"))


@query("set04_common_groups", ctes("members") + "SELECT grp, count(DISTINCT species % 5) AS sets FROM members GROUP BY grp HAVING count(DISTINCT species % 5) = (SELECT count(DISTINCT species % 5) FROM members)")
def common_groups(spark, sf):
    """SET-04: groups that every set has."""
    rows = members(spark, sf).withColumn("s", F.col("species") % 5)
    sets = rows.agg(F.count_distinct("s")).scalar()
    return rows.groupBy("grp").agg(F.count_distinct("s").alias("sets")).where(F.col("sets") == sets)


@query("set06_id_sets", ctes("members") + "SELECT 'union' AS op, count(*) AS n FROM (SELECT grp FROM members WHERE species < 9 UNION SELECT grp FROM members WHERE species > 5) UNION ALL SELECT 'both', count(*) FROM (SELECT grp FROM members WHERE species < 9 INTERSECT SELECT grp FROM members WHERE species > 5) UNION ALL SELECT 'first', count(*) FROM (SELECT grp FROM members WHERE species < 3 EXCEPT SELECT grp FROM members WHERE species > 22)")
def id_sets(spark, sf):
    """SET-01 and SET-06: union, intersection and difference of id sets."""
    rows = members(spark, sf)
    ids = lambda test: rows.where(test).select("grp")
    n = lambda df, op: df.agg(F.lit(op).alias("op"), F.count("*").alias("n"))
    out = n(ids("species < 9").union(ids("species > 5")).distinct(), "union").union(n(ids("species < 9").intersect(ids("species > 5")), "both"))
    return out.union(n(ids("species < 3").subtract(ids("species > 22")), "first"))
