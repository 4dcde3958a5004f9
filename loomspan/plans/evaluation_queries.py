"""Queries of gene-set evaluation, merging, annotation classes and aligned reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomspan.operators import evaluation as ev
from loomspan.operators import reads as rd
from loomspan.session import table

from .adapters import ctes, exons
from .registry import query

_KNOWN = "SELECT gid - gid % 3 AS gid, ref, b + gid % 3 AS b, e, gid * 100 + exon_no AS xid FROM exons WHERE gid % 3 = 0 OR gid % 7 = 0"


def _sets(spark, sf):
    xs = exons(spark, sf).withColumn("xid", F.col("gid") * 100 + F.col("exon_no"))
    known = xs.where("gid % 3 = 0 or gid % 7 = 0").select((F.col("gid") - F.col("gid") % 3).alias("gid"), "ref", (F.col("begin") + F.col("gid") % 3).alias("begin"), "end", "xid")
    return xs.select("gid", "ref", "begin", "end", "xid"), known


@query("agg21_model_grades", ctes("exons", known=_KNOWN) + """, shared AS (SELECT x.gid, k.gid AS known, sum(least(x.e, k.e) - greatest(x.b, k.b) + 1) AS bases FROM exons x JOIN known k ON x.ref = k.ref AND x.b <= k.e AND x.e >= k.b GROUP BY x.gid, k.gid),
r AS (SELECT *, row_number() OVER w AS rank, lead(bases) OVER w AS second, count(*) OVER (PARTITION BY gid) AS touched FROM shared WINDOW w AS (PARTITION BY gid ORDER BY bases DESC, known)),
p AS (SELECT gid, sum(e - b + 1) AS p_size FROM exons GROUP BY gid), k AS (SELECT gid, sum(e - b + 1) AS k_size FROM known GROUP BY gid)
SELECT p.gid, r.known, CAST(r.bases AS BIGINT) AS bases, CAST(p_size AS BIGINT) AS p_size, CAST(k_size AS BIGINT) AS k_size, coalesce(2 * second >= bases, false) AS "join",
CASE WHEN bases IS NULL THEN 'none' WHEN bases / p_size > 0.94 AND bases / k_size > 0.94 AND touched = 1 THEN 'perfect' WHEN bases / p_size > 0.69 AND bases / k_size > 0.65 THEN 'mostly' ELSE 'partial' END AS grade
FROM p LEFT JOIN (SELECT * FROM r WHERE rank = 1) r ON r.gid = p.gid LEFT JOIN k ON k.gid = r.known""")
def model_grades(spark, sf):
    """AGG-20 and AGG-21: grade of each predicted model against the known one it shares most with."""
    return ev.matched_models(*_sets(spark, sf))


@query("agg20_exon_accuracy", ctes("exons", known=_KNOWN) + """, same AS (SELECT x.gid * 100 + x.exon_no AS p, k.xid AS k FROM exons x JOIN known k ON x.ref = k.ref AND x.b = k.b AND x.e = k.e)
SELECT (SELECT count(*) FROM exons) AS predicted, (SELECT count(*) FROM known) AS known, count(DISTINCT p) AS right, count(DISTINCT k) AS found FROM same""".replace("AS right", 'AS "right"'))
def exon_accuracy(spark, sf):
    """AGG-20: exons predicted exactly."""
    return ev.exon_accuracy(*_sets(spark, sf))


@query("join24_replace", "SELECT c_custkey AS gid, CASE WHEN c_custkey % 5 = 0 THEN 'new' ELSE 'old' END AS version FROM customer UNION ALL SELECT c_custkey + 10000000, 'new' FROM customer WHERE c_custkey % 50 = 0")
def replace(spark, sf):
    """JOIN-24 and SEL-09: records replaced by their updates, new ones added."""
    rows = table(spark, sf, "customer").select(F.col("c_custkey").alias("gid"))
    more = rows.where("gid % 5 = 0").union(rows.where("gid % 50 = 0").select(F.col("gid") + 10_000_000))
    return ev.replaced(rows.withColumn("version", F.lit("old")), more.withColumn("version", F.lit("new")))


@query("sel07_must_keep", "SELECT o_custkey AS gid, CASE WHEN o_custkey % 4 = 0 THEN 'kept' ELSE 'missing' END AS state FROM orders WHERE o_orderpriority LIKE '1%' GROUP BY o_custkey")
def must_keep(spark, sf):
    """SEL-07: wanted genes and whether the selection has them."""
    selected = table(spark, sf, "customer").where("c_custkey % 4 = 0").select(F.col("c_custkey").alias("gid"))
    wanted = table(spark, sf, "orders").where(F.col("o_orderpriority").startswith("1")).select(F.col("o_custkey").alias("gid"))
    return ev.must_keep(selected, wanted)


@query("flt08_last_action", "SELECT o_custkey AS id, arg_max(o_orderstatus, o_orderkey) AS action FROM orders GROUP BY o_custkey")
def last_action(spark, sf):
    """FLT-08 and WIN-06: the last action listed for each id."""
    return ev.last_action(table(spark, sf, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderstatus").alias("action"), F.col("o_orderkey").alias("row_no")))


@query("sel10_evidence_classes", """WITH m AS (SELECT c_custkey AS gid, c_custkey % 4 = 0 AS s, c_custkey % 3 = 0 AS m, c_custkey % 2 = 0 AS w, c_custkey % 7 = 0 AS poor, c_custkey % 5 = 0 AS utr, c_custkey % 31 = 0 AS te, c_acctbal < 0 AS part FROM customer),
l AS (SELECT *, CASE WHEN s THEN 3 WHEN m THEN 2 WHEN w THEN 1 ELSE 0 END AS l0 FROM m), d AS (SELECT *, CASE WHEN utr AND l0 > 0 THEN l0 - 1 ELSE l0 END AS l FROM l)
SELECT gid, CASE WHEN te THEN 'Transposon' WHEN l = 3 THEN 'Strong' WHEN l = 2 THEN 'Medium' WHEN poor THEN 'Poor' WHEN l = 1 THEN 'Weak' ELSE 'None' END || CASE WHEN part THEN 'Partial' ELSE '' END AS class FROM d""")
def evidence_classes(spark, sf):
    """SEL-10: the class that marks of evidence give."""
    k = F.col("c_custkey")
    every = lambda n: k % n == 0
    marks = [every(n).cast("int") for n in (4, 3, 2)]
    class_ = ev.evidence_class(*marks, every(7), every(5), every(31), F.col("c_acctbal") < 0)
    return table(spark, sf, "customer").select(k.alias("gid"), class_.alias("class"))


@query("join21_best_of_sets", """WITH r AS (SELECT o_custkey AS locus, o_orderstatus AS "set", max(CAST(floor(o_totalprice) AS BIGINT)) AS score FROM orders GROUP BY 1, 2)
SELECT locus, "set", score, lead FROM (SELECT *, row_number() OVER w AS rank, score - lead(score) OVER w AS lead FROM r WINDOW w AS (PARTITION BY locus ORDER BY score DESC, "set")) WHERE rank = 1""")
def best_of_sets(spark, sf):
    """JOIN-21: the best of three gene sets at each locus."""
    rows = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("locus"), F.col("o_orderstatus").alias("set")).agg(F.max(F.floor("o_totalprice")).alias("score"))
    return ev.best_of_sets(rows)


_LINES = "l_quantity AS q, l_partkey AS p, concat('c', l_suppkey % 50) AS ref, l_partkey * 10 + 1 AS loc, l_linenumber AS flag"


def _sam(spark, sf):
    """Reads with a CIGAR of an aligned part, a gap and another part, from lineitem."""
    part, gap = F.col("l_quantity").cast("long").cast("string"), (F.col("l_partkey") % 9 * 100 + 50).cast("string")
    return table(spark, sf, "lineitem").select(
        F.concat(F.lit("c"), (F.col("l_suppkey") % 50).cast("string")).alias("ref"), (F.col("l_partkey") * 10 + 1).alias("loc"), F.when(F.col("l_linenumber") % 2 == 0, "-").otherwise("+").alias("strand"),
        F.col("l_linenumber").alias("flag"), F.concat(F.when(F.col("l_linenumber") == 1, "3S").otherwise(""), part, F.lit("M"), gap, F.lit("N20M")).alias("cigar"),
    )


@query("agg37_read_introns", """SELECT concat('c', l_suppkey % 50) AS ref, l_partkey * 10 + 1 + CAST(l_quantity AS BIGINT) AS begin, l_partkey * 10 + CAST(l_quantity AS BIGINT) + l_partkey % 9 * 100 + 50 AS stop,
CASE WHEN l_linenumber % 2 = 0 THEN '-' ELSE '+' END AS strand, count(*) AS reads FROM lineitem GROUP BY 1, 2, 3, 4""")
def read_introns(spark, sf):
    """AGG-37: introns of reads, counted."""
    return rd.introns(_sam(spark, sf)).withColumnRenamed("end", "stop")


@query("agg14_read_statistics", "SELECT count(*) AS reads, " + ", ".join(f"count(*) FILTER (WHERE l_linenumber & {b} <> 0) AS {n}" for b, n in ((1, "paired"), (2, "proper"), (4, "unmapped"), (16, "reverse"), (256, "secondary")))
       + ", count(*) AS spliced, count(*) FILTER (WHERE l_linenumber = 1) AS clipped FROM lineitem")
def read_statistics(spark, sf):
    """AGG-14: counters over flags and CIGARs."""
    return rd.statistics(_sam(spark, sf))
