"""Queries of transcript classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomspan.operators import classes as cl
from loomspan.operators import classify as c
from loomspan.operators import graphs
from loomspan.session import table

from .adapters import ctes, members, sequences
from .registry import query


@query("cls02_duplicates", ctes("sequences") + "SELECT sha256(seq) AS key, min(id) AS first_id, count(*) AS copies FROM sequences GROUP BY seq")
def duplicates(spark, sf):
    """CLS-02: one representative a distinct sequence."""
    return c.duplicates(sequences(spark, sf))


@query("cls03_reassigned")
def reassigned(spark, sf):
    """CLS-03: representatives replaced by markedly better ones."""
    rows = table(spark, sf, "customer").select((F.col("c_custkey") % 40).alias("key"), F.col("c_custkey").alias("id"), (F.floor(F.abs("c_acctbal")) % 101).alias("pcds"))
    return c.reassigned(rows)


@query("cls04_fragments", ctes("sequences", s="SELECT id, seq FROM sequences UNION ALL SELECT id + 1000000, substr(seq, 50 + id % 40, 60 + id % 50) FROM sequences WHERE id % 9 = 0")
       + "SELECT x.id, min(y.id) AS holder FROM s x JOIN s y ON length(y.seq) > length(x.seq) AND length(x.seq) >= 24 AND contains(y.seq, x.seq) GROUP BY x.id")
def fragments(spark, sf):
    """CLS-04: sequences that a longer one holds whole."""
    rows = sequences(spark, sf)
    parts = rows.where("id % 9 = 0").select((F.col("id") + 1_000_000).alias("id"), F.col("seq").substr((50 + F.col("id") % 40).cast("int"), (60 + F.col("id") % 50).cast("int")).alias("seq"))
    return c.fragments(rows.select("id", "seq").unionByName(parts))


@query("cls08_redirects", """WITH RECURSIVE l AS (SELECT c_custkey AS id, c_custkey - 1 - c_custkey % 5 AS "to" FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey - 1 - c_custkey % 5 >= 0),
r AS (SELECT id, "to" AS "end" FROM l UNION ALL SELECT r.id, l."to" FROM r JOIN l ON l.id = r."end") SELECT id, min("end") AS "end" FROM r GROUP BY id""")
def redirects(spark, sf):
    """CLS-08: ids followed to the first of their chain."""
    key = F.col("c_custkey")
    links = table(spark, sf, "customer").where((key % 3 != 0) & (key - 1 - key % 5 >= 0)).select(key.alias("id"), (key - 1 - key % 5).alias("to"))
    return graphs.chain_ends(links)


_PAIRS = """SELECT o_orderkey AS q, 300 + o_custkey % 700 AS q_len, (o_orderkey * 13 + 7) % (SELECT count(*) FROM orders) AS t, 300 + (o_custkey * 3) % 700 AS t_len, 100 + CAST(floor(o_totalprice) AS BIGINT) % 400 AS aln,
CAST(floor((100 + CAST(floor(o_totalprice) AS BIGINT) % 400) * (1 - (o_custkey % 25) / 100)) AS BIGINT) AS ident FROM orders"""


def _pairs(spark, sf):
    orders = table(spark, sf, "orders")
    n = orders.agg(F.count("*")).scalar()
    aln = 100 + F.floor("o_totalprice") % 400
    return orders.select(
        F.col("o_orderkey").alias("q"), (300 + F.col("o_custkey") % 700).alias("q_len"), ((F.col("o_orderkey") * 13 + 7) % n).alias("t"), (300 + (F.col("o_custkey") * 3) % 700).alias("t_len"),
        aln.alias("aln"), F.floor(aln * (1 - (F.col("o_custkey") % 25) / 100)).alias("ident"),
    )


@query("cls11_pair_classes", "WITH p AS (" + _PAIRS + """), x AS (SELECT *, CAST(floor(100 * (0.5 + ident) / aln) AS BIGINT) AS pid, CAST(least(100, floor(100 * (0.5 + aln) / greatest(1, least(q_len, t_len)))) AS BIGINT) AS pal FROM p)
SELECT q, t, pid, pal, CASE WHEN pal < 25 OR pid < 80 THEN NULL WHEN t_len <= 0 THEN 'frag0aa' WHEN pid >= 99 THEN (CASE WHEN t_len < 0.5 * q_len THEN 'parthi' ELSE 'althi' END) || (CASE WHEN pal >= 98 OR t_len * (100 - pal) / 100 < 9 THEN '1' ELSE '' END)
ELSE (CASE WHEN pid >= 90 THEN 'altmid' ELSE 'altlo' END) || (CASE WHEN t_len < 0.5 * q_len THEN 'frag' ELSE '' END) END AS class FROM x""")
def pair_classes(spark, sf):
    """CLS-11: class of each alignment pair from identity, share and sizes."""
    rows = c.percents(_pairs(spark, sf))
    return rows.select("q", "t", "pid", "pal", c.class_of_pair(F.col("pid"), F.col("pal"), F.col("q_len"), F.col("t_len")).alias("class"))


def _known_pairs(spark, sf):
    """Pairs between known sequences, each with its own length."""
    rows = _pairs(spark, sf)
    length = rows.select(F.col("q").alias("id"), F.col("q_len").alias("len"))
    return rows.drop("t_len").join(length.select(F.col("id").alias("t"), F.col("len").alias("t_len")), "t")


@query("cls10_identity_classes")
def identity_classes(spark, sf):
    """CLS-10: ordered class assignment over all pairs."""
    return cl.identity_classes(_known_pairs(spark, sf))


@query("cls15_map_rescue")
def map_rescue(spark, sf):
    """CLS-15: sequences without a class take that of the genome map, where map pairs come from the orders."""
    rows, pairs = _pairs(spark, sf), _known_pairs(spark, sf)
    sizes = rows.select(F.col("q").alias("id"), F.col("q_len").alias("size"))
    maps = table(spark, sf, "orders").select(F.col("o_orderkey").alias("a"), F.col("o_orderkey").bitwiseXOR(F.lit(1 << 2).cast("long")).alias("b"), (50 + F.col("o_custkey") % 50).alias("percent"))
    return cl.rescued_by_map(cl.identity_classes(pairs), maps, sizes, pairs)


@query("cls13_reference_matches", """WITH h AS (SELECT l_orderkey AS t, l_partkey % 1000 AS ref, CAST(floor(l_extendedprice / 200) AS BIGINT) AS bits, CAST(l_quantity AS BIGINT) AS aln FROM lineitem),
m AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY t ORDER BY bits DESC, aln, ref DESC) = 1), r AS (SELECT ref, t, bits FROM h QUALIFY row_number() OVER (PARTITION BY ref ORDER BY bits DESC, aln, t DESC) = 1)
SELECT m.t, m.ref, m.bits, r.bits AS ref_best, CASE WHEN r.t = m.t THEN 'refbest' WHEN EXISTS (SELECT 1 FROM r o WHERE o.t = m.t AND o.bits >= 60) THEN 'refok' WHEN r.bits > 60 AND m.bits >= 0.9 * r.bits THEN 'refgood' END AS match FROM m JOIN r USING (ref)""")
def reference_matches(spark, sf):
    """CLS-13: best reference of every sequence, and whether it is that reference's best."""
    rows = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("t"), (F.col("l_partkey") % 1000).alias("ref"), F.floor(F.col("l_extendedprice") / 200).alias("bits"), F.col("l_quantity").cast("long").alias("aln")
    )
    return cl.reference_matches(rows)


@query("cls14_corrected_clusters", "WITH RECURSIVE " + ctes("members").removeprefix("WITH ") + """, g AS (SELECT grp AS cluster, gene AS id, gene AS place, size, ['complete', 'complete-utrpoor', 'partial3', 'partial5-utrbad', 'partial'][species % 5 + 1] AS grade, gene % 13 <> 0 AS valid, gene = min(gene) OVER (PARTITION BY grp) AS is_main FROM members),
p AS (SELECT *, CASE WHEN grade LIKE '%complete%' THEN 2 WHEN grade SIMILAR TO '.*partial[35].*' THEN 1 ELSE 0 END - CASE WHEN grade LIKE '%utrbad%' THEN 2 WHEN grade LIKE '%utrpoor%' THEN 1 ELSE 0 END AS points, row_number() OVER (PARTITION BY cluster ORDER BY place) AS n FROM g WHERE valid),
f(cluster, n, main, m_size, m_points) AS (SELECT cluster, CAST(0 AS BIGINT), max(CASE WHEN is_main THEN id END), coalesce(max(CASE WHEN is_main THEN size END), 0), coalesce(max(CASE WHEN is_main THEN points END), -9) FROM p GROUP BY cluster
 UNION ALL SELECT f.cluster, p.n, CASE WHEN (f.main IS NULL OR p.id <> f.main) AND ((p.size > m_size AND points >= m_points - 1) OR (points > m_points AND p.size > 0.98 * m_size)) THEN p.id ELSE f.main END,
 CASE WHEN (f.main IS NULL OR p.id <> f.main) AND ((p.size > m_size AND points >= m_points - 1) OR (points > m_points AND p.size > 0.98 * m_size)) THEN p.size ELSE m_size END,
 CASE WHEN (f.main IS NULL OR p.id <> f.main) AND ((p.size > m_size AND points >= m_points - 1) OR (points > m_points AND p.size > 0.98 * m_size)) THEN points ELSE m_points END FROM f JOIN p ON p.cluster = f.cluster AND p.n = f.n + 1),
e AS (SELECT cluster, arg_max(main, n) AS main FROM f GROUP BY cluster) SELECT p.cluster, p.id, e.main, p.size FROM p JOIN e USING (cluster)""")
def corrected_clusters(spark, sf):
    """CLS-14: mains of protein clusters put right by size and grade."""
    grades = F.array(*map(F.lit, ("complete", "complete-utrpoor", "partial3", "partial5-utrbad", "partial")))
    rows = members(spark, sf)
    first = rows.groupBy("grp").agg(F.min("gene").alias("first"))
    rows = rows.join(first, "grp").select(
        F.col("grp").alias("cluster"), F.col("gene").alias("id"), F.col("gene").alias("place"), "size", F.get(grades, F.col("species") % 5).alias("grade"),
        (F.col("gene") % 13 != 0).alias("valid"), (F.col("gene") == F.col("first")).alias("is_main"),
    )
    return cl.corrected_clusters(rows)


@query("cls12_keep_or_drop", """WITH p AS (SELECT doc_id, n_chars // 20 AS aa, doc_id * 7 % 100 AS pcds, coalesce(quality, 0) = 1 AS good, coalesce(toxic, 0) = 1 AS dup, n_chars % 11 AS gaps, CASE WHEN doc_id % 4 = 0 THEN 'parthi' ELSE 'althi' END AS class FROM documents LEFT JOIN labels USING (doc_id)),
b AS (SELECT *, CASE WHEN aa < 40 THEN 1 ELSE 0 END + CASE WHEN pcds < 35 THEN 2 ELSE 0 END + CASE WHEN pcds >= 35 AND pcds < 60 THEN 4 ELSE 0 END + CASE WHEN dup THEN 8 ELSE 0 END + CASE WHEN 10 * gaps > aa THEN 16 ELSE 0 END AS bits FROM p)
SELECT doc_id, CAST(bits AS INTEGER) AS bits, CASE WHEN good OR aa >= 200 THEN 'okay' WHEN class LIKE 'parthi%' AND bits > 0 THEN 'drop' WHEN bits = 0 THEN 'okay' WHEN bits & 11 > 0 THEN 'drop' ELSE 'maybeok' END AS verdict FROM b""")
def keep_or_drop(spark, sf):
    """CLS-12: poor bits and the verdict they give."""
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    aa, pcds = F.floor(F.col("n_chars") / 20), F.col("doc_id") * 7 % 100
    bits = c.poor_bits(aa, pcds, F.coalesce("toxic", F.lit(0)) == 1, F.col("n_chars") % 11)
    class_ = F.when(F.col("doc_id") % 4 == 0, "parthi").otherwise("althi")
    return rows.select("doc_id", bits.alias("bits"), c.keep_or_drop(bits, class_, F.coalesce("quality", F.lit(0)) == 1, aa).alias("verdict"))


@query("cls16_public_table", ctes("members") + """, m AS (SELECT *, first_value(gene) OVER (PARTITION BY grp ORDER BY size DESC, gene) AS main FROM members), g AS (SELECT main, row_number() OVER (ORDER BY max(CASE WHEN gene = main THEN size END) DESC, main) AS n FROM m GROUP BY main),
a AS (SELECT m.*, n, row_number() OVER (PARTITION BY m.main ORDER BY CASE WHEN gene = m.main THEN 0 ELSE 1 END, size DESC, gene) AS alt FROM m JOIN g USING (main))
SELECT gene AS id, main, n AS gene, alt, 'Ev' || lpad(CAST(n AS VARCHAR), 6, '0') || 't' || alt AS public_id FROM a""")
def public_table(spark, sf):
    """CLS-16, WIN-04 and WIN-05: genes and alternates numbered by size."""
    main = F.first("gene").over(c.Window.partitionBy("grp").orderBy(F.desc("size"), "gene"))
    rows = members(spark, sf).select(F.col("gene").alias("id"), main.alias("main"), "size")
    return c.public_table(rows, "Ev")


@query("cls17_reclassified", ctes("members", r="SELECT grp AS gene, gene AS id, size * 3 + species AS score, size, species % 3 <> 0 AS complete, gene % 2 = 0 AS same_cds, gene % 11 = 0 AS good FROM members") + """, k AS (SELECT *, row_number() OVER w AS rank, first_value(size) OVER w AS ms, first_value(complete) OVER w AS mc FROM r WINDOW w AS (PARTITION BY gene ORDER BY score DESC, id)),
d AS (SELECT *, rank = 1 OR good OR NOT ((NOT complete AND mc AND size < 0.9 * ms) OR (NOT (NOT complete AND mc) AND same_cds AND size < 0.4 * ms)) AS kept FROM k),
n AS (SELECT *, row_number() OVER (PARTITION BY gene, kept ORDER BY rank) AS number, coalesce(abs(size - lag(size) OVER (PARTITION BY gene, kept ORDER BY rank)) <= 12, false) AS close FROM d)
SELECT gene, id, rank, kept AND NOT (number > 4 AND close AND NOT good) AS kept FROM n""")
def reclassified(spark, sf):
    """CLS-17 and TOP-06: alternates of each gene kept or dropped against its main."""
    rows = members(spark, sf).select(
        F.col("grp").alias("gene"), F.col("gene").alias("id"), (F.col("size") * 3 + F.col("species")).alias("score"), "size",
        (F.col("species") % 3 != 0).alias("complete"), (F.col("gene") % 2 == 0).alias("same_cds"), (F.col("gene") % 11 == 0).alias("good"),
    )
    return c.reclassified(rows)


@query("cls19_loci", """WITH RECURSIVE e AS (SELECT c_custkey AS a, c_custkey // 30 * 30 + (c_custkey * 17 + c_nationkey) % 30 AS b FROM customer), u AS (SELECT a, b FROM e WHERE a <> b UNION SELECT b, a FROM e WHERE a <> b),
r AS (SELECT a AS id, a AS s FROM u UNION SELECT u.b, r.s FROM r JOIN u ON u.a = r.id) SELECT id, min(s) AS component FROM r GROUP BY id""")
def loci(spark, sf):
    """CLS-19, JOIN-15 labels and SET-05: connected components of equivalences of all customers."""
    key = F.col("c_custkey")
    return graphs.components(table(spark, sf, "customer").select(key.alias("a"), (F.floor(key / 30) * 30 + (key * 17 + F.col("c_nationkey")) % 30).alias("b")))
