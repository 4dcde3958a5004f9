"""Queries of similarity pairs, unique genes of groups and alignment patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomspan.functions import alignments
from loomspan.operators import orthology
from loomspan.session import table

from .adapters import ctes, genome_hits, sequences
from .registry import query


def protein_hits(spark, sf):
    """genome_hits between numbered proteins: q, t, spans, scores, evalue, row_no."""
    rows = genome_hits(spark, sf)
    return rows.select("q", F.expr("bigint(substring(ref, 2))").alias("t"), "qb", "qe", F.expr("tb % 3000").alias("tb"), F.expr("tb % 3000 + (te - tb)").alias("te"), "bits", "ident", "aln", F.pow(F.lit(10.0), -F.col("bits") / 20).alias("evalue"), "row_no")


@query("ort01_similarity_pairs")
def similarity_pairs(spark, sf):
    """ORT-01: pairs of proteins with summed scores and recomputed e-values, both ways, numbered."""
    lengths = table(spark, sf, "part").select(F.col("p_partkey").alias("id"), (300 + F.col("p_size") * 10).cast("long").alias("len"))
    return orthology.similarity_pairs(protein_hits(spark, sf), lengths, least_bits=40, mirror=True)


@query("agg25_group_genes", """WITH h AS (SELECT l_partkey % 700 AS gene, l_orderkey AS member, l_suppkey % 90 * 10 + l_linenumber AS grp, CAST(floor(l_extendedprice / 100) AS BIGINT) AS bits, 300 + l_partkey % 700 AS size, 200 + CAST(l_quantity AS BIGINT) * 15 AS member_size FROM lineitem),
b AS (SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY grp ORDER BY bits DESC, gene, member) = 1), t AS (SELECT gene, max(bits) AS top FROM h GROUP BY gene),
a AS (SELECT b.* FROM b JOIN t USING (gene) QUALIFY row_number() OVER (PARTITION BY gene ORDER BY CASE WHEN top <= bits + 2 THEN 0 ELSE 1 END, grp) = 1),
m AS (SELECT grp, list_reverse_sort(list(member_size))[count(*) // 2 + 1] AS median FROM h GROUP BY grp)
SELECT gene, member, grp, bits, size, median, size - median AS diff, CASE WHEN size > 1.9 * median THEN 2 WHEN size < 0.65 * median THEN -2 ELSE 0 END AS outlier FROM a JOIN m USING (grp)""")
def group_genes(spark, sf):
    """AGG-25: each ortholog group's best gene, every gene once."""
    rows = table(spark, sf, "lineitem").select(
        (F.col("l_partkey") % 700).alias("gene"), F.col("l_orderkey").alias("member"), (F.col("l_suppkey") % 90 * 10 + F.col("l_linenumber")).alias("grp"), F.floor(F.col("l_extendedprice") / 100).alias("bits"),
        (300 + F.col("l_partkey") % 700).alias("size"), (200 + F.col("l_quantity").cast("long") * 15).alias("member_size"),
    )
    return orthology.group_genes(rows)


_PATTERNS = ctes(
    "sequences",
    pairs="SELECT x.id, rpad(x.seq, CAST(greatest(length(x.seq), length(y.seq)) AS INTEGER), '-') AS x, rpad(translate(y.seq, 'T', CASE WHEN y.id % 5 = 0 THEN 'N' ELSE 'T' END), CAST(greatest(length(x.seq), length(y.seq)) AS INTEGER), '-') AS y FROM sequences x JOIN sequences y ON y.id = x.id + 1",
    begun="SELECT *, CASE WHEN strpos(y, 'ATG') > 0 AND strpos(y, 'ATG') < strpos(x, 'ATG') THEN strpos(y, 'ATG') ELSE greatest(1, strpos(x, 'ATG')) END AS start FROM pairs WHERE length(x) > 0",
    cut="SELECT id, substr(x, start) AS x, substr(y, start) AS y FROM begun",
    columns_="SELECT id, length(x) AS n, unnest(range(length(x))) AS i, unnest(string_split(x, '')) AS a, unnest(string_split(y, '')) AS b FROM cut WHERE length(x) >= 2",
    kinds="SELECT *, CASE WHEN a = '-' THEN 'g1' WHEN b = '-' THEN 'g2' WHEN a = b THEN 'eq' WHEN a = 'N' OR b = 'N' THEN 'nn' ELSE 'ne' END AS c, CASE WHEN i < 1 + n // 3 THEN 'b' WHEN i < 2 * (1 + n // 3) THEN 'm' ELSE 'e' END AS p FROM columns_",
    runs="SELECT id, max(len) AS er FROM (SELECT id, brk, count(*) FILTER (WHERE c = 'eq') AS len FROM (SELECT *, sum(CASE WHEN c NOT IN ('eq', 'nn') THEN 1 ELSE 0 END) OVER (PARTITION BY id ORDER BY i) AS brk FROM kinds) GROUP BY id, brk) GROUP BY id",
    sums="SELECT id, " + ", ".join(
        f"count(*) FILTER (WHERE {test}{part}) AS {p}_{name}"
        for p, part in (("t", ""), ("b", " AND p = 'b'"), ("m", " AND p = 'm'"), ("e", " AND p = 'e'"))
        for name, test in (("ds", "c = 'ne' AND i % 3 = 2"), ("dn", "c = 'ne' AND i % 3 <> 2"), ("gp", "c IN ('g1', 'g2')"), ("es", "c = 'eq' AND i % 3 = 2"), ("en", "c = 'eq' AND i % 3 <> 2"), ("tn", "c <> 'nn'"))
    ) + ", count(*) FILTER (WHERE c <> 'g1') AS len1, count(*) FILTER (WHERE c <> 'g2') AS len2 FROM kinds GROUP BY id",
) + """SELECT id, s.* EXCLUDE (id), er, CAST(CASE WHEN t_ds + t_es > 0 THEN floor(0.5 + 100 * t_ds / (t_ds + t_es)) ELSE 0 END AS BIGINT) AS ks, CAST(CASE WHEN t_dn + t_en > 0 THEN floor(0.5 + 100 * t_dn / (t_dn + t_en)) ELSE 0 END AS BIGINT) AS ka,
    CAST(CASE WHEN t_tn > 0 THEN floor(0.5 + 100 * t_gp / t_tn) ELSE 0 END AS BIGINT) AS gaps, CAST(CASE WHEN least(t_tn - t_gp, len1, len2) > 0 THEN floor(0.5 + 100 * er / least(t_tn - t_gp, len1, len2)) ELSE 0 END AS BIGINT) AS run FROM sums s JOIN runs USING (id)"""  # fmt: skip


@query("seq14_alignment_patterns", _PATTERNS)
def alignment_patterns(spark, sf):
    """SEQ-14: column statistics of each sequence laid beside the next one, the shorter filled up with gaps."""
    rows = sequences(spark, sf)
    other = rows.select((F.col("id") - 1).alias("id"), F.when(F.col("id") % 5 == 0, F.translate("seq", "T", "N")).otherwise(F.col("seq")).alias("other"))
    both = rows.join(other, "id").withColumn("n", F.greatest(F.length("seq"), F.length("other"))).where("n > 0")
    both = both.select("id", F.rpad("seq", F.col("n"), F.lit("-")).alias("x"), F.rpad("other", F.col("n"), F.lit("-")).alias("y"))
    counts = both.select("id", alignments.alignment_patterns(F.col("x"), F.col("y")).alias("c")).where("c.t_tn is not null")
    return counts.select("id", "c.*", *alignments.rates(F.col("c")))
