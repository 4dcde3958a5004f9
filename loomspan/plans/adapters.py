"""The driver's tables projected onto the data model, as DataFrames and as the same views in SQL.

The projections are arithmetic on the tables' own columns. Identifiers are unique within their order key, so numbering
them needs one shuffle by that key and no global order.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.session import table

_LINES = "row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_shipdate)"


def features(spark: SparkSession, sf: str) -> DataFrame:
    """Located features from lineitem: fid, ref, begin, end, strand, type, source, score."""
    rows = table(spark, sf, "lineitem")
    return rows.select(
        (F.col("l_orderkey") * 1000 + F.expr(_LINES)).alias("fid"),
        F.concat(F.lit("c"), (F.col("l_suppkey") % 50).cast("string")).alias("ref"),
        (F.col("l_partkey") * 10 + 1).alias("begin"),
        (F.col("l_partkey") * 10 + F.col("l_quantity").cast("long") * 4).alias("end"),
        F.translate("l_returnflag", "RAN", "-+.").alias("strand"),
        F.col("l_linestatus").alias("type"),
        F.col("l_returnflag").alias("source"),
        F.floor("l_extendedprice").alias("score"),
    )


def evidence(spark: SparkSession, sf: str) -> DataFrame:
    """Evidence spans from orders: id, ref, begin, end, strand."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit("c"), (F.col("o_custkey") % 50).cast("string")).alias("ref"),
        (F.col("o_orderkey") + 1).alias("begin"),
        (F.col("o_orderkey") + 1 + F.floor("o_totalprice") % 900).alias("end"),
        F.when(F.col("o_orderpriority") < "2", "+").when(F.col("o_orderpriority") < "4", "-").otherwise(".").alias("strand"),
    )


def exons(spark: SparkSession, sf: str) -> DataFrame:
    """Gene records: one order is a gene, its lines are exons in place order. gid, ref, strand, exon_no, begin, end, kind, score, cust."""
    rows = table(spark, sf, "lineitem").withColumn("exon_no", F.expr(_LINES).cast("long"))
    begin = F.floor(F.col("l_orderkey") / 50) * 2000 + F.col("exon_no") * 300 + F.col("l_partkey") % 100
    return rows.select(
        F.col("l_orderkey").alias("gid"),
        F.concat(F.lit("c"), (F.col("l_orderkey") % 50).cast("string")).alias("ref"),
        F.when(F.col("l_orderkey") % 3 == 0, "-").otherwise("+").alias("strand"),
        "exon_no",
        begin.alias("begin"),
        (begin + F.col("l_quantity").cast("long") * 4 + 9).alias("end"),
        F.when(F.col("exon_no") % 2 == 0, "CDS").otherwise("exon").alias("kind"),
        F.floor("l_extendedprice").alias("score"),
        F.col("l_suppkey").alias("supp"),
    )


def transcripts(spark: SparkSession, sf: str) -> DataFrame:
    """Transcripts of loci: ten order keys share a locus and its exon places; lines leave exons out or lengthen them. As exons, kind by exon_no."""
    rows = table(spark, sf, "lineitem").withColumn("exon_no", F.expr(_LINES).cast("long"))
    locus = F.floor(F.col("l_orderkey") / 10)
    base = F.floor(locus / 50) * 5000 + F.col("exon_no") * 500
    long_quantity = F.col("l_quantity").cast("long")
    return rows.where(long_quantity % 6 != 0).select(
        F.col("l_orderkey").alias("gid"), F.concat(F.lit("c"), (locus % 50).cast("string")).alias("ref"), F.when(locus % 2 == 0, "-").otherwise("+").alias("strand"), "exon_no",
        (base + F.when(F.col("l_partkey") % 5 == 0, 1).otherwise(41)).alias("begin"), (base + F.when(F.col("l_suppkey") % 5 == 0, 320).otherwise(240)).alias("end"),
        F.when(F.col("exon_no") == 1, "exon").otherwise("CDS").alias("kind"), long_quantity.alias("score"),
    )


def hits(spark: SparkSession, sf: str) -> DataFrame:
    """Alignment hits: q, t, qb, qe, tb, te, aln, ident, bits, evalue, row_no."""
    rows = table(spark, sf, "lineitem")
    qb, tb = F.col("l_partkey") % 400 + 1, (F.col("l_partkey") * 7) % 400 + 1
    aln = F.col("l_quantity").cast("long")
    return rows.select(
        F.col("l_orderkey").alias("q"), (F.col("l_suppkey") % 3).alias("t"), qb.alias("qb"), (qb + aln * 2).alias("qe"), tb.alias("tb"), (tb + aln * 2).alias("te"),
        aln.alias("aln"), (aln - F.floor(F.col("l_discount") * 100 + 0.5)).alias("ident"), F.floor(F.col("l_extendedprice") / 100).alias("bits"), F.expr(_LINES).cast("long").alias("row_no"),
    )


def genome_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Hits of proteins on scaffolds: q, ref, strand, qb, qe, tb, te, aln, ident, bits, row_no. Places in stretches of 30,000 bases follow the query."""
    rows = table(spark, sf, "lineitem").withColumn("line", F.expr(_LINES).cast("long"))
    aln, tb = F.col("l_quantity").cast("long"), (F.col("l_orderkey") * 37 + F.col("line") * 1009) % 2_000_000
    minus = F.col("l_suppkey") % 2 == 1
    along = F.floor(tb % 30_000 / 60)
    qb = F.when(minus, 500 - along).otherwise(along) + 1
    return rows.select(
        (F.col("l_partkey") % 997).alias("q"), F.concat(F.lit("c"), (F.col("l_suppkey") % 7).cast("string")).alias("ref"), F.when(minus, "-").otherwise("+").alias("strand"),
        qb.alias("qb"), (qb + aln).alias("qe"), (tb + 1).alias("tb"), (tb + 3 * aln).alias("te"), aln.alias("aln"), (aln - F.floor(F.col("l_discount") * 100 + 0.5)).alias("ident"),
        F.floor(F.col("l_extendedprice") / 100).alias("bits"), (F.col("l_orderkey") * 10 + F.col("line")).alias("row_no"),
    )


_LETTERS = b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
_TO_BASES, _NO_LETTERS = bytes.maketrans(_LETTERS, b"ACGT" * 13), bytes(set(range(256)) - set(_LETTERS))


def _bases(texts: pd.Series) -> pd.Series:
    # one pass over the bytes; translate() and regexp_replace() look at each character as a string
    return pd.Series([t if t is None else t.encode("utf-8", "surrogatepass").translate(_TO_BASES, _NO_LETTERS).decode("ascii") for t in texts], dtype=object)


def sequences(spark: SparkSession, sf: str) -> DataFrame:
    """Nucleotide sequences from texts: letters stand for bases, all else goes. id, seq, source."""
    # said to be nondeterministic, so that no filter on what comes out has the texts go through it twice
    bases = F.pandas_udf(_bases, "string").asNondeterministic()
    return table(spark, sf, "documents").select(F.col("doc_id").alias("id"), bases("text").alias("seq"), "source")


def scaffold_genes(spark: SparkSession, sf: str) -> DataFrame:
    """Genes on the sequences, taken as scaffolds: one in 700 bases, of up to four exons. gid, exon_no, ref, strand, begin, end, kind, score."""
    rows = sequences(spark, sf).select(F.col("id").alias("ref"), F.length("seq").alias("size")).where("ref is not null and size > 300")
    rows = rows.select("ref", "size", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("size") - 300) / 700))).alias("g"))
    rows = rows.select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(4).cast("long"))).alias("exon_no"))
    mark = F.col("ref") + F.col("g") * 7 + F.col("exon_no") * 3
    begin = F.col("g") * 700 + F.col("exon_no") * 150 - 60 + mark % 29
    rows = rows.select((F.col("ref") * 1000 + F.col("g")).alias("gid"), "exon_no", "ref", F.substring(F.lit("+-."), ((F.col("ref") + F.col("g")) % 3 + 1).cast("int"), F.lit(1)).alias("strand"), begin.alias("begin"), (begin + 90 + mark % 53).alias("end"), F.lit("exon").alias("kind"), F.lit(0).alias("score"), "size")
    return rows.where("end <= size").drop("size")


def stranded_introns(spark: SparkSession, sf: str) -> DataFrame:
    """Introns in stretches of 10,000 bases with 15,000 between, most stretches of one strand: ref, strand, begin, end, score."""
    place = (F.col("o_orderkey") * 61) % 1_000_000
    begin = F.floor(place / 10_000) * 25_000 + place % 10_000 + 1
    kind, odd = F.floor(place / 7_000) % 5, F.col("o_custkey") % 2 == 1
    minus = F.when(kind < 2, False).when(kind < 4, True).otherwise(odd)
    return table(spark, sf, "orders").select(
        F.concat(F.lit("c"), (F.col("o_custkey") % 20).cast("string")).alias("ref"), F.when(minus, "-").otherwise("+").alias("strand"),
        begin.alias("begin"), (begin + 50 + F.col("o_custkey") % 700).alias("end"), (F.floor("o_totalprice") % 4 + 1).alias("score"),
    )


def members(spark: SparkSession, sf: str) -> DataFrame:
    """Members of gene groups: gene, species, grp, size."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("gene"), F.col("c_nationkey").cast("long").alias("species"), (F.col("c_custkey") % 300).alias("grp"),
        (F.floor(F.abs("c_acctbal")) + 100).alias("size"),
    )


def reads(spark: SparkSession, sf: str) -> DataFrame:
    """Read counts: feature, grp, value, at (seconds as a position)."""
    return table(spark, sf, "events").select(
        F.col("user_id").alias("feature"), F.col("event_type").alias("grp"), "value", F.unix_timestamp(F.col("ts").cast("timestamp")).alias("at"), "event_id"
    )


def taxon_hits(spark: SparkSession, sf: str) -> DataFrame:
    """Hits between proteins of several species, both ways, with e-values. q, t, q_sp, t_sp, evalue."""
    rows = table(spark, sf, "lineitem")
    part, other = F.col("l_partkey") % 400, (F.col("l_orderkey") * 7 + F.col("l_suppkey")) % 400
    power = F.floor(F.col("l_extendedprice") / 1000).cast("long") + F.when((part - other) % 40 == 0, 60).otherwise(0)
    once = rows.select(part.alias("x"), other.alias("y"), power.alias("power")).where("x <> y")
    base = once.union(once.select("y", "x", F.col("power") - 1)).groupBy("x", "y").agg(F.max("power").alias("power"))
    return base.select(F.col("x").alias("q"), F.col("y").alias("t"), (F.col("x") % 4).alias("q_sp"), (F.col("y") % 4).alias("t_sp"), "power")


SQL = {
    "features": f"""SELECT l_orderkey * 1000 + {_LINES} AS fid, concat('c', l_suppkey % 50) AS ref, l_partkey * 10 + 1 AS b,
        l_partkey * 10 + CAST(l_quantity AS BIGINT) * 4 AS e, translate(l_returnflag, 'RAN', '-+.') AS strand, l_linestatus AS type, l_returnflag AS source,
        CAST(floor(l_extendedprice) AS BIGINT) AS score FROM lineitem""",
    "evidence": """SELECT o_orderkey AS id, concat('c', o_custkey % 50) AS ref, o_orderkey + 1 AS b, o_orderkey + 1 + CAST(floor(o_totalprice) AS BIGINT) % 900 AS e,
        CASE WHEN o_orderpriority < '2' THEN '+' WHEN o_orderpriority < '4' THEN '-' ELSE '.' END AS strand FROM orders""",
    "exons": f"""SELECT gid, ref, strand, exon_no, b, b + q * 4 + 9 AS e, CASE WHEN exon_no % 2 = 0 THEN 'CDS' ELSE 'exon' END AS kind, score, supp FROM (
        SELECT l_orderkey AS gid, concat('c', l_orderkey % 50) AS ref, CASE WHEN l_orderkey % 3 = 0 THEN '-' ELSE '+' END AS strand, exon_no,
        (l_orderkey // 50) * 2000 + exon_no * 300 + l_partkey % 100 AS b, CAST(l_quantity AS BIGINT) AS q, CAST(floor(l_extendedprice) AS BIGINT) AS score, l_suppkey AS supp
        FROM (SELECT *, {_LINES} AS exon_no FROM lineitem))""",
    "transcripts": f"""SELECT l_orderkey AS gid, concat('c', (l_orderkey // 10) % 50) AS ref, CASE WHEN (l_orderkey // 10) % 2 = 0 THEN '-' ELSE '+' END AS strand, exon_no,
        (l_orderkey // 500) * 5000 + exon_no * 500 + CASE WHEN l_partkey % 5 = 0 THEN 1 ELSE 41 END AS b, (l_orderkey // 500) * 5000 + exon_no * 500 + CASE WHEN l_suppkey % 5 = 0 THEN 320 ELSE 240 END AS e,
        CASE WHEN exon_no = 1 THEN 'exon' ELSE 'CDS' END AS kind, CAST(l_quantity AS BIGINT) AS score FROM (SELECT *, {_LINES} AS exon_no FROM lineitem) WHERE CAST(l_quantity AS BIGINT) % 6 <> 0""",
    "hits": f"""SELECT l_orderkey AS q, l_suppkey % 3 AS t, l_partkey % 400 + 1 AS qb, l_partkey % 400 + 1 + CAST(l_quantity AS BIGINT) * 2 AS qe,
        (l_partkey * 7) % 400 + 1 AS tb, (l_partkey * 7) % 400 + 1 + CAST(l_quantity AS BIGINT) * 2 AS te, CAST(l_quantity AS BIGINT) AS aln,
        CAST(l_quantity AS BIGINT) - CAST(floor(l_discount * 100 + 0.5) AS BIGINT) AS ident, CAST(floor(l_extendedprice / 100) AS BIGINT) AS bits, {_LINES} AS row_no FROM lineitem""",
    "sequences": """SELECT doc_id AS id, regexp_replace(translate(text, 'abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ', repeat('ACGT', 13)), '[^ACGT]+', '', 'g') AS seq, source FROM documents""",
    "stranded_introns": """SELECT concat('c', o_custkey % 20) AS ref, CASE WHEN place // 7000 % 5 < 2 THEN '+' WHEN place // 7000 % 5 < 4 THEN '-' WHEN o_custkey % 2 = 1 THEN '-' ELSE '+' END AS strand,
        place // 10000 * 25000 + place % 10000 + 1 AS b, place // 10000 * 25000 + place % 10000 + 51 + o_custkey % 700 AS e, CAST(floor(o_totalprice) AS BIGINT) % 4 + 1 AS score
        FROM (SELECT *, o_orderkey * 61 % 1000000 AS place FROM orders)""",
    "members": "SELECT c_custkey AS gene, CAST(c_nationkey AS BIGINT) AS species, c_custkey % 300 AS grp, CAST(floor(abs(c_acctbal)) AS BIGINT) + 100 AS size FROM customer",
    "reads": "SELECT user_id AS feature, event_type AS grp, value, CAST(floor(epoch_us(ts) / 1000000) AS BIGINT) AS pos, event_id FROM events",
    "once": """SELECT x, y, p + CASE WHEN (x - y) % 40 = 0 THEN 60 ELSE 0 END AS p FROM (SELECT l_partkey % 400 AS x, (l_orderkey * 7 + l_suppkey) % 400 AS y,
        CAST(floor(l_extendedprice / 1000) AS BIGINT) AS p FROM lineitem) WHERE x <> y""",
    "taxon_hits": """SELECT x AS q, y AS t, x % 4 AS q_sp, y % 4 AS t_sp, max(power) AS power FROM (SELECT x, y, p AS power FROM once UNION ALL SELECT y, x, p - 1 FROM once) GROUP BY x, y""",
}


def ctes(*names: str, **more: str) -> str:
    """WITH clause of the named views, then of more."""
    views = {x: SQL[x] for n in names for x in (["once", n] if n == "taxon_hits" else [n])} | more
    return "WITH " + ",\n".join(f"{n} AS ({sql})" for n, sql in views.items()) + "\n"
