"""Queries over sequences and names."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomspan.functions import names as nm
from loomspan.functions import sequences as sq
from loomspan.session import table

from .adapters import ctes, sequences
from .registry import query

_RC = "reverse(translate(seq, 'ACGT', 'TGCA'))"
_TABLE = "MAP {" + ", ".join(f"'{c}': '{a}'" for c, a in sq.CODONS.items()) + "}"


def _protein(seq: str) -> str:
    return f"array_to_string(list_transform(range(0, length({seq}) // 3), lambda i: {_TABLE}[substr({seq}, i * 3 + 1, 3)]), '')"


@query("seq01_translate", ctes("sequences", f=f"SELECT id, seq AS a, substr(seq, 3) AS b, {_RC} AS c FROM sequences")
       + f"SELECT id, {_protein('a')} AS plus1, {_protein('b')} AS plus3, {_protein('c')} AS minus1 FROM f")
def translate(spark, sf):
    """SEQ-01: proteins of three frames."""
    seq = F.col("seq")
    return sequences(spark, sf).select("id", sq.translate(seq).alias("plus1"), sq.translate(seq, 3).alias("plus3"), sq.translate(seq, -1).alias("minus1"))


@query("seq02_reverse_complement", ctes("sequences") + f"SELECT id, {_RC} AS rc FROM sequences")
def reverse_complement(spark, sf):
    """SEQ-02."""
    return sequences(spark, sf).select("id", sq.reverse_complement(F.col("seq")).alias("rc"))


@query("seq03_open_frames")
def open_frames(spark, sf):
    """SEQ-03: open reading frames of both strands."""
    each = sequences(spark, sf).select("id", F.explode(sq.open_frames()(F.col("seq"))).alias("o"))
    return each.select("id", "o.*")


@query("seq04_best_frame")
def best_frame(spark, sf):
    """SEQ-04 to SEQ-06 and CLS-01: the best frame of each sequence and its grade."""
    best = sq.best_frame(sequences(spark, sf), "id")
    pcds, grade = sq.protein_grade(F.col("aa"), F.col("length"), F.col("complete"))
    return best.withColumns({"pcds": pcds, "grade": grade}).withColumn("quality", sq.quality_score(F.col("grade"), F.col("pcds")))


_BACK = "MAP {" + ", ".join(f"'{a}': '{c}'" for a, c in sq.BACK.items()) + "}"


@query("seq08_back_translate", ctes("sequences", p=f"SELECT id, {_protein('seq')} AS aa FROM sequences") + f"SELECT id, array_to_string(list_transform(range(1, length(aa) + 1), lambda i: {_BACK}[substr(aa, i, 1)]), '') AS cds FROM p")
def back_translate(spark, sf):
    """SEQ-08: a coding sequence of each protein."""
    return sequences(spark, sf).select("id", sq.back_translate(sq.translate(F.col("seq"))).alias("cds"))


@query("seq09_letter_counts", ctes("sequences") + "SELECT id, length(seq) AS bases, CAST(0 AS BIGINT) AS gaps, round((length(seq) - length(translate(seq, 'GC', ''))) / greatest(length(seq), 1), 6) AS gc FROM sequences")
def letter_counts(spark, sf):
    """SEQ-09 and SRC-07 sizes: bases, gaps and GC share."""
    return sequences(spark, sf).select("id", *sq.sizes(F.col("seq")))


_HEX = "h AS (SELECT id, substr(seq, i * 3 + 1, 6) AS hexamer FROM (SELECT id, seq, unnest(range(0, (length(seq) - 6) // 3 + 1)) AS i FROM sequences WHERE length(seq) >= 6))"


@query("seq10_hexamer_score", ctes("sequences").rstrip() + f""", {_HEX}, t AS (SELECT hexamer, ln(count(*) FILTER (WHERE id % 2 = 0) + 1) - ln(count(*) FILTER (WHERE id % 2 = 1) + 1) AS ratio FROM h GROUP BY hexamer)
SELECT id, round(sum(ratio) / count(*), 6) AS score FROM h JOIN t USING (hexamer) GROUP BY id""")
def hexamer_score(spark, sf):
    """SEQ-10: log ratios of in-frame hexamers, the table taken from even against odd ids."""
    rows = sequences(spark, sf)
    counts = sq.hexamer_counts(rows, "id")
    n = lambda bit: F.sum(F.when(F.col("id") % 2 == bit, F.col("n")).otherwise(0)) + 1
    ratios = counts.groupBy("hexamer").agg((F.log(n(0)) - F.log(n(1))).alias("ratio"))
    return sq.hexamer_scores(rows, ratios, "id")


_PLACES = [f"count(*) FILTER (WHERE x = '{b}' AND i % 3 = {k} AND i < n) AS {b}{k}" for b in "ACGT" for k in range(3)]
_ASYM = ", ".join("round(greatest({0}) / (least({0}) + 1), 6) AS asym_{1}".format(", ".join(f"coalesce({b}{k}, 0)" for k in range(3)), b.lower()) for b in "ACGT")


@query("seq11_position_asymmetry", ctes(
    "sequences", u="SELECT id, length(seq) - length(seq) % 3 AS n, unnest(string_split(seq, '')) AS x, generate_subscripts(string_split(seq, ''), 1) - 1 AS i FROM sequences",
    k=f"SELECT id, {', '.join(_PLACES)} FROM u GROUP BY id") + f"SELECT s.id, {_ASYM} FROM sequences s LEFT JOIN k USING (id)")
def position_asymmetry(spark, sf):
    """SEQ-11: asymmetry of bases over codon places."""
    return sequences(spark, sf).select("id", *sq.position_asymmetry(F.col("seq")))


@query("seq12_class_consensus", ctes("sequences", s="SELECT id, length(seq) % 100 / 100 AS a, id % 10 / 10 AS b, (length(seq) + id) % 7 / 6 AS c FROM sequences",
       k="SELECT id, " + ", ".join(f"CASE WHEN {x} < 0.74 THEN 0 WHEN {x} >= 0.95 THEN 1 END AS {x}" for x in "abc") + " FROM s")
       + "SELECT id, CASE WHEN coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0) >= 2 THEN 'Code' WHEN coalesce(1 - a, 0) + coalesce(1 - b, 0) + coalesce(1 - c, 0) >= 2 THEN 'Noncode' ELSE 'Unknown' END AS class FROM k")
def class_consensus(spark, sf):
    """SEQ-12: majority of three coding calls."""
    n = F.length("seq")
    scores = (n % 100 / 100, F.col("id") % 10 / 10, (n + F.col("id")) % 7 / 6)
    return sequences(spark, sf).select("id", sq.consensus_class(*map(sq.coding_class, scores)).alias("class"))


@query("seq17_extract", ctes("sequences") + "SELECT id, CASE WHEN id % 2 = 1 THEN reverse(translate(substr(seq, 11, 50), 'ACGT', 'TGCA')) ELSE substr(seq, 11, 50) END AS part FROM sequences")
def extract(spark, sf):
    """SRC-08 and SEQ-17: parts of sequences by place and strand."""
    strand = F.when(F.col("id") % 2 == 1, "-").otherwise("+")
    return sequences(spark, sf).select("id", sq.extracted(F.col("seq"), F.lit(11), F.lit(60), strand).alias("part"))


@query("seq20_n50", ctes("sequences") + """, l AS (SELECT id, length(seq) AS n FROM sequences), r AS (SELECT n, sum(n) OVER (ORDER BY n DESC, id) AS upto, sum(n) OVER () AS total, count(*) OVER () AS c FROM l)
SELECT any_value(c) AS n, CAST(any_value(total) AS BIGINT) AS total, CAST(max(n) AS BIGINT) AS n50 FROM r WHERE 2 * upto >= total""")
def n50(spark, sf):
    """SEQ-20."""
    return sq.n50(sequences(spark, sf).select(F.length("seq").cast("long").alias("length")))


@query("seq15_snp_effects", ctes("sequences") + f""", snp AS (SELECT id, unnest(range(3, length(seq) - length(seq) % 3, 7)) AS pos, seq FROM sequences),
c AS (SELECT id, pos, substr(seq, pos - pos % 3 + 1, 3) AS old, pos % 3 AS k, translate(seq[pos + 1], 'ACGT', 'GTAC') AS alt FROM snp),
d AS (SELECT *, CASE k WHEN 0 THEN alt || old[2:3] WHEN 1 THEN old[1] || alt || old[3] ELSE old[1:2] || alt END AS new FROM c)
SELECT id, pos, {_TABLE}[old] AS before, {_TABLE}[new] AS after, {_TABLE}[old] = {_TABLE}[new] AS synonymous FROM d""")
def snp_effects(spark, sf):
    """SEQ-15: what a changed base does to its codon."""
    rows = sequences(spark, sf).select("id", F.posexplode(sq.codons(F.col("seq"))).alias("codon", "old"))
    first = 3 * F.col("codon").cast("long")
    rows = rows.withColumn("at", first + F.pmod(3 - first, F.lit(7))).where(F.col("at") < first + 3)  # every seventh place from 3: one a codon at most
    old = F.col("old")
    alt = F.translate(old.substr((F.col("at") % 3 + 1).cast("int"), F.lit(1)), "ACGT", "GTAC")
    new = F.overlay(old, alt, (F.col("at") % 3 + 1).cast("int"))
    rows = rows.select("id", F.col("at").alias("pos"), sq.translate(old).alias("before"), sq.translate(new).alias("after"))
    return rows.withColumn("synonymous", F.col("before") == F.col("after"))


@query("str03_clean_names")
def clean_names(spark, sf):
    """STR-03 and STR-10: names cleaned and graded by a percent identity."""
    raw = F.concat(F.when(F.col("p_size") % 3 == 0, "PREDICTED: ").when(F.col("p_size") % 7 == 0, "similar to ").otherwise(""), "p_name", F.when(F.col("p_size") % 5 == 0, " isoform 2").otherwise(""))
    return table(spark, sf, "part").select("p_partkey", raw.alias("raw"), nm.graded(raw, F.col("p_size") * 2).alias("name"), nm.is_te(raw).alias("te"))


@query("str07_public_ids", "SELECT c_custkey, 'Ev' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') || 't' || (c_nationkey % 9 + 1) AS id, 'Ev' || lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS gene, 'Ev' AS prefix FROM customer")
def public_ids(spark, sf):
    """STR-04, STR-05 and STR-07: public ids, their genes and prefixes."""
    id_ = nm.public_id("Ev", F.col("c_custkey"), F.col("c_nationkey") % 9 + 1)
    return table(spark, sf, "customer").select("c_custkey", id_.alias("id"), nm.gene_of(id_).alias("gene"), nm.species_prefix(id_).alias("prefix"))


@query("agg42_recased_names", """WITH n AS (SELECT CASE WHEN p_partkey % 3 = 0 THEN upper(p_name) ELSE p_name END AS name FROM part), e AS (SELECT lower(name) AS lower, name, count(*) AS c FROM n GROUP BY 1, 2)
SELECT lower, name, CAST(n AS BIGINT) AS n FROM (SELECT lower, name, sum(c) OVER (PARTITION BY lower) AS n, row_number() OVER (PARTITION BY lower ORDER BY c DESC, name) AS r FROM e) WHERE r = 1""")
def recased_names(spark, sf):
    """AGG-42 and STR-09: the most frequent spelling of each name."""
    name = F.when(F.col("p_partkey") % 3 == 0, F.upper("p_name")).otherwise(F.col("p_name"))
    return nm.recased(table(spark, sf, "part").select(name.alias("name")))


@query("agg32_consensus_name", """WITH m AS (SELECT p_partkey % 50 AS grp, p_partkey AS gene, p_name AS name FROM part), w AS (SELECT DISTINCT grp, gene, name, unnest(string_split(lower(name), ' ')) AS word FROM m),
c AS (SELECT grp, word, count(*) AS n FROM w GROUP BY grp, word), r AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY n DESC, word) AS rank, count(*) OVER (PARTITION BY grp) AS words FROM c),
s AS (SELECT w.grp, gene, name, sum(greatest(1, 100 - 3 * rank)) AS score FROM w JOIN r ON r.grp = w.grp AND r.word = w.word AND rank <= greatest(1, floor(0.7 * words)) GROUP BY w.grp, gene, name)
SELECT grp, name, CAST(score AS BIGINT) AS score FROM (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY score DESC, gene) AS k FROM s) WHERE k = 1""")
def consensus_names(spark, sf):
    """AGG-32: the member name that speaks for each group."""
    from loomspan.operators.groups import consensus_name

    rows = table(spark, sf, "part").select((F.col("p_partkey") % 50).alias("grp"), F.col("p_partkey").alias("gene"), F.col("p_name").alias("name"))
    return consensus_name(rows)


@query("top07_short_lists", "WITH l AS (SELECT c_custkey % 30 AS g, list_sort(list(c_custkey)) AS ids FROM customer GROUP BY 1) SELECT g, array_to_string(ids[1:20], ',') || CASE WHEN len(ids) > 20 THEN ',..' || (len(ids) - 20) ELSE '' END AS ids FROM l")
def short_lists(spark, sf):
    """TOP-07: lists cut to twenty with the number of the rest."""
    rows = table(spark, sf, "customer").groupBy((F.col("c_custkey") % 30).alias("g")).agg(F.array_sort(F.collect_list("c_custkey")).alias("ids"))
    return rows.select("g", nm.short_list(F.col("ids").cast("array<string>")).alias("ids"))


@query("str01_attributes", "SELECT event_id, regexp_extract(props, '\"k\": ([0-9]+)', 1) AS k, 'k=' || regexp_extract(props, '\"k\": ([0-9]+)', 1) || ';type=' || event_type AS attrs FROM events")
def attributes(spark, sf):
    """STR-01 and STR-02: attributes taken out of text and written back."""
    from loomspan.sources.readers import attribute_map, attribute_text

    raw = F.concat(F.lit("old=1;k="), F.regexp_extract("props", r'"k": (\d+)', 1), F.lit(";type="), F.col("event_type"))
    attrs = attribute_map(raw)
    kept = F.map_filter(attrs, lambda k, v: k != "old")
    return table(spark, sf, "events").select("event_id", attrs["k"].alias("k"), attribute_text(kept).alias("attrs"))


@query("flt12_trimmed_transcripts")
def trimmed_transcripts(spark, sf):
    """FLT-12: sequences without vector spans and end gaps, frames carried along; frames and hits come from the sequences and the orders."""
    from loomspan.operators.trimming import trim_transcripts, vector_spans

    rows = sequences(spark, sf).where("id is not null")
    size = F.length("seq")
    given = rows.select("id", "seq", (F.col("id") % 50 + 1).alias("cds_begin"), F.when(size > 200, size - 60).alias("cds_end"))
    n = rows.agg(F.max("id") + 1).scalar()
    hits = table(spark, sf, "orders").select(
        (F.col("o_orderkey") % n).alias("id"), (F.col("o_custkey") * 7 % 900 + 1).alias("begin"), (F.col("o_custkey") * 7 % 900 + 20 + F.floor("o_totalprice") % 60).alias("end"),
        F.when(F.col("o_orderpriority") < "2", "Weak").when(F.col("o_orderpriority") < "4", "Strong").otherwise("Moderate").alias("kind"),
    )
    return trim_transcripts(given, vector_spans(hits))
