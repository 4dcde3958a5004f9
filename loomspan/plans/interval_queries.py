"""Queries of the interval algebra: overlap joins, unions, differences, coverage, densities, lifts."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomspan.operators import intervals as iv

from .adapters import ctes, evidence, exons, features
from .registry import query

_SUMS = "SELECT f.ref AS ref, count(*) AS pairs, CAST(sum(greatest(least(f.e, v.e) - greatest(f.b, v.b) + 1, 0)) AS BIGINT) AS bases"
_SHARED = "(least(f.e, v.e) - greatest(f.b, v.b) + 1)"


def _join_sql(on: str) -> str:
    return ctes("features", "evidence") + f"{_SUMS} FROM features f JOIN evidence v ON f.ref = v.ref AND {on} GROUP BY f.ref"


def _sums(pairs):
    return pairs.groupBy(F.col("p_ref").alias("ref")).agg(F.count("*").alias("pairs"), F.sum("overlap").alias("bases"))


_OVERLAP = "f.b <= v.e AND f.e >= v.b"
_JOINS = {
    "join01_overlap": ({}, _OVERLAP),
    "join02_stranded": ({"strand": "same"}, f"{_OVERLAP} AND (f.strand = v.strand OR f.strand = '.' OR v.strand = '.')"),
    "join02_opposite_strand": ({"strand": "opposite"}, f"{_OVERLAP} AND f.strand <> v.strand AND f.strand <> '.' AND v.strand <> '.'"),
    "join03_inside": ({"mode": "inside"}, "f.b <= v.b AND f.e >= v.e"),
    "join04_percent": ({"percent": 0.5}, f"{_OVERLAP} AND {_SHARED} / CASE WHEN least(abs(f.e - f.b), abs(v.e - v.b)) = 0 THEN 1 ELSE least(abs(f.e - f.b), abs(v.e - v.b)) END >= 0.5"),
    "join05_same_location": ({"mode": "same", "slop": 3}, "abs(f.b - v.b) <= 3 AND abs(f.e - v.e) <= 3"),
    "join06_near": ({"mode": "near", "reach": 500}, f"(({_OVERLAP}) OR least(abs(f.b - v.e), abs(v.b - f.e)) < 500)"),
}
for _name, (_options, _on) in _JOINS.items():
    query(_name, _join_sql(_on))(lambda spark, sf, o=_options: _sums(iv.overlap_pairs(features(spark, sf), evidence(spark, sf), **o)))


_SPANS = """clipped AS (SELECT f.fid, greatest(f.b, v.b) AS b, least(f.e, v.e) AS e, v.id FROM features f JOIN evidence v ON f.ref = v.ref AND f.b <= v.e AND f.e >= v.b),
marked AS (SELECT *, CASE WHEN max(e) OVER w IS NULL OR b > max(e) OVER w + 1 THEN 1 ELSE 0 END AS new FROM (SELECT DISTINCT fid, b, e FROM clipped)
  WINDOW w AS (PARTITION BY fid ORDER BY b, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY fid ORDER BY b, e ROWS UNBOUNDED PRECEDING) AS island FROM marked),
spans AS (SELECT fid, island, min(b) AS b, max(e) AS e FROM numbered GROUP BY fid, island)"""


def _with_spans() -> str:
    return ctes("features", "evidence").rstrip() + ",\n" + _SPANS + "\n"


def _pairs(spark, sf):
    return iv.overlap_pairs(features(spark, sf), evidence(spark, sf))


@query("overlap_base_per_feature", _with_spans() + """SELECT c.fid, c.best, s.bases FROM (SELECT fid, max(e - b + 1) AS best FROM clipped GROUP BY fid) c
JOIN (SELECT fid, CAST(sum(e - b + 1) AS BIGINT) AS bases FROM spans GROUP BY fid) s USING (fid)""")
def overlap_base_per_feature(spark, sf):
    """AGG-02: largest single overlap and union of overlaps of each feature."""
    feats, ev = features(spark, sf), evidence(spark, sf)
    best = iv.overlap_pairs(feats, ev).groupBy("p_fid").agg(F.max("overlap").alias("best"))
    # the union is summed over disjoint evidence, so pairs are neither kept nor sorted
    bases = iv.overlap_pairs(feats, iv.covered(ev)).groupBy("p_fid").agg(F.sum("overlap").alias("bases"))
    return best.join(bases, "p_fid").select(F.col("p_fid").alias("fid"), "best", "bases")


@query("join08_difference", _with_spans() + """SELECT fid, row_number() OVER (PARTITION BY fid ORDER BY b) AS piece, count(*) OVER (PARTITION BY fid) AS pieces, b AS begin, e AS stop, e - b + 1 AS length FROM (
  SELECT fid, coalesce(lag(e) OVER (PARTITION BY fid ORDER BY b) + 1, fb) AS b, b - 1 AS e FROM (SELECT s.fid, s.b, s.e, f.b AS fb FROM spans s JOIN features f USING (fid))
  UNION ALL SELECT s.fid, max(s.e) + 1, any_value(f.e) FROM spans s JOIN features f USING (fid) GROUP BY s.fid
  UNION ALL SELECT fid, b, e FROM features WHERE fid NOT IN (SELECT fid FROM spans)) WHERE b <= e""")
def difference(spark, sf):
    """JOIN-08: pieces of features outside all evidence."""
    return iv.difference(features(spark, sf), evidence(spark, sf), "fid").select("fid", F.col("piece").cast("long"), "pieces", "begin", F.col("end").alias("stop"), "length")


@query("agg01_evidence_ids", _with_spans() + "SELECT fid, array_to_string(list_sort(list(DISTINCT CAST(id AS VARCHAR))), ',') AS ids, count(DISTINCT id) AS n FROM clipped GROUP BY fid")
def evidence_ids(spark, sf):
    """AGG-01: sorted distinct evidence ids of each feature."""
    # the set tells its size; a distinct count beside it would have each pair expanded and shuffled again
    sets = _pairs(spark, sf).groupBy(F.col("p_fid").alias("fid")).agg(F.collect_set(F.col("b_id").cast("string")).alias("ids"))
    return sets.select("fid", F.array_join(F.array_sort("ids"), ",").alias("ids"), F.size("ids").cast("long").alias("n"))


@query("agg10_merge", ctes("evidence") + """, marked AS (SELECT *, CASE WHEN max(e) OVER w IS NULL OR b > max(e) OVER w + 1 THEN 1 ELSE 0 END AS new FROM evidence
  WINDOW w AS (PARTITION BY ref ORDER BY b, e, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
numbered AS (SELECT *, sum(new) OVER (PARTITION BY ref ORDER BY b, e, id ROWS UNBOUNDED PRECEDING) AS island FROM marked)
SELECT ref, min(b) AS begin, max(e) AS stop, count(*) AS spans FROM numbered GROUP BY ref, island""")
def merge(spark, sf):
    """AGG-10: union of evidence spans."""
    return iv.merged(evidence(spark, sf), ["ref"], block=50_000).select("ref", "begin", F.col("end").alias("stop"), "spans")


@query("agg11_coverage", ctes("features") + """, points AS (SELECT ref, pos, sum(d) AS d FROM (SELECT ref, b AS pos, score AS d FROM features UNION ALL SELECT ref, e + 1, -score FROM features) GROUP BY ref, pos HAVING sum(d) <> 0)
SELECT ref, pos AS begin, nxt - 1 AS stop, CAST(v AS BIGINT) AS value FROM (SELECT ref, pos, lead(pos) OVER (PARTITION BY ref ORDER BY pos) AS nxt, sum(d) OVER (PARTITION BY ref ORDER BY pos) AS v FROM points) WHERE v <> 0 AND nxt IS NOT NULL""")
def coverage(spark, sf):
    """AGG-11 and SNK-04: step function of summed scores."""
    return iv.coverage(features(spark, sf), ["ref"], block=50_000).select("ref", "begin", F.col("end").alias("stop"), "value")


@query("agg19_base_accuracy", _with_spans() + """, found AS (SELECT coalesce(sum(e - b + 1), 0) AS hit FROM spans), predicted AS (SELECT sum(e - b + 1) AS bases, count(*) AS n FROM features),
touched AS (SELECT count(DISTINCT fid) AS n, count(DISTINCT id) AS ev FROM clipped), known AS (SELECT count(*) AS n FROM evidence)
SELECT p.n AS features, t.n AS with_evidence, round(f.hit / p.bases, 6) AS base_overlap, round(t.n / p.n, 6) AS specificity, round(t.ev / k.n, 6) AS sensitivity FROM found f, predicted p, touched t, known k""")
def base_accuracy(spark, sf):
    """AGG-19: share of feature bases with evidence, of features touched and of evidence found."""
    feats, ev = features(spark, sf), evidence(spark, sf)
    # each side meets the other's disjoint spans: what is touched and how much of it, without all pairs of the two
    found = iv.overlap_pairs(feats, iv.covered(ev)).groupBy("p_fid").agg(F.sum("overlap").alias("bases")).agg(F.struct(F.coalesce(F.sum("bases"), F.lit(0)).alias("hit"), F.count("*").alias("with_evidence")).alias("found"))
    touched = iv.overlap_pairs(ev, iv.covered(feats)).groupBy("p_id").count().agg(F.count("p_id").alias("ev"))
    whole = feats.agg(F.count("*").alias("features"), F.sum(F.col("end") - F.col("begin") + 1).alias("bases"))
    rows = whole.withColumn("found", found.scalar()).select("*", "found.*", touched.scalar().alias("ev"), ev.agg(F.count("*")).scalar().alias("known"))
    share = lambda a, b, to: F.round(F.col(a) / F.col(b), 6).alias(to)
    return rows.select("features", "with_evidence", share("hit", "bases", "base_overlap"), share("with_evidence", "features", "specificity"), share("ev", "known", "sensitivity"))


@query("agg33_window_density", ctes("features") + """SELECT ref, w AS win, type, count(*) AS features, CAST(sum(least(e, w * 1000 + 999) - greatest(b, w * 1000) + 1) AS BIGINT) AS bases, CAST(sum(score) AS BIGINT) AS score
FROM (SELECT *, unnest(range(b // 1000, e // 1000 + 1)) AS w FROM features) GROUP BY ref, w, type""")
def window_density(spark, sf):
    """AGG-33: features, bases and score per fixed window and type."""
    return iv.window_density(features(spark, sf), 1000).withColumnRenamed("window", "win")


@query("join07_splice_ends", ctes("exons") + """, introns AS (SELECT ref, strand, gid * 100 + exon_no AS id, e + 1 AS b, nb - 1 AS e FROM (SELECT *, lead(b) OVER (PARTITION BY gid ORDER BY exon_no) AS nb FROM exons) WHERE nb > e + 1),
ends AS (SELECT gid * 100 + exon_no AS xid, ref, strand, 'L' AS side, b - 1 AS pos FROM exons UNION ALL SELECT gid * 100 + exon_no, ref, strand, 'R', e + 1 FROM exons),
sites AS (SELECT ref, strand, id, 'L' AS side, e AS pos FROM introns UNION ALL SELECT ref, strand, id, 'R', b FROM introns)
SELECT xid, count(*) FILTER (WHERE n.strand = s.strand) AS good, count(*) FILTER (WHERE n.strand <> s.strand) AS bad, array_to_string(list_sort(list(DISTINCT CAST(id AS VARCHAR))), ',') AS ids
FROM ends n JOIN sites s ON n.ref = s.ref AND n.side = s.side AND n.pos = s.pos GROUP BY xid""")
def splice_ends(spark, sf):
    """JOIN-07: exons whose ends abut an intron, with signed counts."""
    from .gene_queries import introns

    xs = exons(spark, sf)
    return iv.splice_matches(xs.withColumn("xid", F.col("gid") * 100 + F.col("exon_no")), introns(xs), "xid")


@query("join17_lift", ctes("features", parts="""SELECT 'c' || r AS ref, k * 5000 + 1 AS cb, k * 5000 + 5000 AS ce, 's' || (r * 1000 + k) AS scaffold, 100 AS sb, 5099 AS se, CASE WHEN k % 2 = 0 THEN '+' ELSE '-' END AS orient
FROM (SELECT unnest(range(50)) AS r), (SELECT unnest(range(40)) AS k)""") + """SELECT fid, scaffold, CASE WHEN orient = '-' THEN se - (f.e - cb) ELSE sb + f.b - cb END AS begin, CASE WHEN orient = '-' THEN se - (f.b - cb) ELSE sb + f.e - cb END AS stop,
CASE WHEN orient = '-' THEN translate(strand, '+-', '-+') ELSE strand END AS strand FROM features f JOIN parts p ON f.ref = p.ref AND f.b >= cb AND f.e <= ce""")
def lift(spark, sf):
    """JOIN-17: features moved by an assembly map; parts at even places forward, the rest reversed."""
    parts = spark.range(2000).select((F.col("id") % 50).alias("r"), F.floor(F.col("id") / 50).alias("k"))
    parts = parts.select(
        F.concat(F.lit("c"), F.col("r").cast("string")).alias("ref"), (F.col("k") * 5000 + 1).alias("c_begin"), (F.col("k") * 5000 + 5000).alias("c_end"),
        F.concat(F.lit("s"), (F.col("r") * 1000 + F.col("k")).cast("string")).alias("scaffold"), F.lit(100).alias("s_begin"), F.lit(5099).alias("s_end"),
        F.when(F.col("k") % 2 == 0, "+").otherwise("-").alias("orient"),
    )
    rows = iv.lifted(features(spark, sf).withColumnRenamed("fid", "id"), parts)
    return rows.select(F.col("p_id").alias("fid"), F.col("b_scaffold").alias("scaffold"), "begin", F.col("end").alias("stop"), "strand")


@query("flt02_keep_drop_mark", ctes("features", "evidence") + """SELECT type, count(*) FILTER (WHERE n > 0) AS kept, count(*) FILTER (WHERE n = 0) AS dropped, CAST(sum(n) AS BIGINT) AS marks FROM (
SELECT f.fid, f.type, count(v.id) AS n FROM features f LEFT JOIN evidence v ON f.ref = v.ref AND f.b <= v.e AND f.e >= v.b AND f.type = 'O' GROUP BY f.fid, f.type) GROUP BY type""")
def keep_drop_mark(spark, sf):
    """FLT-01 and FLT-02: only type O is tried against evidence; keep and drop are semi and anti joins, mark a left join."""
    feats = features(spark, sf)
    marks = iv.overlap_pairs(feats.where(F.col("type").rlike("^O$")), evidence(spark, sf)).groupBy(F.col("p_fid").alias("fid")).agg(F.count("*").alias("n"))
    rows = feats.join(marks, "fid", "left")
    return rows.groupBy("type").agg(F.count("n").alias("kept"), F.count_if(F.col("n").isNull()).alias("dropped"), F.sum(F.coalesce("n", F.lit(0))).alias("marks"))


@query("flt07_locus_list", ctes("features") + """SELECT fid FROM features f WHERE EXISTS (SELECT 1 FROM orders o WHERE o_orderkey % 97 = 0 AND f.ref = concat('c', o_custkey % 50) AND f.b <= o_orderkey + 1 + 10000 AND f.e >= o_orderkey + 1 - 10000)""")
def locus_list(spark, sf):
    """FLT-07: features within 10 kb of a listed locus."""
    loci = iv.merged(
        evidence(spark, sf).where("id % 97 = 0").select("ref", (F.col("begin") - 10000).alias("begin"), (F.col("begin") + 10000).alias("end")), ["ref"]
    )
    feats = features(spark, sf).select("fid", "ref", "begin", "end")
    return iv.overlap_pairs(feats, loci, size=10_000).select(F.col("p_fid").alias("fid")).distinct()


@query("snk07_partitions", ctes("features") + """SELECT ref, seg, count(*) AS rows, CAST(sum(b - seg * 4000) AS BIGINT) AS offsets, CAST(sum(CASE WHEN home THEN 1 ELSE 0 END) AS BIGINT) AS own FROM (
SELECT *, seg = b // 5000 AS home FROM (SELECT *, unnest(range((b - 1000) // 5000, e // 5000 + 1)) AS seg FROM features) WHERE seg >= 0) GROUP BY ref, seg""")
def partitions(spark, sf):
    """SNK-07: genome segments of 5,000 with 1,000 bases of overlap; a feature belongs to one and is seen by all it touches."""
    rows = features(spark, sf).withColumn("seg", F.explode(F.sequence(F.floor((F.col("begin") - 1000) / 5000), F.floor(F.col("end") / 5000)))).where("seg >= 0")
    home = F.col("seg") == F.floor(F.col("begin") / 5000)
    return rows.groupBy("ref", "seg").agg(F.count("*").alias("rows"), F.sum(F.col("begin") - F.col("seg") * 4000).alias("offsets"), F.count_if(home).alias("own"))
