"""Queries over whole gene models: alternative isoforms, models from hits, joins and splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from loomspan.operators import alternates, genes, models, repair, selection, splits, strands
from loomspan.operators.intervals import overlap_pairs
from loomspan.session import stored

from .adapters import ctes, evidence, genome_hits, scaffold_genes, sequences, stranded_introns, transcripts
from .registry import query

_ALTERNATES = ctes(
    "transcripts",
    gaps="SELECT gid, ref, strand, e + 1 AS ib, lead(b) OVER (PARTITION BY gid ORDER BY b, e) - 1 AS ie FROM transcripts",
    places="SELECT ref, strand, ib, ie, count(*) AS support, ib || '_' || ie AS intron FROM gaps WHERE ie >= ib GROUP BY ALL",
    keyed="""SELECT x.gid, x.exon_no, x.b, x.e, sum(p.support) AS score, list_sort(list(DISTINCT p.intron)) AS ids
      FROM transcripts x JOIN places p ON x.ref = p.ref AND x.strand = p.strand AND (x.b - 1 = p.ie OR x.e + 1 = p.ib) GROUP BY ALL""",
    named="SELECT *, '<' || array_to_string(ids, '>,<') || '>' AS key FROM keyed",
    held="""SELECT gid, string_agg(key, ';' ORDER BY b, e) AS chain, length(string_agg(array_to_string(ids, ','), '; ' ORDER BY b, e)) AS len, count(*) - 1 AS n, flatten(list(ids)) AS ids,
      arg_min(key, (b, e)) AS fk, min(b) AS fb, arg_min(e, (b, e)) AS fe, arg_max(key, (b, e)) AS lk, arg_max(b, (b, e)) AS lb, arg_max(e, (b, e)) AS le FROM named GROUP BY gid""",
    genes="SELECT gid, sum(e - b + 1) AS ex, coalesce(sum(e - b + 1) FILTER (WHERE kind = 'CDS'), 0) AS cd, floor(0.5 + 100 * coalesce(sum(e - b + 1) FILTER (WHERE kind = 'CDS'), 0) / sum(e - b + 1)) AS pcds FROM transcripts GROUP BY gid",
    shared="""SELECT m.gid AS main, a.gid, sum(least(a.e, m.e) - greatest(a.b, m.b) + 1) AS ex, sum(CASE WHEN a.kind = 'CDS' AND m.kind = 'CDS' THEN least(a.e, m.e) - greatest(a.b, m.b) + 1 ELSE 0 END) AS cd
      FROM transcripts a JOIN transcripts m ON a.ref = m.ref AND a.strand = m.strand AND a.b <= m.e AND a.e >= m.b WHERE m.gid % 5 = 0 AND a.gid % 5 <> 0 GROUP BY ALL""",
    pairs="""SELECT s.main, s.gid, p.pcds, q.pcds AS mpcds FROM shared s JOIN genes p ON p.gid = s.gid JOIN genes q ON q.gid = s.main
      WHERE floor(100 * s.cd / greatest(1, p.cd, q.cd) + 0.5) >= 66 AND floor(100 * s.ex / greatest(1, p.ex, q.ex) + 0.5) >= 40""",
    members="SELECT main, gid, false AS is_main FROM pairs WHERE pcds >= 40 AND pcds >= 0.55 * mpcds UNION ALL SELECT DISTINCT main, main, true FROM pairs",
    ends="""SELECT key, min(spot) FILTER (WHERE place <= 2) AS low, max(spot) FILTER (WHERE place <= 2) AS high, min(spot) AS lm, max(spot) AS rm
      FROM (SELECT key, spot, row_number() OVER (PARTITION BY key ORDER BY s DESC, spot) AS place FROM (SELECT key, spot, sum(score) AS s FROM (SELECT key, b AS spot, score FROM named UNION ALL SELECT key, e, score FROM named) GROUP BY ALL)) GROUP BY key HAVING count(*) >= 2""",
    rows="""SELECT m.main, m.gid, m.is_main, h.chain, h.len, h.n, k.n AS mn, list_has_any(h.ids, k.ids) AS common,
      coalesce((h.fb < f.low AND h.fb = f.lm) OR (h.fe > f.high AND h.fe = f.rm), false) OR coalesce((h.lb < l.low AND h.lb = l.lm) OR (h.le > l.high AND h.le = l.rm), false) AS longer
      FROM members m JOIN held h ON h.gid = m.gid JOIN held k ON k.gid = m.main LEFT JOIN ends f ON f.key = h.fk LEFT JOIN ends l ON l.key = h.lk""",
    parts="SELECT DISTINCT a.main, a.chain FROM rows a JOIN rows b ON a.main = b.main AND a.chain <> b.chain AND contains(b.chain, a.chain)",
    judged="""SELECT r.*, CASE WHEN r.n < greatest(1, floor(0.3 * mn)) THEN CASE WHEN NOT is_main AND r.n > 0 AND NOT common THEN 'oknewlocus' ELSE 'dropshort' END
      WHEN p.chain IS NOT NULL AND NOT is_main THEN CASE WHEN longer THEN 'okaltend' ELSE 'dropsubchain' END WHEN NOT is_main AND r.n > 0 AND NOT common THEN 'oknewlocus' ELSE 'okay' END AS own
      FROM rows r LEFT JOIN parts p ON p.main = r.main AND p.chain = r.chain""",
    told="""SELECT *, CASE WHEN coalesce(bool_or(starts_with(own, 'ok')) OVER (PARTITION BY main, chain ORDER BY is_main DESC, len DESC, gid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) THEN 'dropdup' ELSE own END AS verdict FROM judged""",
) + """SELECT main, gid, CAST(row_number() OVER w AS INTEGER) AS place, CAST(n AS INTEGER) AS n, verdict,
    CAST(CASE WHEN starts_with(verdict, 'ok') THEN CASE WHEN is_main THEN 1 ELSE 1 + count(*) FILTER (WHERE starts_with(verdict, 'ok') AND NOT is_main) OVER w END END AS INTEGER) AS number
    FROM told WINDOW w AS (PARTITION BY main ORDER BY is_main DESC, len DESC, gid ROWS UNBOUNDED PRECEDING)"""  # fmt: skip


@query("sel08_alternates", _ALTERNATES)
def pick_alternates(spark, sf):
    """SEL-08: isoforms of every main gene, kept or dropped by their intron chains."""
    xs = stored(transcripts(spark, sf), "transcripts")
    sites = alternates.sited_exons(xs, stored(alternates.shared_introns(xs), "introns"))
    return alternates.pick(xs, sites, xs.where(F.col("gid") % 5 == 0).select("gid").distinct())


@query("job01_models_from_hits")
def models_from_hits(spark, sf):
    """JOB-01 and WIN-10: gene models stitched from the hits of every query."""
    return models.gene_models(models.stitch(genome_hits(spark, sf)))


@query("job02_repaired_genes")
def repaired_genes(spark, sf):
    """JOB-02 and SEQ-19: genes on scaffolds with their edges, gaps, ends and strands mended, and where their frames lie."""
    scaffolds = sequences(spark, sf).where("id is not null").select(F.col("id").alias("ref"), "seq")
    return repair.repair(scaffold_genes(spark, sf), scaffolds).withColumnRenamed("end", "stop")


_SPLITS = ctes(
    "transcripts",
    "evidence",
    gaps="SELECT gid, ref, strand, e + 1 AS ib, lead(b) OVER (PARTITION BY gid ORDER BY b, e) - 1 AS ie FROM transcripts",
    places="SELECT ref, strand, ib, ie, count(*) AS support, ib || '_' || ie AS intron FROM gaps WHERE ie >= ib GROUP BY ALL HAVING count(*) > 1",
    numbered="SELECT *, row_number() OVER (PARTITION BY gid ORDER BY b, e, exon_no) AS x, count(*) OVER (PARTITION BY gid) AS nx FROM transcripts",
    keyed="""SELECT x.gid, x.x, list(DISTINCT p.intron) AS ids, sum(CASE WHEN p.support % 7 = 6 THEN -p.support ELSE p.support END) AS value
      FROM numbered x JOIN places p ON x.ref = p.ref AND x.strand = p.strand AND (x.b - 1 = p.ie OR x.e + 1 = p.ib) GROUP BY ALL""",
    laid="""SELECT n.gid, n.x, n.nx, k.ids, k.value, coalesce(list_has_any(k.ids, lag(k.ids) OVER (PARTITION BY n.gid ORDER BY n.x)), false) AS joined
      FROM numbered n LEFT JOIN keyed k USING (gid, x)""",
    runs="SELECT gid, x, sum(CASE WHEN joined THEN 0 ELSE 1 END) OVER (PARTITION BY gid ORDER BY x) AS run FROM laid WHERE ids IS NOT NULL",
    links="""SELECT DISTINCT x.gid, x.x, 0 AS kind, CAST(v.id AS VARCHAR) AS id FROM numbered x JOIN evidence v ON x.ref = v.ref AND x.b <= v.e AND x.e >= v.b
      AND (x.strand = v.strand OR v.strand = '.') UNION ALL SELECT gid, x, 1, lpad(CAST(run AS VARCHAR), 6, '0') FROM runs""",
    held="SELECT *, count(*) OVER (PARTITION BY gid, kind, id) AS held FROM links",
    best="SELECT gid, x, kind, id FROM held QUALIFY row_number() OVER (PARTITION BY gid, x ORDER BY held DESC, kind, id) = 1",
    parts="SELECT gid, kind, id, list_sort(list(x)) AS xs, count(*) AS n FROM best GROUP BY gid, kind, id",
    ranked="SELECT *, row_number() OVER w AS rank, sum(n) OVER w - n AS before FROM parts WINDOW w AS (PARTITION BY gid ORDER BY n DESC, kind, id)",
    genes="SELECT gid, nx, count(*) FILTER (WHERE value > 0) AS good, count(*) FILTER (WHERE value < 0) AS bad, count(*) FILTER (WHERE joined) AS joins, list(x - 1) FILTER (WHERE NOT joined) AS loose FROM laid GROUP BY gid, nx",
    graded="""SELECT *, CASE WHEN good = 0 AND bad = 0 THEN 'none' WHEN bad > 0 THEN 'poor' WHEN nx > 2 AND good = nx AND joins + 1 = nx THEN 'complete'
      WHEN nx > 3 AND good >= nx - 2 AND (joins >= nx - 3 OR joins > 0.75 * nx) THEN CASE WHEN len(list_filter(loose, lambda k: k BETWEEN CASE WHEN joins > 8 THEN 3 ELSE 2 END AND nx - CASE WHEN joins > 8 THEN 3 ELSE 2 END)) > 0 THEN 'miss_inner' ELSE 'complete_inner' END
      WHEN good > 0 AND joins > 0 THEN CASE WHEN good / nx > 0.66 THEN 'good' ELSE 'ok' END ELSE 'poor' END AS quality FROM genes""",
    told="""SELECT g.gid, g.nx, g.quality, count(r.rank) AS chains, max(n) FILTER (WHERE rank = 1) AS n1, any_value(xs) FILTER (WHERE rank = 1) AS main, coalesce(sum(n) FILTER (WHERE rank > 1 AND before < g.nx), 0) AS more,
      coalesce(sum(n) FILTER (WHERE rank > 1 AND before < g.nx AND kind = 0), 0) AS more_evidence, min(xs[1]) AS lowest, max(xs[-1]) AS highest, string_agg(array_to_string(xs, ','), ';' ORDER BY rank) FILTER (WHERE rank > 1) AS others
      FROM graded g LEFT JOIN ranked r ON r.gid = g.gid GROUP BY g.gid, g.nx, g.quality""",
    seen="SELECT *, lowest > 1 OR highest < nx AS open_end, main[-1] - main[1] + 1 = n1 AS row FROM told",
    coded="""SELECT *, CASE WHEN chains = 0 THEN 'N0' WHEN n1 >= nx OR nx = 1 OR (nx > 5 AND n1 = nx - 1 AND open_end) THEN 'C1' WHEN nx < 3 OR n1 = 1 OR n1 < 0.2 * nx THEN 'EP3'
      WHEN chains > 1 AND nx > 3 AND (n1 + more) / nx < 0.75 THEN 'EP3' WHEN chains > 1 AND more < 2 AND n1 > 1 AND nx > 3 AND row THEN 'C1T1'
      WHEN chains > 1 AND more > 1 AND more_evidence <= 1 THEN 'IJ4' WHEN chains > 1 AND more > 1 AND contains(quality, 'complete') THEN 'EM4' WHEN chains > 1 AND more > 1 THEN 'J2'
      WHEN chains = 1 AND nx > 3 AND n1 = nx - 1 AND open_end THEN 'C1' WHEN chains = 1 AND nx > 3 AND n1 / nx < 0.75 THEN 'EP3'
      WHEN nx > 3 AND n1 > 0.74 * nx AND row THEN 'EM4' ELSE 'ER2' END AS code FROM seen""",
) + """SELECT gid, code, CASE code WHEN 'N0' THEN 0 WHEN 'C1' THEN 99 WHEN 'J2' THEN -99 WHEN 'C1T1' THEN 69 WHEN 'IJ4' THEN -9 WHEN 'ER2' THEN -2 WHEN 'EP3' THEN -1 ELSE 9 END AS score,
    nx, coalesce(array_to_string(main, ','), '') AS main, coalesce(others, '') AS others, quality FROM coded"""  # fmt: skip


@query("agg23_join_check", _SPLITS)
def join_check(spark, sf):
    """AGG-23: codes of joins and splits of all transcripts, from introns that two or more of them have and from evidence spans."""
    return _join_check(spark, sf, stored(transcripts(spark, sf), "transcripts"))


def _join_check(spark, sf, xs):
    places = alternates.shared_introns(xs).where("support > 1").withColumn("support", F.when(F.col("support") % 7 == 6, -F.col("support")).otherwise(F.col("support")))
    places = stored(places, "introns")
    found = overlap_pairs(xs.select("gid", "exon_no", "ref", "begin", "end", "strand"), evidence(spark, sf), strand="same")
    ids = found.select(F.col("p_gid").alias("gid"), F.col("p_exon_no").alias("exon_no"), F.col("b_id").cast("string").alias("id"))
    return splits.join_check(xs, ids, alternates.splice_sites(xs, places))


_STRANDS = ctes(
    "stranded_introns",
    tops="SELECT ref, (max(e) + 5000) // 100 AS top FROM stranded_introns GROUP BY ref",
    sides="SELECT ref, strand, score, greatest(1, b - 300) // 100 AS lo, greatest(1, b - 1) // 100 AS hi FROM stranded_introns UNION ALL SELECT ref, strand, score, (e + 1) // 100, (e + 300) // 100 FROM stranded_introns",
    summed="SELECT ref, bin, sum(CASE WHEN strand = '+' THEN score ELSE 0 END) AS fwd, sum(CASE WHEN strand = '-' THEN score ELSE 0 END) AS rev FROM (SELECT ref, strand, score, unnest(range(lo, hi + 1)) AS bin FROM sides) GROUP BY ref, bin",
    cut="SELECT *, CASE WHEN fwd >= 6 THEN fwd ELSE 0 END AS f, CASE WHEN rev >= 6 THEN rev ELSE 0 END AS r FROM summed",
    dense="SELECT t.ref, g.bin, t.top, coalesce(fwd, 0) AS fwd, coalesce(rev, 0) AS rev, CASE WHEN coalesce(f, 0) = 0 AND coalesce(r, 0) = 0 THEN NULL WHEN f = 0 THEN -1 WHEN r = 0 THEN 1 WHEN f < 0.05 * r THEN -1 WHEN r < 0.05 * f THEN 1 ELSE 2 END AS s FROM (SELECT ref, top, unnest(range(0, top + 1)) AS bin FROM tops) g JOIN tops t USING (ref) LEFT JOIN cut c ON c.ref = g.ref AND c.bin = g.bin",
    seen="""SELECT *, max(CASE WHEN s IS NOT NULL THEN bin END) OVER up AS pb, last_value(s IGNORE NULLS) OVER up AS ps, min(CASE WHEN s IS NOT NULL THEN bin END) OVER down AS nb, first_value(s IGNORE NULLS) OVER down AS ns FROM dense
      WINDOW up AS (PARTITION BY ref ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), down AS (PARTITION BY ref ORDER BY bin ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)""",
    turned="SELECT *, pb + 1 + (nb - pb - 1) // 100 * 100 AS t FROM seen",
    filled="""SELECT ref, bin, fwd, rev, CASE WHEN s IS NOT NULL THEN s WHEN pb IS NULL THEN CASE WHEN bin >= nb - 99 THEN ns ELSE 0 END WHEN nb IS NULL THEN ps
      WHEN bin >= CASE WHEN ps <> ns AND nb - t > 2 THEN (t + nb) // 2 ELSE t END THEN ns ELSE ps END AS strand FROM turned WHERE s IS NOT NULL OR pb IS NOT NULL OR nb IS NOT NULL""",
    marked="SELECT *, CASE WHEN strand IS NOT DISTINCT FROM lag(strand) OVER (PARTITION BY ref ORDER BY bin) THEN 0 ELSE 1 END AS new FROM filled",
    numbered="SELECT *, sum(new) OVER (PARTITION BY ref ORDER BY bin) AS segment FROM marked",
    runs="SELECT ref, segment, strand, min(bin) AS lo, max(bin) AS hi, sum(fwd) AS fwd, sum(rev) AS rev FROM numbered GROUP BY ref, segment, strand",
    ahead="""SELECT *, coalesce(min(CASE WHEN strand NOT IN (1, 2) THEN lo END) OVER w, max(hi) OVER (PARTITION BY ref) + 1) AS nf, coalesce(min(CASE WHEN strand NOT IN (-1, 2) THEN lo END) OVER w, max(hi) OVER (PARTITION BY ref) + 1) AS nr, lead(lo) OVER (PARTITION BY ref ORDER BY lo) AS following
      FROM runs WINDOW w AS (PARTITION BY ref ORDER BY lo ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)""",
) + """SELECT ref, CAST(segment AS BIGINT) AS segment, lo * 100 + 1 AS begin, (hi + 1) * 100 AS stop, CAST(fwd AS BIGINT) AS fwd, CAST(rev AS BIGINT) AS rev, CAST(strand AS INTEGER) AS strand,
    CASE WHEN following IS NULL THEN 0 WHEN strand = 0 THEN -1 WHEN CASE WHEN strand IN (1, 2) THEN nf ELSE nr END - hi - 1 < 50 THEN CASE WHEN strand IN (1, 2) THEN nf ELSE nr END - hi - 1 ELSE -1 END AS next FROM ahead"""  # fmt: skip


def _sizes(introns):
    return introns.groupBy("ref").agg((F.max("end") + 5000).alias("size"))


@query("win09_strand_segments", _STRANDS)
def strand_segments(spark, sf):
    """WIN-09: segments of one strand of every scaffold."""
    introns = stranded_introns(spark, sf)
    return strands.segments(introns, _sizes(introns)).withColumnRenamed("end", "stop")


@query("win09_partitions")
def strand_partitions(spark, sf):
    """WIN-09: the segments with the partitions of about 250,000 bases a strand that they fall to."""
    introns = stranded_introns(spark, sf)
    return strands.partitions(strands.segments(introns, _sizes(introns)), _sizes(introns)).withColumnRenamed("end", "stop")


@query("sel05_selected_models")
def selected_models(spark, sf):
    """SEL-04 to SEL-06: models that a drop rule lets through, suspected joins last, chosen by coding and transcript overlap, alternates marked."""
    xs = stored(transcripts(spark, sf), "transcripts")
    spans = genes.spans(xs)
    kept = genes.drop_rule([("cds_len", 300, ""), ("n_exons", 2, ""), ("exon_len", 100, "+")])
    checked = _join_check(spark, sf, xs).select("gid", (F.col("score") < 0).alias("last"))
    weighted = genes.weighted_sum({"cds_len": 1.0, "n_exons": 20.0, "score": 2.0})
    totals = spans.where(kept).select("gid", weighted.alias("total")).join(checked, "gid", "left")
    return selection.select_models(xs, totals, alternates=True)
