"""Small fixtures with results worked out by hand."""

import itertools
import random

from pyspark.sql import functions as F

from loomspan.functions import names, sequences, statistics
from loomspan.operators import classify, genes, graphs, hits, intervals, reads

SPAN = "ref string, begin long, end long, strand string, id string"


def spans(spark, *rows):
    return spark.createDataFrame([("c1", *r) for r in rows], SPAN)


def test_overlap_cases(spark):
    probe = spans(spark, (100, 199, "+", "p"))
    build = spans(spark, (150, 249, "+", "a"), (180, 189, "-", "b"), (200, 299, "+", "c"), (10, 99, "+", "d"), (120, 159, ".", "e"))

    def found(**o):
        return "".join(sorted(r["b_id"] for r in intervals.overlap_pairs(probe, build, **o).collect()))

    assert found() == "abe" and found(strand="same") == "ae" and found(strand="opposite") == "b" and found(mode="inside") == "be"
    assert found(percent=0.51) == "be" and found(percent=1.05) == "b" and found(mode="near", reach=5) == "abcde"
    assert [r["union_bases"] for r in intervals.union_bases(intervals.overlap_pairs(probe, build.where("id in ('a', 'b', 'e')")), ["p_id"]).collect()] == [80]
    cut = intervals.difference(probe, build.where("id in ('b', 'e')"), "id").orderBy("begin").collect()
    assert [(r["piece"], r["begin"], r["end"]) for r in cut] == [(1, 100, 119), (2, 160, 179), (3, 190, 199)]
    assert intervals.overlap_pairs(probe, spans(spark, (102, 197, "+", "x")), mode="same").count() == 1


def test_pairs_over_bin_edges_appear_once(spark):
    for p, b in (((995, 1005), (1000, 1001)), ((990, 2010), (900, 2100)), ((5, 5), (5, 5))):
        assert intervals.overlap_pairs(spans(spark, (*p, "+", "p")), spans(spark, (*b, "+", "b")), percent=1.0 if p == b else None).count() == 1


def test_hit_chain(spark):
    rows = spark.createDataFrame([(1, 1, 1, 100, 1, 100, 200, 90, 100, 1), (1, 1, 50, 150, 50, 150, 150, 90, 100, 2), (1, 1, 99, 200, 99, 200, 120, 90, 100, 3)],
                                 "q long, t long, qb long, qe long, tb long, te long, bits long, ident long, aln long, row_no long")
    got = hits.chain_sums(rows).first()
    assert (got["bits"], got["n_spans"]) == (320.0, 2)


def test_reciprocal_best_with_zero_evalue(spark):
    rows = spark.createDataFrame([(1, 2, 1, 2, 0.0), (2, 1, 2, 1, 1e-10), (3, 2, 1, 2, 1e-5)], "q long, t long, q_sp long, t_sp long, evalue double")
    assert [tuple(r) for r in hits.orthologs(rows).collect()] == [(1, 2, 163.0)]


def test_clusters_split_two_cliques(spark):
    edges = [(a, b, 1.0) for g in ((1, 2, 3), (11, 12, 13)) for a, b in itertools.combinations(g, 2)] + [(3, 11, 0.05)]
    got = {r["node"]: r["cluster"] for r in hits.clusters(spark.createDataFrame(edges, "a long, b long, w double"), inflation=2.0).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 11: 11, 12: 11, 13: 11}


def test_percent_match_on_the_shorter_sequence(spark):
    rows = [("a", "b", 100, 200, 1, 40, 1, 100), ("a", "b", 100, 200, 21, 60, 101, 200), ("c", "d", 200, 50, 1, 100, 1, 10), ("c", "d", 200, 50, 1, 100, 41, 50)]
    got = hits.percent_match(spark.createDataFrame(rows, "q string, t string, q_len long, t_len long, qb long, qe long, tb long, te long")).collect()
    assert sorted(tuple(r) for r in got) == [("a", "b", 60.0), ("c", "d", 40.0)]


def test_greedy_selection(spark):
    exons = spark.createDataFrame([(1, "c", 100, 300), (2, "c", 250, 500), (3, "c", 400, 600), (4, "c", 700, 800)], "gid long, ref string, begin long, end long")
    totals = spark.createDataFrame([(1, 90), (2, 80), (3, 70), (4, 10)], "gid long, total long")
    got = {r["gid"]: r["kept"] for r in genes.select_best(exons, totals, 0.1).collect()}
    assert got == {1: True, 2: False, 3: True, 4: True}


def _greedy_brute(exons, totals, most):
    kept, out = [], {}
    spans = {g: [(b, e) for x, _, b, e in exons if x == g] for g in totals}
    for gid in sorted(totals, key=lambda g: (-totals[g], min(b for b, _ in spans[g]), max(e for _, e in spans[g]), g)):
        size = sum(e - b + 1 for b, e in spans[gid])
        taken = sum(max(0, min(e, y) - max(b, x) + 1) for b, e in spans[gid] for x, y in kept)
        out[gid] = (totals[gid], taken, taken <= most * size)
        if out[gid][2]:
            kept += spans[gid]
    return out


def test_greedy_selection_against_a_walk(spark):
    draw = random.Random(5)
    exons, totals = [], {}
    for gid in range(150):
        at = draw.randrange(6000)
        for i in range(draw.randrange(1, 5)):
            exons.append((gid, "c", at + 150 * i, at + 150 * i + draw.randrange(20, 200)))
        totals[gid] = draw.randrange(25)
    rows = spark.createDataFrame(exons, "gid long, ref string, begin long, end long")
    scores = spark.createDataFrame(list(totals.items()), "gid long, total long")
    for most in (0.0, 0.1, 0.4):
        got = {r["gid"]: (r["total"], r["taken"], r["kept"]) for r in genes.select_best(rows, scores, most).collect()}
        assert got == _greedy_brute(exons, totals, most)
    assert genes.select_best(rows.limit(0), scores).count() == 0
    last = scores.withColumn("last", F.col("gid") == 0)
    assert {r["gid"] for r in genes.select_best(rows, last).collect()} == set(totals)


def test_drop_rule(spark):
    rows = spark.createDataFrame([(1, 70, 200, 0), (2, 70, 100, 0), (3, 70, 200, 80), (4, 10, 200, 0)], "id long, est long, cds long, te long")
    keep = genes.drop_rule([("est", 60, ""), ("cds", 180, "+"), ("te", 60, "-")])
    assert [r["id"] for r in rows.where(keep).collect()] == [1]


def test_fragments_keep_their_suffix_and_only_alternates_rise(spark):
    assert [classify.pair_class(*x) for x in ((95, 90, 900, 600), (95, 90, 900, 400), (85, 90, 900, 400), (99, 50, 900, 400))] == ["altmid", "altmidfrag", "altlofrag", "parthi"]
    rows = spark.createDataFrame([(95, 90, 900, 400), (85, 90, 900, 400), (85, 90, 900, 500), (70, 90, 900, 500)], "pid long, pal long, q long, t long")
    got = [r[0] for r in rows.select(classify.class_of_pair(*[F.col(c) for c in ("pid", "pal", "q", "t")])).collect()]
    assert got == ["altmidfrag", "altlofrag", "altlo", None]


def test_pair_classes(spark):
    rows = spark.createDataFrame([("x", 900, "y", 600, 594, 592), ("x", 900, "z", 400, 300, 299)], "q string, q_len long, t string, t_len long, aln long, ident long")
    got = classify.percents(rows).withColumn("c", classify.class_of_pair(F.col("pid"), F.col("pal"), F.col("q_len"), F.col("t_len"))).orderBy("t").collect()
    assert [(r["pid"], r["pal"], r["c"]) for r in got] == [(99, 99, "althi1"), (99, 75, "parthi")]
    for pid, pal, q, t in itertools.product((70, 85, 95, 99), (10, 50, 98, 100), (900,), (0, 100, 440, 800)):
        one = spark.range(1).select(classify.class_of_pair(*map(F.lit, (pid, pal, q, t)))).first()[0] if (pid, pal) in ((99, 98), (95, 50)) else classify.pair_class(pid, pal, q, t)
        assert one == classify.pair_class(pid, pal, q, t)


def test_representatives_move_by_the_rising_bar(spark):
    rows = [(1, 10, 50), (1, 11, 53), (1, 12, 55), (1, 13, 59), (1, 14, 60), (2, 20, 90), (2, 21, 94)]
    got = {r["key"]: (r["id"], r["pcds"]) for r in classify.reassigned(spark.createDataFrame(rows, "key long, id long, pcds long")).collect()}
    assert got == {1: (14, 60), 2: (20, 90)}


def test_identity_classes_chase_mains(spark):
    rows = [(1, 900, 2, 600, 590, 590), (2, 600, 3, 500, 495, 495), (4, 300, 4, 300, 300, 300)]
    pairs = spark.createDataFrame(rows, "q long, q_len long, t long, t_len long, aln long, ident long")
    got = {r["id"]: (r["class"], r["main"]) for r in classify.classes(pairs, graphs.components(pairs, "q", "t")).collect()}
    assert got == {1: ("main", 1), 2: ("althi1", 1), 3: ("althi1", 1), 4: ("noclass", 4)}


def test_components_and_chains(spark):
    n = 300
    edges = spark.createDataFrame([(i, i + 1) for i in range(n) if i % 50] + [(7, 7)], "a long, b long")
    got = {r["id"]: r["component"] for r in graphs.components(edges).collect()}
    assert len(got) == n and all(c == (i - 1) // 50 * 50 + 1 for i, c in got.items())
    links = spark.createDataFrame([(i, i - 1) for i in range(1, 40)], "id long, to long")
    assert {r["end"] for r in graphs.chain_ends(links).collect()} == {0}


def test_translation_and_frames(spark):
    rows = spark.createDataFrame([("ATGAAATAA",), ("ATGNNN",), ("ATGAT",), ("CTN",), ("aacgtn",)], "seq string")
    got = [r[0] for r in rows.select(sequences.translate(F.col("seq"))).collect()]
    assert got == ["MK*", "MX", "M", "L", "NV"]
    assert [r[0] for r in rows.where("seq = 'aacgtn'").select(sequences.reverse_complement(F.upper("seq"))).collect()] == ["NACGTT"]
    seq = "CCATG" + "GCT" * 40 + "TAAGG"
    got = sequences.best_frame(spark.createDataFrame([(1, seq)], "id long, seq string"), "id").first()
    assert (got["strand"], got["begin"], got["end"], got["complete"], got["aa"]) == ("+", 3, 128, "complete", 41)
    back = spark.range(1).select(sequences.translate(sequences.back_translate(F.lit("MKLV*")))).first()[0]
    assert back == "MKLV*"
    assert sequences.three_digits(1234.5) == "1.23e+3" and sequences.three_digits(0.5) == "0.5"


def test_medians_and_deviation(spark):
    rows = spark.createDataFrame([(float(x),) for x in (1, 2, 3, 4)], "x double")
    assert statistics.upper_median(rows, "x").first()[0] == 3 and statistics.lower_median(rows, "x").first()[0] == 2
    assert spark.createDataFrame([(5.0,), (5.5,), (6.0,)], "x double").agg(statistics.deviation("x")).first()[0] == 0


def test_intron_chain(spark):
    exons = spark.createDataFrame([(1, i, 100 * i, 100 * i + 50) for i in (1, 2, 3)], "gid long, exon_no long, begin long, end long")
    sites = spark.createDataFrame([(1, 1, "N1"), (1, 2, "N1"), (1, 2, "N2"), (1, 3, "N2")], "gid long, exon_no long, intron string")
    got = genes.intron_chain_quality(exons, sites).first()
    assert (got["supported"], got["joins"], got["chain"]) == (3, 2, "complete")


def test_reads(spark):
    rows = spark.createDataFrame([("r", "c1", 10, "3S5M4N2M1D3M", "+", "AAACCCCCGGTTT", 1, 16)], "id string, ref string, loc long, cigar string, strand string, seq string, nm long, flag int")
    assert [(r["begin"], r["end"]) for r in reads.blocks(rows).orderBy("begin").collect()] == [(10, 14), (19, 20), (22, 24)]
    assert [(r["begin"], r["end"], r["reads"]) for r in reads.introns(rows).collect()] == [(15, 18, 1)]
    got = reads.clipped(rows).first()
    assert (got["seq"], got["cigar"]) == ("CCCCCGGTTT", "5M4N2M1D3M")
    got = reads.statistics(rows).first()
    assert (got["reads"], got["reverse"], got["spliced"], got["clipped"], got["paired"]) == (1, 1, 1, 1, 0)
    assert reads.identity_reached(rows, 69).count() == 1 and reads.identity_reached(rows, 70).count() == 0


def test_names(spark):
    rows = spark.createDataFrame([("PREDICTED: haemoglobin subunit, isoform 2", 90), ("hypothetical protein", 90), ("kinase", 50), ("kinase", 10), ("Gag-Pol polyprotein", 80)], "n string, p long")
    got = [r[0] for r in rows.select(names.graded(F.col("n"), F.col("p"))).collect()]
    assert got == ["hemoglobin subunit", names.UNKNOWN, "kinase-like protein", names.UNKNOWN, "TE: Gag-Pol polyprotein"]
    assert spark.range(1).select(names.short_list(F.array(*[F.lit(str(i)) for i in range(23)]))).first()[0].endswith("19,..3")


def test_clusters_read_their_edges_once(spark):
    """Edges with a long plan are stored first; components over the limit of a matrix give the same clusters by joins."""
    ran = spark.sparkContext.accumulator(0)

    def tick(rows):
        ran.add(1)
        yield from rows

    rows = [(a, b, w) for base in (0, 50) for a, b, w in [(base, base + 1, 9.0), (base + 1, base + 2, 8.0), (base, base + 2, 9.0), (base + 2, base + 3, 1.0), (base + 3, base + 4, 9.0), (base + 4, base + 5, 9.0), (base + 3, base + 5, 8.0)]]
    edges = spark.createDataFrame(spark.sparkContext.parallelize(rows, 1).mapPartitions(tick), "a long, b long, w double")
    got = {most: sorted(map(tuple, hits.clusters(edges, inflation=2.0, most=most).collect())) for most in (1000, 3)}
    assert got[1000] == got[3] == [(base + n, base + n // 3 * 3) for base in (0, 50) for n in range(6)]
    assert ran.value <= 4  # a checkpoint runs its plan twice


def test_evidence_ids_in_one_aggregate(spark, small):
    from loomspan.plans.catalog import QUERIES

    plan = QUERIES["agg01_evidence_ids"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and plan.count("Aggregate") == 1


def test_bases_covered_are_summed_over_disjoint_evidence(spark, small):
    from loomspan.plans.catalog import QUERIES

    plan = lambda name: QUERIES[name](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan("overlap_base_per_feature").splitlines() if "Window" in line and "p_fid" in line]
    assert not [line for line in plan("join08_difference").splitlines() if "Aggregate" in line and "fid" in line]
    assert "Expand" not in plan("agg19_base_accuracy")


def test_difference_with_deep_and_touching_builds(spark):
    from loomspan.operators import intervals

    probe = spark.createDataFrame([(1, "a", 10, 50), (2, "a", 2000, 5000), (3, "b", 1, 9), (4, "a", 12, 14)], "fid long, ref string, begin long, end long")
    build = spark.createDataFrame([("a", 12, 14)] * 50 + [("a", 15, 20), ("a", 30, 29), ("a", 2500, 2600), ("a", 2600, 4100), ("a", 48, 99)], "ref string, begin long, end long")
    rows = intervals.difference(probe, build, "fid").select("fid", "piece", "pieces", "begin", "end", "length").collect()
    assert sorted(map(tuple, rows)) == [(1, 1, 2, 10, 11, 2), (1, 2, 2, 21, 47, 27), (2, 1, 2, 2000, 2499, 500), (2, 2, 2, 4101, 5000, 900), (3, 1, 1, 1, 9, 9)]
