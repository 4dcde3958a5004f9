"""Alternative isoforms and gene models from hits against plain walks; running totals dealt by block."""

import random
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from loomspan.operators import alternates, intervals, models
from loomspan.plans.adapters import genome_hits

EXON = "gid long, exon_no long, ref string, strand string, begin long, end long, kind string"


def alternates_walk(exons, sites, mains, pairs, least_chain=0.30):
    """The rule as a walk over a main's alternates, accepted chains in a list. pairs: main -> alternates that fit."""
    of, by_site = defaultdict(list), {(g, k): (ids, score) for g, k, ids, score in sites}
    for g, k, _, _, b, e, _ in exons:
        if (g, k) in by_site:
            of[g].append((b, e, *by_site[g, k]))
    chain, ends = {}, defaultdict(Counter)
    for g, xs in of.items():
        xs.sort(key=lambda x: x[:2])
        chain[g] = [(b, e, ids) for b, e, ids, _ in xs]
        for b, e, ids, score in xs:
            ends[tuple(ids)][b] += score
            ends[tuple(ids)][e] += score

    def flat(c):
        return [(i, k + 1 < len(ids), n + 1 < len(c)) for n, (_, _, ids) in enumerate(c) for k, i in enumerate(ids)]

    def part(a, b):
        """Introns of a in b one after another, with the same borders of exons between them."""
        x, y = flat(a), flat(b)
        border = [t[1] for t in x[:-1]]
        return any([t[0] for t in y[i : i + len(x)]] == [t[0] for t in x] and [t[1] for t in y[i : i + len(x) - 1]] == border for i in range(len(y) - len(x) + 1))

    out = []
    for main, alts in pairs.items():
        if main not in chain:
            continue
        text = {a: "; ".join(",".join(x[2]) for x in chain[a]) for a in [main, *alts] if a in chain}
        n_main = len(chain[main]) - 1
        least, own = int(least_chain * n_main) or 1, {i for x in chain[main] for i in x[2]}
        accepted, number = [], 1
        for place, g in enumerate([main, *sorted((a for a in alts if a in chain), key=lambda a: (-len(text[a]), a))], 1):
            n, ids = len(chain[g]) - 1, {i for x in chain[g] for i in x[2]}
            verdict = "okay"
            if any(text[a] == text[g] for a in accepted):
                verdict = "dropdup"
            elif n < least:
                verdict = "dropshort"
            elif any(part(chain[g], chain[a]) for a in accepted):
                verdict = "dropsubchain"
            if verdict in ("dropshort", "okay") and n > 0 and g != main and not ids & own:
                verdict = "oknewlocus"
            if verdict == "dropsubchain":
                for b, e, key in (chain[g][0], chain[g][-1]):
                    at = ends[tuple(key)]
                    low, high = sorted(sorted(at, key=lambda x: (-at[x], x))[:2]) if len(at) > 1 else (b, e)
                    if (b < low and b == min(at)) or (e > high and e == max(at)):
                        verdict = "okaltend"
            ok = verdict.startswith("ok")
            if ok:
                accepted.append(g)
            number += ok and g != main
            out.append((main, g, place, n, verdict, (1 if g == main else number) if ok else None))
    return sorted(out)


def test_alternates_against_a_walk(spark):
    draw, exons = random.Random(5), []
    for locus in range(90):
        slots = draw.choice([2, 3, 8, 12])
        for t in range(draw.randrange(2, 14)):
            gid, k, shift = locus * 100 + t, 0, 3 if t > 10 else 0  # shifted ones share no intron
            for slot in range(draw.randrange(2) if t else 0, slots - (draw.randrange(2) if t else 0)):
                if draw.random() < 0.06:
                    continue
                k, at = k + 1, locus * 20_000 + slot * 1000 + shift
                exons.append((gid, k, "c1", "+", at + (40 if draw.random() < 0.93 else 1), at + draw.choice([240] * 14 + [290, 290, 330]), "CDS" if draw.random() < 0.95 else "exon"))
    df = spark.createDataFrame(exons, EXON).withColumn("score", F.lit(7)).withColumn("chain", F.lit("clash"))
    sites = alternates.splice_sites(df, alternates.shared_introns(df))
    mains = spark.createDataFrame([(locus * 100,) for locus in range(90)], "gid long")
    got = sorted(tuple(r) for r in alternates.pick(df, sites, mains).select("main", "gid", "place", "n", "verdict", "number").collect())

    span = lambda xs: sum(e - b + 1 for b, e in xs)
    rows, code, pairs = defaultdict(list), defaultdict(list), defaultdict(list)
    for g, _, _, _, b, e, kind in exons:
        rows[g].append((b, e))
        if kind == "CDS":
            code[g].append((b, e))
    shared = lambda xs, ys: sum(max(0, min(e, d) - max(b, c) + 1) for b, e in xs for c, d in ys)
    round_ = lambda x: int(x + 0.5)
    for g in rows:
        main = g // 100 * 100
        if g == main or main not in rows:
            continue
        if round_(100 * shared(code[g], code[main]) / max(1, span(code[g]), span(code[main]))) >= 66 and round_(100 * shared(rows[g], rows[main]) / max(span(rows[g]), span(rows[main]))) >= 40:
            pcds, main_pcds = (round_(100 * span(code[x]) / span(rows[x])) for x in (g, main))
            pairs[main] += [g] if pcds >= 40 and pcds >= 0.55 * main_pcds else []
    want = alternates_walk(exons, [tuple(r) for r in sites.collect()], None, pairs)
    assert got == want
    assert {r[4] for r in got} == {"okay", "okaltend", "oknewlocus", "dropdup", "dropshort", "dropsubchain"}


def test_alternates_of_nothing(spark):
    none = spark.createDataFrame([], EXON)
    sites = alternates.splice_sites(none, alternates.shared_introns(none))
    assert alternates.pick(none, sites, spark.createDataFrame([], "gid long")).collect() == []
    one = spark.createDataFrame([(1, 1, "c", "+", 1, 90, "CDS"), (2, 1, "c", "+", 1, 90, "CDS")], EXON)  # no introns, no chains
    sites = alternates.splice_sites(one, alternates.shared_introns(one))
    assert alternates.pick(one, sites, spark.createDataFrame([(1,)], "gid long")).collect() == []


def overlap(b, e, c, d, most):
    if not (b < d and e > c):
        return False
    return (b >= c and e <= d) or min(d - b, e - c) / max(d - c + 1, e - b + 1) > most


def near(b, e, c, d, gap):
    if not (b < d - 5 and e > c + 5):
        if b >= d:
            return b - d < gap
        return c >= e and c - e < gap
    return False


def stitched_walk(hits, longest=200_000, low=0.33, most_genes=49):
    """hits of one query: dicts. The walk over all scaffolds at once; gene of each used hit."""
    done, saved, gene_of, gene, most = set(), [], {}, 0, None
    key = lambda h: (h["ref"], h["strand"], h["qb"], h["tb"], h["te"], h["bits"])
    taken = lambda h: any(s["ref"] == h["ref"] and overlap(h["tb"], h["te"], s["tb"], s["te"], 0.05) for s in saved)
    by_place = sorted(hits, key=lambda h: (h["tb"], -h["te"], h["row_no"]))
    for seed in sorted(hits, key=lambda h: (-h["bits"], h["row_no"])):
        most = seed["bits"] if most is None else most
        if key(seed) in done:
            continue
        done.add(key(seed))
        if seed["bits"] < low * most and taken(seed):
            continue
        gene += 1
        if gene > most_genes:
            break
        reach = [h for h in by_place if h["ref"] == seed["ref"] and h["strand"] == seed["strand"] and h["tb"] > seed["tb"] - longest and h["te"] < seed["te"] + longest]
        before = [h for h in reach if h["te"] <= seed["tb"] + 5]
        after = [h for h in reach if h["te"] > seed["tb"] + 5 and h["tb"] >= seed["te"] - 5]
        q0, q1, t0, t1, members = seed["qb"], seed["qe"], seed["tb"], seed["te"], [seed]
        for h, ahead in [(h, False) for h in after] + [(h, True) for h in before[::-1]]:
            if key(h) == key(seed):
                continue
            used = key(h) in done or (seed is not h and any(s["ref"] == h["ref"] and overlap(h["tb"], h["te"], s["tb"], s["te"], 0.05) for s in saved))
            if overlap(h["qb"], h["qe"], q0, q1, 0.15) or (used and not near(h["tb"], h["te"], t0, t1, 5000)):
                continue
            if ahead == (seed["strand"] == "-"):
                if h["qb"] + 5 < q1:
                    continue
                q1 = max(q1, h["qe"])
            else:
                if h["qe"] - 5 > q0:
                    continue
                q0 = min(q0, h["qb"])
            if not used:
                members.append(h)
                if ahead:
                    t0 = h["tb"]
                else:
                    t1 = h["te"]
        done |= {key(h) for h in members}
        saved += members
        gene_of |= {h["row_no"]: gene for h in members}
    return gene_of


def test_models_from_hits_against_a_walk(spark, small):
    df = genome_hits(spark, small)
    more = spark.createDataFrame([(5000, "c1", "+", 1, 50, 10 * i + 1, 10 * i + 60, 50, 50, 100 - i, i) for i in range(70)] + [(5001, "c1", "-", 1, 50, 11, 60, 50, 50, 9, i) for i in range(3)], df.schema)
    df = df.withColumn("q", F.col("q") % 60).union(more).withColumn("seed", F.lit("clash")).withColumn("island", F.lit(0))
    rows = [r.asDict() for r in df.drop("seed", "island").collect()]
    by = defaultdict(list)
    for r in rows:
        by[r["q"]].append(r)
    want = {(q, n): g for q, hits in by.items() for n, g in stitched_walk(hits).items()}
    parts = models.stitch(df.drop("seed", "island"))
    got = {(r["q"], r["row_no"]): r["gene"] for r in parts.collect()}
    assert got == want and max(got.values()) == 49
    genes = models.gene_models(parts).collect()
    members = defaultdict(list)
    for r in rows:
        if (r["q"], r["row_no"]) in want:
            members[r["q"], want[r["q"], r["row_no"]]].append(r)
    kept, best = set(), defaultdict(int)
    for (q, g), hits in sorted(members.items()):
        bits = sum(h["bits"] for h in hits)
        best[q] = max(best[q], bits)
        if bits >= 0.33 * best[q] and bits >= 1:
            kept.add((q, g, min(h["tb"] for h in hits), max(h["te"] for h in hits), len(hits), bits, sum(h["aln"] for h in hits), 100 * sum(h["ident"] for h in hits) // sum(h["aln"] for h in hits)))
    assert {(r["q"], r["gene"], r["begin"], r["end"], r["hits"], r["bits"], r["align"], r["pident"]) for r in genes} == kept
    assert any(len(h) > 2 for h in members.values())
    assert models.gene_models(models.stitch(df.drop("seed", "island").limit(0))).collect() == []


def test_islands_dealt_by_block(spark):
    draw = random.Random(8)
    rows = [(f"k{draw.randrange(2)}" if draw.random() < 0.9 else None, b := draw.randrange(-50, 4000), b + draw.randrange(0, 60)) for _ in range(300)] + [("k0", 10, 2500)] * 2
    df = spark.createDataFrame(rows, "ref string, begin long, end long").withColumn("_block_", F.lit(1))
    for gap in (0, 7):
        plain = Counter(tuple(r) for r in intervals.islands(df, ["ref"], gap=gap).select("ref", "begin", "end", "island").collect())
        assert Counter(tuple(r) for r in intervals.islands(df, ["ref"], gap=gap, block=100).select("ref", "begin", "end", "island").collect()) == plain


def test_a_crowded_stretch_stops_at_the_limit_of_genes(spark):
    """Thousands of hits of one query in one stretch: the walk ends with the last gene that counts, and its genes are the first ones."""
    draw = random.Random(11)
    rows = [(1, "c1", draw.choice("+-"), q := draw.randrange(1, 460), q + draw.randrange(5, 50), t := draw.randrange(1, 900_000), t + draw.randrange(20, 150), 10, 9, draw.randrange(40, 100), n) for n in range(6000)]
    df = spark.createDataFrame(rows, "q long, ref string, strand string, qb long, qe long, tb long, te long, aln long, ident long, bits long, row_no long")
    frame = df.toPandas().assign(island=1, most_bits=100)
    few, more = (models._stitched(200_000, 0.33, 0.15, 0.05, 5_000, k)(frame) for k in (7, 60))
    assert few["seed"].nunique() == 7
    assert few["row_no"].tolist() == more["row_no"].tolist()[: len(few)]
    got = models.stitch(df, most_genes=7)
    assert sorted(got.columns) == sorted([*df.columns, "gene"])
    assert sorted(r.row_no for r in got.collect()) == sorted(few["row_no"])
