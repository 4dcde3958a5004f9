"""Identity classes of aligned sequences, decided in rounds of joins over all pairs; corrections by references, clusters and maps.

Pairs have an order (longer queries, longer alignments and shorter targets first, then ids, then more identity). The shorter sequence of a pair is an
alternate of the longer by the first pair that gives it a class, unless the longer role has made it a main before. So each
sequence has one pair that counts, and its verdict hangs on the verdicts of those whose pair names it and comes earlier: a
sequence is a main if one of them is an alternate. Rounds decide all sequences whose earlier ones are decided; their number is
the longest chain of mains of mains, whatever the size of a component.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspan.session import cut

from . import graphs
from .classify import class_of_pair, percents


def _candidates(pairs: DataFrame) -> DataFrame:
    """Pairs with a class: id (the shorter; of equal ones t), parent, place in the order, kind, pid, pal and same (equal sizes)."""
    rows = percents(pairs).where("q <> t").withColumn("place", F.struct((-F.col("q_len")).alias("a"), (-F.col("aln")).alias("b"), F.col("t_len").alias("c"), F.col("q").alias("d"), F.col("t").alias("e"), (-F.col("ident")).alias("f")))
    turned = F.col("t_len") > F.col("q_len")
    long_, short = F.greatest("q_len", "t_len"), F.least("q_len", "t_len")
    kind = class_of_pair(F.col("pid"), F.col("pal"), long_, short)
    ids = [F.when(turned, F.col("q")).otherwise(F.col("t")).alias("id"), F.when(turned, F.col("t")).otherwise(F.col("q")).alias("parent")]
    return rows.select(*ids, "place", kind.alias("kind"), "pid", "pal", (long_ == short).alias("same")).where("kind is not null")


def _alternates(first: DataFrame) -> DataFrame:
    """ids of the sequences that end as alternates. first: id, parent, place: the pair that counts for each."""
    named = first.select("place", F.col("id").alias("child"), F.col("parent").alias("id"))
    edges = cut(named.join(first.select("id", F.col("place").alias("own")), "id").where("place < own").select("child", "id"))
    left, found = first.select("id"), None
    while not left.isEmpty():
        alt = left.join(edges, "id", "left_anti")
        mains = edges.join(alt.select(F.col("id").alias("child")), "child", "left_semi").select("id").distinct()
        decided = cut(alt.select("id", F.lit(True).alias("alt")).union(mains.select("id", F.lit(False))))
        left = cut(left.join(decided, "id", "left_anti"))
        # edges to decided sequences and from mains have no say any more
        edges = cut(edges.join(decided, "id", "left_anti").join(decided.where("not alt").select(F.col("id").alias("child")), "child", "left_anti"))
        alt = decided.where("alt").select("id")
        found = alt if found is None else found.union(alt)
    return first.select("id").limit(0) if found is None else found


def identity_classes(pairs: DataFrame) -> DataFrame:
    """id, class, main, pid, pal of every sequence of pairs (q, q_len, t, t_len, aln, ident).

    Classes: main, noclass (no pair gives it one), or that of the pair that counts; an alternate rises to althi1 by a later pair of that
    class, but not by one of equal size with an alternate of its own. main is followed to a sequence that is no alternate.
    """
    rows = cut(_candidates(pairs))
    first = rows.groupBy("id").agg(F.min(F.struct("place", "parent", "kind", "pid", "pal")).alias("f")).select("id", "f.*")
    first = cut(first)
    alts = first.join(_alternates(first), "id", "left_semi")
    own = alts.select(F.col("id").alias("parent"), F.col("parent").alias("of"))
    risen = rows.where("kind = 'althi1'").join(own, "parent", "left").where("not (same and coalesce(of = id, false))").select("id").distinct().withColumn("risen", F.lit(True))
    roots = graphs.chain_ends(alts.select("id", F.col("parent").alias("to"))).select("id", F.col("end").alias("main"))
    kind = F.when(F.col("risen") & F.col("kind").startswith("alt"), "althi1").otherwise(F.col("kind"))
    named = alts.join(risen, "id", "left").join(roots, "id").select("id", kind.alias("class"), "main", "pid", "pal")
    ids = pairs.select(F.col("q").alias("id")).union(pairs.select("t")).distinct()
    mains = alts.select(F.col("parent").alias("id")).distinct().withColumn("is_main", F.lit(True))
    rest = ids.join(alts, "id", "left_anti").join(mains, "id", "left")
    zero = F.lit(0).cast("long")
    return named.unionByName(rest.select("id", F.when(F.col("is_main"), "main").otherwise("noclass").alias("class"), F.col("id").alias("main"), zero.alias("pid"), zero.alias("pal")))


def rescued_by_map(classes: DataFrame, maps: DataFrame, sizes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Classes in which sequences without one take that of the genome map: altmap, alternates of the larger they lie on.

    maps: a, b, percent, sequences that lie on one locus. Of a map pair that no alignment has, the smaller (by size, then the
    larger id) counts; of several larger ones the best by percent, then size, then id is its main, followed to that one's
    main. Only sequences of class noclass are rescued: a main with alternates keeps its class.
    """
    both = maps.select("a", "b", "percent").union(maps.select("b", "a", "percent")).where("a <> b")
    size = lambda name: sizes.select(F.col("id").alias(name), F.col("size").alias(f"{name}_size"))
    both = both.join(size("a"), "a").join(size("b"), "b").where("a_size > b_size or (a_size = b_size and a < b)")
    aligned = pairs.select(F.least("q", "t").alias("x"), F.greatest("q", "t").alias("y")).distinct()
    both = both.withColumn("x", F.least("a", "b")).withColumn("y", F.greatest("a", "b")).join(aligned, ["x", "y"], "left_anti")
    best = both.groupBy(F.col("b").alias("id")).agg(F.max(F.struct("percent", "a_size", (-F.col("a")).alias("minus"))).alias("best"))
    best = best.select("id", (-F.col("best.minus")).alias("on"), F.col("best.percent").alias("percent"))
    saved = cut(classes.where("class = 'noclass'").select("id").join(best, "id"))
    # a larger one may be rescued itself: follow the links, then take the class's main
    ends = graphs.chain_ends(saved.select("id", F.col("on").alias("to")))
    mains = ends.select("id", F.col("end").alias("on")).join(classes.select(F.col("id").alias("on"), F.col("main").alias("on_main")), "on", "left")
    found = saved.select("id", "percent").join(mains, "id").select("id", F.coalesce("on_main", "on").alias("to"), "percent")
    rows = classes.join(found, "id", "left")
    hit = F.col("to").isNotNull()
    held = {"class": F.when(hit, "altmap"), "main": F.when(hit, F.col("to")), "pid": F.when(hit, 99), "pal": F.when(hit, F.col("percent"))}
    return rows.select("id", *[F.coalesce(v, F.col(c)).alias(c) for c, v in held.items()])


def reference_matches(hits: DataFrame, least: float = 60, share: float = 0.9) -> DataFrame:
    """Best reference of each sequence and what it is worth: t, ref, bits, ref_best (bits of the reference's best), match.

    hits: t, ref, bits, aln. Of equal bits the hit of shorter alignment, then larger reference (for a reference: sequence) counts.
    match: refbest, the sequence is its reference's best; refok, it is the best of some reference, at least bits; refgood, at
    least a share of its reference's best; null else.
    """
    by = lambda key, other: hits.groupBy(key).agg(F.max(F.struct("bits", (-F.col("aln")).alias("minus"), other)).alias("m")).select(key, F.col("m.bits").alias("bits"), F.col(f"m.{other}").alias(other))
    mine, of_ref = by("t", "ref"), by("ref", "t")
    best = of_ref.select("ref", F.col("t").alias("best_t"), F.col("bits").alias("ref_best"))
    some = of_ref.where(F.col("bits") >= least).select("t").distinct().withColumn("some", F.lit(True))
    rows = mine.join(best, "ref").join(some, "t", "left")
    good = (F.col("ref_best") > least) & (F.col("bits") >= share * F.col("ref_best"))
    return rows.select("t", "ref", "bits", "ref_best", F.when(F.col("best_t") == F.col("t"), "refbest").when(F.col("some"), "refok").when(good, "refgood").alias("match"))


def grade_points(grade: Column) -> Column:
    """-2 to 2: complete 2, partial at one end 1; bad ends -2, poor ends -1."""
    whole = F.when(grade.contains("complete"), 2).when(grade.rlike("partial[35]"), 1).otherwise(0)
    return F.coalesce(whole - F.when(grade.contains("utrbad"), 2).when(grade.contains("utrpoor"), 1).otherwise(0), F.lit(0))


def corrected_clusters(members: DataFrame) -> DataFrame:
    """cluster, id, main, size: members of protein clusters under mains that grades and sizes choose.

    members: cluster, id, place (order in the cluster), size, grade, is_main, valid. The main given is replaced by a later
    valid member that is larger and at most one point worse, or better and larger than 0.98 of it; then on from there. Invalid members
    go, and with them the main if it is one. A round takes each cluster to its next replacement: rounds are replacements, and
    every one makes the main larger or better.
    """
    rows = cut(members.where("valid").select("cluster", "id", "place", "size", grade_points(F.col("grade")).cast("long").alias("points"), "is_main"))
    given = rows.where("is_main").groupBy("cluster").agg(F.min(F.struct("id", "size", "points")).alias("m")).select("cluster", F.col("m.id").alias("main"), F.col("m.size").alias("m_size"), F.col("m.points").alias("m_points"))
    state = rows.select("cluster").distinct().join(given, "cluster", "left")
    zero = F.lit(0).cast("long")
    state = cut(state.select("cluster", "main", F.coalesce("m_size", zero).alias("m_size"), F.coalesce("m_points", F.lit(-9).cast("long")).alias("m_points"), F.lit(-1).cast("long").alias("at")))
    done = None
    while True:
        larger = (F.col("size") > F.col("m_size")) & (F.col("points") >= F.col("m_points") - 1)
        better = (F.col("points") > F.col("m_points")) & (F.col("size") > 0.98 * F.col("m_size"))
        other = F.col("main").isNull() | (F.col("id") != F.col("main"))
        hit = (F.col("place") > F.col("at")) & other & (larger | better)
        next_ = rows.join(state, "cluster").where(hit).groupBy("cluster").agg(F.min(F.struct("place", "id", "size", "points")).alias("n"))
        both = cut(state.join(next_, "cluster", "left"))
        still = both.where("n is null").select("cluster", "main")
        done = still if done is None else done.union(still)
        state = both.where("n is not null").select("cluster", F.col("n.id").alias("main"), F.col("n.size").alias("m_size"), F.col("n.points").alias("m_points"), F.col("n.place").alias("at"))
        if state.isEmpty():
            break
    return rows.join(done, "cluster").select("cluster", "id", "main", "size")
