"""Alternative isoforms: transcripts of a main gene kept or dropped by their chains of introns.

A transcript's chain lists, exon by exon in place order, the introns whose splice ends abut the exon. The rule is a walk
over a main's alternates, longest chain first, that looks at the chains accepted so far. No walk is needed: containment is
transitive and a dropped sub-chain lies in an accepted chain, so "part of an accepted chain" is "part of any other chain that
isn't too short", and of one chain's transcripts the first accepted one makes those after it duplicates. Containment is found
on an index of suffixes: among the sorted suffixes of a main's chains those that begin with a chain follow it at once, so one
look at the next row tells. No two chains are paired, and the index is dealt by main and first intron; it holds the suffixes
alone whose first intron begins a chain of their main.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.session import stored

from .genes import compared_genes, introns, spans


def shared_introns(exons: DataFrame) -> DataFrame:
    """Introns by place: ref, strand, begin, end, intron (a name of the place) and support, the transcripts that have it."""
    found = introns(exons).groupBy("ref", "strand", "begin", "end").agg(F.count("*").alias("support"))
    return found.withColumn("intron", F.concat_ws("_", "begin", "end"))


def sited_exons(exons: DataFrame, places: DataFrame) -> DataFrame:
    """splice_sites with the exons' begin and end. Introns are listed by their ends first, so that exons meet one row for each of their own.

    An intron can't abut both ends of an exon, so what the two ends bring is told apart without a look at the exon's other rows.
    """
    held = F.struct("intron", "support")
    # lists are made behind the shuffle alone: few rows share a site, so lists made before it save none
    by_end = places.select("ref", "strand", (F.col("end") + 1).alias("begin"), held.alias("x")).repartition("ref", "strand", "begin")
    by_begin = places.select("ref", "strand", (F.col("begin") - 1).alias("end"), held.alias("x")).repartition("ref", "strand", "end")
    left = by_end.groupBy("ref", "strand", "begin").agg(F.collect_list("x").alias("l"))
    right = by_begin.groupBy("ref", "strand", "end").agg(F.collect_list("x").alias("r"))
    rows = exons.select("gid", "exon_no", "ref", "strand", "begin", "end").join(left, ["ref", "strand", "begin"], "left").join(right, ["ref", "strand", "end"], "left")
    none = F.array().cast(left.schema["l"].dataType)
    both = F.concat(F.coalesce("l", none), F.coalesce("r", none))
    score = F.aggregate("x", F.lit(0).cast("long"), lambda a, x: a + x["support"])
    rows = rows.where("l is not null or r is not null").select("gid", "exon_no", "begin", "end", both.alias("x"))
    return rows.select("gid", "exon_no", "begin", "end", F.sort_array(F.array_distinct("x.intron")).alias("introns"), score.alias("score"))


def splice_sites(exons: DataFrame, places: DataFrame) -> DataFrame:
    """gid, exon_no, introns (sorted names) and score: the introns whose ends abut an exon on its strand, and their support summed."""
    return sited_exons(exons, places).select("gid", "exon_no", "introns", "score")


def _keyed(exons: DataFrame, sites: DataFrame) -> DataFrame:
    """gid, begin, end, key (an exon's introns) and score of exons with introns. sites may hold the exons' begin and end already."""
    rows = sites
    if not {"begin", "end"} <= set(sites.columns):
        rows = exons.select("gid", "exon_no", "begin", "end").join(sites.where(F.size("introns") > 0), ["gid", "exon_no"])
    return rows.select("gid", "begin", "end", F.concat(F.lit("<"), F.array_join("introns", ">,<"), F.lit(">")).alias("key"), "score")


def chains(keyed: DataFrame) -> DataFrame:
    """gid, chain, length of its plain form, n (exons with introns less one), and first and last, its end exons (key, begin, end). keyed: _keyed."""
    rows = keyed.select("gid", "begin", "end", "key").repartition("gid").groupBy("gid").agg(F.sort_array(F.collect_list(F.struct("begin", "end", "key"))).alias("x"))
    rows = rows.select("gid", F.array_join("x.key", ";").alias("chain"), "x")
    plain = F.length(F.translate("chain", "<>", "")) + F.size("x") - 1  # exons are parted by two characters
    end = lambda at: F.struct(*[F.element_at("x", at)[c].alias(c) for c in ("key", "begin", "end")])
    return rows.select("gid", "chain", plain.alias("length"), (F.size("x") - 1).alias("n"), end(1).alias("first"), end(-1).alias("last"))


def _ids(chain: str) -> Column:
    """The introns of a chain."""
    return F.array_distinct(F.split(F.translate(chain, ";<>", ","), ","))


def contained(rows: DataFrame, key: str) -> DataFrame:
    """(key, chain) of the chains that are part of another chain of the same key, introns whole."""
    distinct = rows.select(key, "chain").distinct()
    begun = distinct.groupBy(key).agg(F.collect_set(F.substring_index(F.col("chain"), ">", 1)).alias("begun"))
    many = F.length("chain") - F.length(F.replace("chain", F.lit("<"), F.lit("")))
    tails = distinct.join(begun, key).select(key, "chain", many.alias("many"), "begun", F.posexplode(F.split("chain", "<")).alias("at", "part"))
    tails = tails.where((F.col("at") > 0) & F.array_contains("begun", F.concat(F.lit("<"), F.substring_index("part", ">", 1)))).withColumn("k", F.col("many") - F.col("at") + 1)
    tails = tails.select(key, "chain", F.expr("concat('<', substring_index(chain, '<', -k))").alias("tail"), (F.col("k") == F.col("many")).alias("whole"))
    tails = tails.withColumn("head", F.substring_index("tail", ">", 1))
    after = F.lead("tail").over(Window.partitionBy(key, "head").orderBy("tail", F.col("whole").desc()))
    return tails.withColumn("after", after).where("whole and startswith(after, tail)").select(key, "chain")


def usual_ends(keyed: DataFrame) -> DataFrame:
    """Per exon key (its introns): the two ends of most support, in order, and the outermost ends seen. keyed: _keyed."""
    rows = keyed.groupBy("key", "begin", "end").agg(F.sum("score").alias("score")).select("key", "score", F.explode(F.array("begin", "end")).alias("at"))
    sums = rows.groupBy("key", "at").agg(F.sum("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "at"))
    out = sums.withColumn("place", place).groupBy("key").agg(
        F.min(F.when(F.col("place") <= 2, F.col("at"))).alias("low"), F.max(F.when(F.col("place") <= 2, F.col("at"))).alias("high"),
        F.min("at").alias("leftmost"), F.max("at").alias("rightmost"), F.count("*").alias("ends"),
    )
    return out.where("ends >= 2").drop("ends")


def _longer(end: str, side: str) -> Column:
    """Whether the exon at this end of the chain reaches beyond the usual ends, as far as any exon of its introns does."""
    begin, stop = F.col(f"{end}.begin"), F.col(f"{end}.end")
    out = ((begin < F.col(f"{side}_low")) & (begin == F.col(f"{side}_leftmost"))) | ((stop > F.col(f"{side}_high")) & (stop == F.col(f"{side}_rightmost")))
    return F.coalesce(out, F.lit(False))


def pick(
    exons: DataFrame, sites: DataFrame, mains: DataFrame, least_cds: int = 66, least_exon: int = 40, least_coding: int = 40,
    coding_to_main: float = 0.55, least_chain: float = 0.30,
) -> DataFrame:
    """Verdict of each alternate of each main: main, gid, place in the main's order, n, verdict and number.

    exons: gid, exon_no, ref, strand, begin, end, kind. sites: splice_sites or sited_exons. mains: gid of main genes; all other transcripts
    are alternates of the mains they share enough coding and exon bases with (percent of the larger), if enough of them is
    coding, also by the main's share. Verdicts: okay; okaltend: part of an accepted chain, but an end exon is the longest of
    its kind; oknewlocus: no intron of the main's; dropdup: an accepted transcript has the chain; dropshort: fewer exons than a
    share of the main's; dropsubchain. number: 1 for the main, then the accepted ones in order, null for dropped ones.
    Transcripts without introns have no chain and no row; a main without alternates has none either.
    """
    exons = exons.select("gid", "exon_no", "ref", "strand", "begin", "end", "kind").withColumn("score", F.lit(0))
    main_exons = exons.join(mains.select("gid"), "gid", "left_semi")
    other_exons = exons.join(mains.select("gid"), "gid", "left_anti")
    sizes = stored(spans(exons).select("gid", "exon_len", "cds_len"), "sizes")
    same = compared_genes(other_exons, main_exons, sizes=sizes).where((F.col("cds_pct") >= least_cds) & (F.col("exon_pct") >= least_exon))
    coding = lambda p: F.floor(0.5 + 100 * F.col(f"{p}_cds") / F.col(f"{p}_exon"))
    pairs = same.select(F.col("other").alias("main"), "gid", coding("p").alias("pcds"), coding("b").alias("main_pcds"))
    keyed = stored(_keyed(exons, sites), "keyed")
    held = stored(chains(keyed), "chains")
    mine = held.select(F.col("gid").alias("main"), F.col("n").alias("main_n"), F.col("chain").alias("main_chain"))
    fit = (F.col("pcds") >= least_coding) & (F.col("pcds") >= coding_to_main * F.col("main_pcds"))
    pairs = stored(pairs.select("main", "gid", fit.alias("fit")), "pairs")
    members = pairs.where("fit").select("main", "gid", F.lit(False).alias("is_main"))
    members = members.union(pairs.select("main").distinct().select("main", F.col("main").alias("gid"), F.lit(True)))
    rows = members.join(held, "gid").join(mine, "main")
    rows = rows.withColumn("common", F.arrays_overlap(_ids("chain"), _ids("main_chain"))).drop("main_chain")

    ends = usual_ends(keyed)
    for end, side in (("first", "f"), ("last", "l")):
        named = ends.select(F.col("key").alias(f"{side}_key"), *[F.col(c).alias(f"{side}_{c}") for c in ("low", "high", "leftmost", "rightmost")])
        rows = rows.join(named, F.col(f"{end}.key") == F.col(f"{side}_key"), "left")
    inside = contained(members.join(held.select("gid", "chain"), "gid"), "main").withColumn("inside", F.lit(True))
    rows = rows.join(inside, ["main", "chain"], "left")

    short = F.col("n") < F.greatest(F.lit(1), F.floor(least_chain * F.col("main_n")))
    strange = ~F.col("is_main") & (F.col("n") > 0) & ~F.col("common")
    own = (
        F.when(short, F.when(strange, "oknewlocus").otherwise("dropshort"))
        .when(F.col("inside") & ~F.col("is_main"), F.when(_longer("first", "f") | _longer("last", "l"), "okaltend").otherwise("dropsubchain"))
        .when(strange, "oknewlocus").otherwise("okay")
    )
    order = [F.desc("is_main"), F.desc("length"), "gid"]
    earlier = Window.partitionBy("main", "chain").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("own", own).withColumn("taken", F.coalesce(F.max(F.col("own").startswith("ok")).over(earlier), F.lit(False)))
    rows = rows.withColumn("verdict", F.when(F.col("taken"), "dropdup").otherwise(F.col("own")))
    whole = Window.partitionBy("main").orderBy(*order)
    accepted = F.col("verdict").startswith("ok") & ~F.col("is_main")
    number = F.when(F.col("verdict").startswith("ok"), F.when(F.col("is_main"), F.lit(1)).otherwise(1 + F.sum(accepted.cast("int")).over(whole)))
    return rows.select("main", "gid", F.row_number().over(whole).alias("place"), "n", "verdict", number.cast("int").alias("number"))
