"""Join and split checks: do the chains of evidence over a gene's exons run through it, or do they fall apart?

Every evidence id is a chain of the exons it covers; exons in a row that share introns are one more chain. Each exon goes to
the largest of its chains; the gene's largest group of exons and the groups that fill up the rest decide its code.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomspan.session import stored

# Scores of the codes, from a good model to a wrong join.
SCORES = {"N0": 0, "C1": 99, "J2": -99, "C1T1": 69, "IJ4": -9, "ER2": -2, "EP3": -1, "EM4": 9}


def intron_quality(rows: DataFrame) -> DataFrame:
    """gid and quality of its intron chain. rows: gid, nx, x (the exon's number), value (signed support, null without introns), joined.

    none: no support; poor: support against it, or none that joins; complete: all exons supported and joined; complete_inner: all but
    ends; miss_inner: a joint is missing inside; good, ok: some joints.
    """
    head = F.when(F.col("joins") > 8, 3).otherwise(2)
    genes = rows.groupBy("gid", "nx").agg(
        F.count_if(F.col("value") > 0).alias("good"), F.count_if(F.col("value") < 0).alias("bad"), F.count_if("joined").alias("joins"),
        F.sort_array(F.collect_list(F.when(~F.col("joined"), F.col("x") - 1))).alias("loose"),
    )
    inside = F.exists("loose", lambda x: (x >= head) & (x <= F.col("nx") - head))
    nx, good, joins = F.col("nx"), F.col("good"), F.col("joins")
    word = (
        F.when((good == 0) & (F.col("bad") == 0), "none").when(F.col("bad") > 0, "poor").when((nx > 2) & (good == nx) & (joins + 1 == nx), "complete")
        .when((nx > 3) & (good >= nx - 2) & ((joins >= nx - 3) | (joins > 0.75 * nx)), F.when(inside, "miss_inner").otherwise("complete_inner"))
        .when((good > 0) & (joins > 0), F.when(good / nx > 0.66, "good").otherwise("ok")).otherwise("poor")
    )
    return genes.select("gid", word.alias("quality"))


def _exons(exons: DataFrame, sites: DataFrame) -> DataFrame:
    """Exons numbered in place order, with their support, whether one of their introns is the exon's before as well, and the run of those (null without introns)."""
    place = Window.partitionBy("gid").orderBy("begin", "end", "exon_no")
    sites = sites.select("gid", "exon_no", F.when(F.size("introns") > 0, F.col("introns")).alias("introns"), F.col("score").alias("value"))
    rows = exons.select("gid", "exon_no", "begin", "end").join(sites, ["gid", "exon_no"], "left").withColumn("x", F.row_number().over(place))
    rows = rows.withColumn("nx", F.count("*").over(Window.partitionBy("gid")))
    joined = F.coalesce(F.arrays_overlap("introns", F.lag("introns").over(place)), F.lit(False))
    rows = rows.withColumn("joined", joined).withColumn("value", F.when(F.col("introns").isNotNull(), F.col("value")))
    begun = F.sum((F.col("introns").isNotNull() & ~F.col("joined")).cast("int")).over(place)
    return rows.select("gid", "exon_no", "x", "nx", "value", "joined", F.when(F.col("introns").isNotNull(), begun).alias("run"))


def _codes(quality: Column) -> Column:
    """The code of a gene: nx exons, n1 of them in the main chain (row: whether they are neighbours), more in chains that fill up."""
    nx, n1, more = F.col("nx"), F.col("n1"), F.col("more")
    open_end = F.col("open_first") | F.col("open_last")
    whole = (n1 >= nx) | (nx == 1) | ((nx > 5) & (n1 == nx - 1) & open_end)
    alone = F.when((nx > 3) & (n1 == nx - 1) & open_end, "C1").when((nx > 3) & (n1 / nx < 0.75), "EP3")
    several = (
        F.when((nx > 3) & ((n1 + more) / nx < 0.75), "EP3").when((more < 2) & (n1 > 1) & (nx > 3) & F.col("row"), "C1T1")
        .when((more > 1) & (F.col("more_evidence") <= 1), "IJ4").when((more > 1) & quality.contains("complete"), "EM4").when(more > 1, "J2")
    )
    rest = F.when((nx > 3) & (n1 > 0.74 * nx) & F.col("row"), "EM4").otherwise("ER2")
    weak = (nx < 3) | (n1 == 1) | (n1 < 0.2 * nx)
    return F.when(F.col("chains") == 0, "N0").when(whole, "C1").when(weak, "EP3").otherwise(F.coalesce(F.when(F.col("chains") > 1, several).otherwise(alone), rest))


def join_check(exons: DataFrame, evidence: DataFrame, sites: DataFrame) -> DataFrame:
    """One row a gene: gid, code, score, nx, main and others (exon numbers of the main chain, and of each other in order), quality.

    exons: gid, exon_no, begin, end. evidence: gid, exon_no, id (text). sites: gid, exon_no, introns, score (signed support).
    C1 complete; C1T1 but for one end; J2 falls into chains: a wrong join; IJ4 falls apart by introns alone; EM4 misses an end, or its
    introns run through; EP3 poor evidence; ER2 other faults; N0 none.
    """
    rows = stored(_exons(exons, sites), "exons")
    # an exon's row and its links are dealt by gene once, and all that follows is told from there
    none = F.lit(None)
    both = rows.select("gid", "exon_no", "x", "run", none.cast("string").alias("id"))
    both = both.unionByName(evidence.select("gid", "exon_no", none.cast("int").alias("x"), none.cast("int").alias("run"), F.col("id").cast("string").alias("id"))).repartition("gid")
    # each list holds what one exon has, and no id twice
    held = both.groupBy("gid", "exon_no").agg(F.max("x").alias("x"), F.max("run").alias("run"), F.collect_set("id").alias("ids")).where("x is not null")
    # an intron's chain sorts after evidence ids of the same size, by its first exon
    chain = lambda kind, id: F.struct(F.lit(kind).alias("kind"), id.alias("id"))
    by_intron = F.filter(F.array(F.when(F.col("run").isNotNull(), chain(1, F.lpad(F.col("run").cast("string"), 6, "0")))), lambda c: c.isNotNull())
    links = held.select("gid", "x", F.explode(F.concat(F.transform("ids", lambda i: chain(0, i)), by_intron)).alias("chain"))
    links = links.withColumn("held", F.count("*").over(Window.partitionBy("gid", "chain")))
    best = links.groupBy("gid", "x").agg(F.min(F.struct((-F.col("held")).alias("minus"), "chain")).alias("best"))
    groups = best.groupBy("gid", F.col("best.chain").alias("chain")).agg(F.sort_array(F.collect_list("x")).alias("xs"), F.count("*").alias("n"))
    order = Window.partitionBy("gid").orderBy(F.desc("n"), "chain")
    groups = groups.withColumn("rank", F.row_number().over(order)).withColumn("before", F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)))

    genes = rows.select("gid", "nx").distinct().join(intron_quality(rows), "gid")
    fills = (F.col("rank") > 1) & (F.col("before") < F.col("nx"))
    first = F.col("rank") == 1
    told = groups.join(genes.select("gid", "nx"), "gid").groupBy("gid").agg(
        F.count("*").alias("chains"), F.max(F.when(first, F.col("n"))).alias("n1"), F.max(F.when(first, F.col("xs"))).alias("main"),
        F.coalesce(F.sum(F.when(fills, F.col("n"))), F.lit(0)).alias("more"), F.coalesce(F.sum(F.when(fills & (F.col("chain.kind") == 0), F.col("n"))), F.lit(0)).alias("more_evidence"),
        F.sort_array(F.collect_list(F.when(~first, F.struct("rank", "xs")))).alias("others"), F.min(F.array_min("xs")).alias("lowest"), F.max(F.array_max("xs")).alias("highest"),
    )
    out = genes.join(told, "gid", "left").fillna(0, ["chains"])
    row = F.element_at("main", -1) - F.element_at("main", 1) + 1 == F.col("n1")
    out = out.withColumns({"open_first": F.col("lowest") > 1, "open_last": F.col("highest") < F.col("nx"), "row": row}).withColumn("code", _codes(F.col("quality")))
    score = F.create_map(*[F.lit(x) for pair in SCORES.items() for x in pair])[F.col("code")]
    joined = lambda xs: F.array_join(xs.cast("array<string>"), ",")
    others = F.array_join(F.transform("others", lambda o: joined(o["xs"])), ";")
    return out.select("gid", "code", score.alias("score"), "nx", F.coalesce(joined(F.col("main")), F.lit("")).alias("main"), F.coalesce(others, F.lit("")).alias("others"), "quality")
