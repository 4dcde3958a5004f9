"""Readers of the text formats, each a DataFrame with typed columns. Compressed files are read by their suffix.

Line formats are read by Spark's text and CSV readers, so files split over tasks. Record formats use the record mark as
line separator, which keeps a record whole in one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def attribute_map(text: Column) -> Column:
    """key=value;... as a map; blanks around parts go, empty parts too, of repeated keys the first stays."""
    parts = F.filter(F.transform(F.split(text, ";"), lambda x: F.trim(x)), lambda x: x.contains("="))
    key = lambda x: F.substring_index(x, "=", 1)
    keys = F.transform(parts, key)
    first = F.filter(parts, lambda x, i: F.array_position(keys, key(x)) == i + 1)
    return F.map_from_entries(F.transform(first, lambda x: F.struct(key(x).alias("key"), x.substr(F.locate("=", x) + 1, F.length(x)).alias("value"))))


def attribute_text(attrs: Column) -> Column:
    """A map as key=value;... in its own order."""
    return F.array_join(F.transform(F.map_entries(attrs), lambda x: F.concat(x["key"], F.lit("="), x["value"])), ";")


def _fields(spark: SparkSession, path: str, names: list[str], sep: str = "\t", skip: str = r"^\s*(#|$)") -> DataFrame:
    """Lines split at sep into named text columns; comment and blank lines left out, missing fields null."""
    parts = F.split("value", "\\" + sep if sep in "|." else sep)
    lines = spark.read.text(path).where(~F.col("value").rlike(skip))
    return lines.select(*[F.get(parts, i).alias(n) for i, n in enumerate(names)], F.size(parts).alias("n_fields"), F.monotonically_increasing_id().alias("row_no"))


def _typed(df: DataFrame, **types: str) -> DataFrame:
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items()})


def gff(spark: SparkSession, path: str) -> DataFrame:
    """Located features: nine columns, attributes as a map and as text, and id: ID, Parent, Target or N<row>."""
    names = ["ref", "source", "type", "begin", "end", "score", "strand", "phase", "attr_text"]
    rows = _typed(_fields(spark, path, names, skip=r"^\W|^$"), begin="long", end="long").where("n_fields >= 8").drop("n_fields")
    attrs = attribute_map(F.coalesce("attr_text", F.lit("")))
    rows = rows.withColumn("attrs", attrs)
    target = F.regexp_extract(F.coalesce(F.col("attrs")["Target"], F.lit("")), r"^(\S+)", 1)
    named = F.coalesce(F.col("attrs")["ID"], F.col("attrs")["Parent"], F.nullif(target, F.lit("")), F.concat(F.lit("N"), F.col("row_no").cast("string")))
    return rows.withColumn("id", named)


def gtf(spark: SparkSession, path: str) -> DataFrame:
    """Features with gene_id and transcript_id from key "value"; attributes."""
    names = ["ref", "source", "type", "begin", "end", "score", "strand", "phase", "attr_text"]
    rows = _typed(_fields(spark, path, names), begin="long", end="long").drop("n_fields")
    value = lambda k: F.nullif(F.regexp_extract("attr_text", rf'{k} "([^"]*)"', 1), F.lit(""))
    return rows.withColumn("gene_id", value("gene_id")).withColumn("transcript_id", value("transcript_id"))


def gene_records(features: DataFrame, top: str = "mRNA", parts: tuple = ("exon", "CDS")) -> tuple[DataFrame, DataFrame]:
    """(genes, exons) of a feature table, by ID and Parent. A gene id met again is renamed id.n in row order.

    Parts go to the nearest record of their id before them, as a running count of records per id.
    """
    from pyspark.sql import Window

    own = F.when(F.col("type") == top, F.coalesce(F.col("attrs")["ID"], F.col("id"))).otherwise(F.coalesce(F.col("attrs")["Parent"], F.col("id")))
    rows = features.where(F.col("type").isin(top, *parts)).withColumn("own", own)
    seen = F.sum((F.col("type") == top).cast("int")).over(Window.partitionBy("own").orderBy("row_no"))
    rows = rows.withColumn("nth", seen)
    rows = rows.withColumn("gid", F.when(F.col("nth") > 1, F.concat("own", F.lit("."), F.col("nth").cast("string"))).otherwise(F.col("own"))).drop("own", "nth")
    return rows.where(F.col("type") == top), rows.where(F.col("type") != top)


def blast(spark: SparkSession, path: str) -> DataFrame:
    """Alignment hits of twelve columns; a row with another number stops the read. Strand from the target's order."""
    names = ["q", "t", "pident", "aln", "mismatch", "gap", "qb", "qe", "tb", "te", "evalue", "bits"]
    rows = _fields(spark, path, names)
    checked = F.when(F.col("n_fields") == 12, F.col("q")).otherwise(F.raise_error(F.concat(F.lit("a hit needs 12 columns, not "), F.col("n_fields").cast("string"))))
    kinds = {c: "double" for c in ("pident", "evalue", "bits")} | {c: "long" for c in ("aln", "mismatch", "gap", "qb", "qe", "tb", "te")}
    rows = _typed(rows.withColumn("q", checked), **kinds).drop("n_fields")
    back = F.col("tb") > F.col("te")
    return rows.withColumns({"strand": F.when(back, "-").otherwise("+"), "tb": F.least("tb", "te"), "te": F.greatest("tb", "te")})


def psl(spark: SparkSession, path: str) -> DataFrame:
    """One row a block of BLAT alignments, places from 1."""
    names = ["match", "mismatch", "repmatch", "ns", "q_gaps", "q_gap_bases", "t_gaps", "t_gap_bases", "strand", "q", "q_size", "q_start", "q_end", "t", "t_size", "t_start", "t_end", "blocks", "sizes", "q_starts", "t_starts"]
    rows = _typed(_fields(spark, path, names, skip=r"^\D"), **{c: "long" for c in ("match", "mismatch", "q_size", "q_start", "q_end", "t_size", "t_start", "t_end", "blocks")})
    numbers = lambda c: F.transform(F.filter(F.split(c, ","), lambda x: x != ""), lambda x: x.cast("long"))
    zipped = F.arrays_zip(numbers("sizes").alias("n"), numbers("q_starts").alias("qs"), numbers("t_starts").alias("ts"))
    each = rows.select("q", "q_size", "t", "t_size", "strand", "match", "mismatch", "row_no", F.posexplode(zipped).alias("block", "x"))
    x = [F.col(f"x.{k}") for k in ("n", "qs", "ts")]
    return each.select("q", "q_size", "t", "t_size", "strand", "match", "mismatch", "row_no", "block", (x[1] + 1).alias("qb"), (x[1] + x[0]).alias("qe"), (x[2] + 1).alias("tb"), (x[2] + x[0]).alias("te"))


def lastz(spark: SparkSession, path: str) -> DataFrame:
    """General-format alignments by the names of their header line; fractions and percents as numbers."""
    rows = spark.read.option("sep", "\t").option("header", True).csv(path)
    rows = rows.toDF(*[c.lstrip("#") for c in rows.columns])
    for c in rows.columns:
        if c.endswith("Pct") or c.endswith("%"):
            rows = rows.withColumn(c, F.rtrim(F.col(c), F.lit("%")).try_cast("double"))
    return rows


def clusters(spark: SparkSession, path: str) -> DataFrame:
    """Members of sequence clusters: cluster, id, length, is_main, pct."""
    text = spark.read.option("lineSep", ">Cluster ").text(path).where("trim(value) <> ''")
    each = text.select(F.regexp_extract("value", r"^(\d+)", 1).cast("long").alias("cluster"), F.explode(F.slice(F.split("value", "\n"), 2, 1 << 30)).alias("line")).where("line <> ''")
    pick = lambda p: F.regexp_extract("line", p, 1)
    return each.select(
        "cluster", pick(r">(.+?)\.\.\.").alias("id"), pick(r"(\d+)(?:nt|aa)").cast("long").alias("length"), F.col("line").rlike(r"\*\s*$").alias("is_main"), pick(r"([\d.]+)%\s*$").try_cast("double").alias("pct")
    )


def fasta(spark: SparkSession, path: str) -> DataFrame:
    """Sequences: id, header, attrs (key=value; of the header) and seq without blanks."""
    text = spark.read.option("lineSep", "\n>").text(path).select(F.regexp_replace("value", "^>", "").alias("value")).where("trim(value) <> ''")
    header = F.substring_index("value", "\n", 1)
    body = F.when(F.col("value").contains("\n"), F.regexp_replace(F.regexp_replace("value", r"^[^\n]*\n", ""), r"\s+", "")).otherwise(F.lit(""))
    rest = F.regexp_replace(header, r"^\S+\s*", "")
    return text.select(F.regexp_extract(header, r"^(\S+)", 1).alias("id"), rest.alias("header"), attribute_map(rest).alias("attrs"), body.alias("seq"))


def fastq(spark: SparkSession, path: str) -> DataFrame:
    """Reads of four lines: id, mate, seq, qual. A record starts with @ and its name, at a line start, before a base line."""
    text = spark.read.option("lineSep", "\n@").text(path).select(F.regexp_replace("value", "^@", "").alias("value"))
    parts = F.split("value", "\n")
    rows = text.select(F.get(parts, 0).alias("head"), F.get(parts, 1).alias("seq"), F.get(parts, 3).alias("qual")).where(F.col("seq").rlike("^[A-Za-z.*-]+$"))
    name = F.regexp_extract("head", r"^(\S+)", 1)
    return rows.select(F.regexp_replace(name, r"/[12]$", "").alias("id"), F.regexp_extract(name, r"/([12])$", 1).try_cast("int").alias("mate"), "seq", "qual")


def pairs_of(reads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(pairs, singles) of reads with mates 1 and 2, joined by name."""
    left, right = reads.where("mate = 1"), reads.where("mate = 2")
    pairs = left.select("id", F.col("seq").alias("seq1")).join(right.select("id", F.col("seq").alias("seq2")), "id")
    return pairs, reads.join(pairs.select("id"), "id", "left_anti")


def sam(spark: SparkSession, path: str) -> DataFrame:
    """Aligned reads: eleven columns, and optional tags as a map tag -> value."""
    names = ["id", "flag", "ref", "loc", "mapq", "cigar", "mate_ref", "mate_loc", "isize", "seq", "qual"]
    parts = F.split("value", "\t")
    lines = spark.read.text(path).where(~F.col("value").startswith("@") & (F.size(parts) >= 11))
    tags = F.transform(F.slice(parts, 12, 1 << 20), lambda x: F.struct(F.substring(x, 1, 2).alias("key"), F.substring(x, 6, 1 << 20).alias("value")))
    rows = lines.select(*[F.get(parts, i).alias(n) for i, n in enumerate(names)], F.map_from_entries(tags).alias("opts"))
    return _typed(rows, flag="int", loc="long", mapq="int", mate_loc="long", isize="long").withColumn("strand", F.coalesce(F.col("opts")["XS"], F.when(F.col("flag").bitwiseAND(16) != 0, "-").otherwise("+")))


def pileup(spark: SparkSession, path: str, libraries: list[str]) -> DataFrame:
    """Depth per base and library, long: ref, at, base, library, depth. Three columns a library follow the first three."""
    parts = F.split("value", "\t")
    each = F.array(*[F.struct(F.lit(n).alias("library"), F.get(parts, 3 + 3 * i).try_cast("long").alias("depth")) for i, n in enumerate(libraries)])
    rows = spark.read.text(path).where(F.size(parts) >= 4).select(F.get(parts, 0).alias("ref"), F.get(parts, 1).try_cast("long").alias("at"), F.get(parts, 2).alias("base"), F.explode(each).alias("x"))
    return rows.select("ref", "at", "base", "x.library", F.coalesce("x.depth", F.lit(0)).alias("depth"))


def bed(spark: SparkSession, path: str, zero_based: bool = True) -> DataFrame:
    """Intervals with a value; half-open places from 0 become closed ones from 1 unless zero_based is False."""
    rows = _typed(_fields(spark, path, ["ref", "begin", "end", "value"], skip=r"^(#|track|browser|\s*$)"), begin="long", end="long", value="double")
    return rows.withColumn("begin", F.col("begin") + int(zero_based)).drop("n_fields")


def agp(spark: SparkSession, path: str) -> DataFrame:
    """Assembly map: contig rows with their span and orientation; gap rows have gap set."""
    rows = _typed(_fields(spark, path, ["scaffold", "s_begin", "s_end", "part", "kind", "contig", "c_begin", "c_end", "orient"]), s_begin="long", s_end="long", part="int")
    gap = F.col("kind").isin("U", "N")
    rows = rows.withColumn("gap", F.when(gap, F.col("contig").try_cast("long"))).withColumn("contig", F.when(~gap, F.col("contig")))
    return _typed(rows, c_begin="long", c_end="long").drop("n_fields")


def ortholog_hits(spark: SparkSession, path: str) -> DataFrame:
    """Semicolon-separated hits with their aligned spans as an array of (qb, qe, sb, se)."""
    rows = _fields(spark, path, ["n", "q", "q_len", "s", "s_len", "evalue", "pident", "spans"], sep=";")
    spans = F.transform(F.filter(F.split("spans", r"\."), lambda x: x != ""), lambda x: F.struct(*[F.regexp_extract(x, r":(\d+)-(\d+):(\d+)-(\d+)", i + 1).try_cast("long").alias(n) for i, n in enumerate(("qb", "qe", "sb", "se"))]))
    return _typed(rows.withColumn("spans", spans), n="long", q_len="long", s_len="long", evalue="double", pident="double").drop("n_fields")


def ortholog_groups(spark: SparkSession, path: str) -> DataFrame:
    """(grp, gene, species) from lines NAME(g genes,t taxa): gene(species) ..."""
    text = spark.read.text(path).where(F.col("value").rlike(r"^\S+\(\d+ genes"))
    members = F.filter(F.split(F.regexp_replace("value", r"^[^:]*:\s*", ""), r"\s+"), lambda x: x != "")
    rows = text.select(F.regexp_extract("value", r"^([^(]+)", 1).alias("grp"), F.explode(members).alias("m"))
    return rows.select("grp", F.regexp_extract("m", r"^([^(]+)", 1).alias("gene"), F.nullif(F.regexp_extract("m", r"\(([^)]*)\)$", 1), F.lit("")).alias("species"))


def keyed_table(spark: SparkSession, path: str, names: list[str], **types: str) -> DataFrame:
    """Tab-separated table of named columns: names, sizes, protein quality, scores."""
    return _typed(_fields(spark, path, names), **types).drop("n_fields")


def key_values(spark: SparkSession, path: str) -> DataFrame:
    """(gene, source, key, value) from lines: gene [source] key=value ..."""
    parts = F.filter(F.split("value", r"\s+"), lambda x: x != "")
    rows = spark.read.text(path).where(~F.col("value").rlike(r"^\s*(#|$)")).select(parts.alias("p"))
    plain = F.get("p", 1)
    rows = rows.select(F.get("p", 0).alias("gene"), F.when(~plain.contains("="), plain).alias("source"), F.explode(F.filter("p", lambda x: x.contains("="))).alias("kv"))
    return rows.select("gene", "source", F.substring_index("kv", "=", 1).alias("key"), F.regexp_replace("kv", "^[^=]*=", "").alias("value"))


def config(lines: list[str]) -> dict[str, dict[str, list[str]]]:
    """group -> key -> values from 'group name', 'key value', '+ more', 'end' lines; # starts a comment."""
    out: dict[str, dict[str, list[str]]] = {}
    group, key = None, None
    for raw in lines:
        line = raw.split("#", 1)[0].strip()
        if not line:
            continue
        first, _, rest = line.partition(" ")
        if first == "end":
            group = key = None
        elif group is None:
            group = out.setdefault(rest.strip() or first, {})
        elif first == "+" and key is not None:
            group[key].append(rest.strip())
        else:
            key = first
            group.setdefault(key, []).append(rest.strip())
    return out
