"""Line dedup by an exact set-similarity self-join, with DataFrame functions alone.

A line is the set of its words. Words are ordered from rare to frequent by a fixed-size count sketch over all
documents, ties by hash. Lines with equal sets collapse into the earliest. Of each set the first words of that
order are kept, as many as the threshold demands (prefix filter); lines that share one are candidates unless their
sizes, the word's places (length and positional filters, applied to a block's entries before they are paired) or 128 parity bits of their words, which bound from below
how many words only one of them holds, rule them out. Jaccard is verified on whole sets.

A line is removed when an earlier one (by doc_id, then line number) reaches the threshold, removed itself or not.
Candidates are verified in two passes, so that a large group of near copies costs its size and not its square:
first against one earliest line of about its size in a block, then, for lines still unmatched, against all that share a block.

Defined results: a null text has no lines; blank lines stay and match nothing; all others take part, however
short (equal sets collapse, so a frequent short line costs one entry a block); repeated rows of one doc_id don't
count against each other; rows of one doc_id with different texts are taken as one document, and where both have a
line of one number the one that sorts first is verified; a row with a null doc_id loses nothing; an empty table gives
none; other columns are kept by apply and ignored here.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, maybe_in, stored

#: log2 of the sketch's counters: fixed, 1 MB, whatever the corpus holds.
SKETCH_BITS = 20


def _let(value: Column, body) -> Column:
    """body(value) with value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _spaced(text: Column) -> Column:
    """text with plain spaces for the other spaces that part words, the line feed apart: one-character splits are quick."""
    for space in "\t\x0b\f\r":
        text = F.replace(text, F.lit(space), F.lit(" "))
    return text


def _hashes(line: Column) -> Column:
    """Hashes of a spaced line's words; equal words once. The empty parts around words are no words."""
    return F.array_remove(F.array_distinct(F.transform(F.split(line, " "), lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def _bucket(h: Column) -> Column:
    return F.shiftrightunsigned(h, 64 - SKETCH_BITS).cast("int")


def _sketch(docs: DataFrame) -> DataFrame:
    """One row: per counter, how often its words occur, as a place on a logarithmic scale from 0 to 126."""
    text = F.replace(_spaced(F.col("text")), F.lit("\n"), F.lit(" "))
    word = docs.select(F.explode(F.split(text, " ")).alias("w")).select(_bucket(F.xxhash64("w")).alias("b"))
    counts = word.groupBy("b").agg(F.count("*").alias("c"))
    scale = F.least(F.lit(126), F.floor(F.log2(F.col("c") + 1) * 3)).cast("int")
    counts = counts.select("b", scale.alias("c")).unionByName(docs.sparkSession.range(1 << SKETCH_BITS).select(F.col("id").cast("int").alias("b"), F.lit(0).alias("c")))
    dense = counts.groupBy("b").agg(F.max("c").alias("c"))
    return dense.groupBy().agg(F.transform(F.sort_array(F.collect_list(F.struct("b", "c"))), lambda x: x["c"].cast("byte")).alias("sketch"))


def _ordered(lines: DataFrame, sketch: DataFrame) -> DataFrame:
    """Adds tokens: a line's distinct words as numbers whose order is rare first, then hash."""
    # _sketch, one bounded row, is named once only: the optimiser then reads it in place and no row carries a copy
    # a key that can't be null lets sort_array sort plain longs
    scale = lambda h: F.coalesce(F.get("_sketch", _bucket(h)), F.lit(0).cast("byte"))
    key = lambda h: F.shiftleft(scale(h).cast("long"), 56).bitwiseOR(F.shiftrightunsigned(h, 8))
    tokens = F.sort_array(F.transform(_hashes(F.col("line")), key)).alias("tokens")
    own = [c for c in lines.columns if c != "line"]
    rows = lines.select("*", sketch.scalar().alias("_sketch")).select(*own, tokens)
    # exploding one array a row keeps filters and further columns from working it out anew
    return rows.select(*own, F.explode(F.array("tokens")).alias("tokens"))


def _parity(tokens: str, half: int) -> Column:
    """64 of a line's 128 bits: each tells whether an odd number of words falls on it; shared words cancel out in a XOR."""
    bit = lambda t: F.call_function("shiftleft", F.lit(1).cast("long"), t.bitwiseAND(63).cast("int"))
    fold = lambda a, t: F.when(t.bitwiseAND(64) == 64 * half, a.bitwiseXOR(bit(t))).otherwise(a)
    return F.aggregate(tokens, F.lit(0).cast("long"), fold)


def _lines(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.posexplode(F.split(_spaced(F.col("text")), "\n")).alias("line_no", "line"))


def _alike(early: str, late: str, percent: int) -> Column:
    """What parity bits allow: each bit that differs stands for a word that only one of the lines holds."""
    both = F.col(f"{early}.size") + F.col(f"{late}.size")
    apart = F.bit_count(F.col(f"{early}.even").bitwiseXOR(F.col(f"{late}.even"))) + F.bit_count(F.col(f"{early}.odd").bitwiseXOR(F.col(f"{late}.odd")))
    return (100 + percent) * (both - apart) >= 2 * percent * both


def _bounded(early: str, late: str, percent: int) -> Column:
    """What sizes, places and parity bits allow if the word is the first in the common order that both lines hold."""
    size_a, size_b, at_a, at_b = (F.col(f"{x}.{c}") for c in ("size", "at") for x in (early, late))
    return ((100 + percent) * F.least(size_a - at_a, size_b - at_b) >= percent * (size_a + size_b)) & _alike(early, late, percent)


def _exploded(classes: DataFrame) -> DataFrame:
    """One row for each word of a prefix, with its place."""
    return classes.select("doc_id", "line_no", "size", "even", "odd", F.posexplode("prefix").alias("at", "word"))


_PAIR = ("a_doc_id", "a_line_no", "b_doc_id", "b_line_no")


def _blocks(classes: DataFrame, percent: int) -> DataFrame:
    """Prefix entries that another of their word may match, each with the earliest of its word and about its size if that may match."""
    # reach: percent times the largest size of a line that may match by sizes and places. A partner of at most the entry's
    # size reaches it, and one of at least its size is reached by it, so that pairs that fit keep both their entries
    reach = (100 + percent) * (F.col("size") - F.col("at")) - percent * F.col("size")
    rows = _exploded(classes).repartition("word").withColumn("about", F.floor(F.log2("size") * 6)).withColumn("reach", reach)
    # both windows follow the one order of word, about and size
    column = Window.partitionBy("word").orderBy("about", "size")
    before = F.max("reach").over(column.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.select("*", before.alias("before"), F.lead("size").over(column).alias("above"))
    rows = rows.where(F.coalesce(F.col("before") >= percent * F.col("size"), F.lit(False)) | F.coalesce(percent * F.col("above") <= F.col("reach"), F.lit(False)))
    group = Window.partitionBy("word", "about").orderBy("size").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("head", F.min(F.struct("doc_id", "line_no", "size", "at", "even", "odd")).over(group))
    earlier = F.struct("head.doc_id", "head.line_no") < F.struct("e.doc_id", "e.line_no")
    fits = earlier & _bounded("head", "e", percent)
    heads = [F.when(fits, F.col(f"head.{c}")).alias(f"head_{c}") for c in ("doc_id", "line_no")]
    return rows.alias("e").select("word", "e.doc_id", "e.line_no", "e.size", "e.at", "e.even", "e.odd", *heads)


def _head_pairs(entries: DataFrame) -> DataFrame:
    """Each line with the block leader it shares most blocks with."""
    pair = [F.col(c).alias(to) for c, to in zip(("head_doc_id", "head_line_no", "doc_id", "line_no"), _PAIR)]
    rows = entries.where("head_doc_id is not null").select(*pair).groupBy(*_PAIR).count()
    best = rows.groupBy("b_doc_id", "b_line_no").agg(F.min(F.struct(-F.col("count"), "a_doc_id", "a_line_no")).alias("x"))
    return best.select("x.a_doc_id", "x.a_line_no", "b_doc_id", "b_line_no")


_NEVER = -(1 << 63)


def _all_pairs(entries: DataFrame, matched: DataFrame, percent: int) -> DataFrame:
    """Pairs of an unmatched line and an earlier one that sizes, places of a shared word and parity bits allow."""
    entries = entries.drop("head_doc_id", "head_line_no")
    key = ["doc_id", "line_no"]
    # until is the doc_id of a line that still needs a match, else before all ids; only entries that a bitmap can't
    # clear are joined for it
    maybe = maybe_in(matched, key)
    settled = entries.where(maybe).join(matched.select(*key, F.lit(True).alias("settled")), key, "left")
    settled = settled.withColumn("until", F.when(F.col("settled"), F.lit(_NEVER)).otherwise(F.col("doc_id"))).drop("settled")
    rows = settled.unionByName(entries.where(~maybe).withColumn("until", F.col("doc_id")))
    # both sides read both ids, so that one shuffle serves them: until is doc_id or less
    early = F.struct(F.greatest("x.doc_id", "x.until"), "x.line_no") < F.struct(F.least("y.doc_id", "y.until"), "y.line_no")
    rows = rows.alias("x").join(rows.alias("y"), (F.col("x.word") == F.col("y.word")) & early & _bounded("x", "y", percent))
    ends = [F.col(f"{x}.{c}").alias(f"{k}_{c}") for x, k in (("x", "a"), ("y", "b")) for c in key]
    return rows.select(*ends).distinct()


def _verified(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The later lines (doc_id, line_no) of the pairs that reach the threshold, by whole sets of words."""
    pairs = kept_pairs = stored(pairs, "pairs")
    key = ["doc_id", "line_no"]
    ends = F.explode(F.array(*[F.struct(F.col(f"{k}_doc_id").alias("doc_id"), F.col(f"{k}_line_no").alias("line_no")) for k in "ab"])).alias("x")
    wanted = stored(pairs.select(ends).select("x.*").distinct(), "wanted")
    # most documents have no such line and needn't be split
    lines = _lines(docs.where(maybe_in(wanted, ["doc_id"]))).where(maybe_in(wanted, key)).join(wanted, key)
    sets = stored(lines.groupBy(*key).agg(F.min("line").alias("line")), "lines")
    for k in "ab":
        pairs = pairs.join(sets.select(*[F.col(c).alias(f"{k}_{c}") for c in (*key, "line")]), [f"{k}_doc_id", f"{k}_line_no"])
    pairs = pairs.select("b_doc_id", "b_line_no", F.explode(F.array(F.struct(_hashes(F.col("a_line")).alias("a"), _hashes(F.col("b_line")).alias("b")))).alias("x"))
    same = F.size(F.array_intersect("x.a", "x.b"))
    found = pairs.where((100 + percent) * same >= percent * (F.size("x.a") + F.size("x.b")))
    found = stored(found.select(F.col("b_doc_id").alias("doc_id"), F.col("b_line_no").alias("line_no")).distinct(), "matched")
    for table in (sets, wanted, kept_pairs):
        dropped(table)
    return found


def removed_lines(docs: DataFrame, percent: int = 80, least: int = 1) -> DataFrame:
    """One row a document: doc_id, n_lines, n_removed and removed, the numbers (from 0) of the lines that go.

    Lines with fewer than least words take no part.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sketch = stored(_sketch(docs), "sketch")
    size = F.size("tokens")
    # blocks need no more than 31 bits of a word: others that share them only add candidates
    kept = F.slice("tokens", 1, (size - F.ceil(percent * size / 100) + 1).cast("int"))
    prefix = F.transform(kept, lambda t: (t.bitwiseXOR(F.shiftrightunsigned(t, 32)).bitwiseAND(0x7FFFFFFF)).cast("int"))
    lines = _ordered(_lines(docs), sketch).where(size >= least).select(
        "doc_id", "line_no", size.alias("size"), F.xxhash64("tokens").alias("s1"), F.xxhash64("tokens", F.lit(1)).alias("s2"), prefix.alias("prefix"), *[_parity("tokens", half).alias(c) for half, c in enumerate(("even", "odd"))]
    )
    lines = stored(lines, "prefixes")
    dropped(sketch)
    same = ["s1", "s2", "size"]
    classes = lines.groupBy(*same).agg(F.count("*").alias("lines"), F.min(F.struct("doc_id", "line_no", "prefix", "even", "odd")).alias("first"))
    classes = stored(classes.select(*same, "lines", "first.*"), "classes")
    # all but the first line of a class go, whatever else is found
    several = stored(classes.where("lines > 1").select(*same, F.col("doc_id").alias("first_doc"), F.col("line_no").alias("first_line")), "several")
    own = (F.col("doc_id") == F.col("first_doc")) & (F.col("line_no") == F.col("first_line"))
    copies = stored(lines.drop("prefix", "even", "odd").where(maybe_in(several, same)).join(several, same).where(~own).select("doc_id", "line_no"), "copies")
    dropped(lines)

    entries = stored(_blocks(classes, percent), "blocks")
    dropped(classes)
    matched = _verified(_head_pairs(entries), docs, percent)
    gone = copies.union(matched).union(_verified(_all_pairs(entries, matched, percent), docs, percent))
    dropped(entries)

    gone = gone.groupBy("doc_id").agg(F.sort_array(F.collect_set("line_no")).alias("removed"))  # within one document
    n_lines = F.octet_length("text") - F.octet_length(F.replace(F.col("text"), F.lit("\n"), F.lit(""))) + 1
    counted = docs.select("doc_id", F.coalesce(n_lines, F.lit(0)).cast("long").alias("n_lines"))
    out = counted.join(gone, "doc_id", "left").withColumn("removed", F.coalesce("removed", F.array().cast("array<int>")))
    return out.select("doc_id", "n_lines", F.size("removed").cast("long").alias("n_removed"), "removed")


def apply(docs: DataFrame, percent: int = 80, least: int = 1) -> DataFrame:
    """docs with removed lines taken out of text. Every column and row stays; a null text stays null."""
    # one struct holds all of a row, so that no column of docs can clash with what is joined
    gone = removed_lines(docs, percent, least).where("n_removed > 0").groupBy("doc_id").agg(F.first("removed").alias("removed"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.struct(*docs.columns).alias("row")).join(gone, "doc_id", "left")

    def kept(parts: Column) -> Column:
        numbers = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("removed"))
        return F.array_join(F.transform(numbers, lambda i: F.get(parts, i)), "\n")

    text = F.when(F.col("removed").isNull(), F.col("row.text")).otherwise(_let(F.split("row.text", "\n"), kept))
    return rows.select(*[text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in docs.columns])
