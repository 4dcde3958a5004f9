"""Quality rules with thresholds from mergeable quantile sketches, by DataFrame functions alone.

Every document gets counts from its words and lines. Quantile sketches of its ratios and of its words are kept per
(language, source): counts by buckets of geometric width, so that a quantile is right to a quarter percent. They merge by adding
counts, whatever the order, so reruns and recomputed stages agree. Sketches of a language merge from those of its sources,
and all merge into one. Thresholds come from a group's quantiles alone: a language with long words or a source full of tables sets its own bounds. They allow
for chance: mean word length may stray further in a text of few words, and a count may pass the group's quantile by
some of its own deviations. Groups with few documents take the language's sketch, then the overall one.

Defined results: a null or blank text has no words and fails the base rule; null languages and sources are groups
of their own; repeated rows are judged one by one; an empty table gives none; other columns may be carried.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored, words

#: Ratios of counts to words or lines, with what a single chance event adds to the count: a repeat is two windows.
COUNTS = {"symbol_ratio": 1, "dup_line_ratio": 1, "repeat_ratio": 10}
SKETCHED = ("mean_word", "n_words", *COUNTS)
_WINDOW = 5


def _repeat_words(hashes: Column) -> Column:
    """Words inside 5-word windows that occur twice or more, the first included.

    Hashes of windows are sorted with their places; windows next to an equal one are marked; then each marked
    place adds the words up to the next marked place, five at most. n log n in the words of a text.
    """
    windows = F.transform(
        F.sequence(F.lit(1), F.size(hashes) - (_WINDOW - 1)),
        lambda i: F.xxhash64(*[F.get(hashes, i + (j - 1)) for j in range(_WINDOW)]),
    )

    def marked(w: Column) -> Column:
        placed = F.sort_array(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def same(p: Column) -> Column:
            at = F.sequence(F.lit(0), F.size(p) - 1)
            twin = F.filter(
                at,
                lambda i: (F.get(p, i)["h"] == F.get(p, i + 1)["h"]) | ((i > 0) & (F.get(p, i)["h"] == F.get(p, i - 1)["h"])),
            )
            return F.sort_array(F.transform(twin, lambda i: F.get(p, i)["i"]))

        def covered(m: Column) -> Column:
            steps = F.transform(m, lambda x, i: F.least(F.lit(_WINDOW), F.coalesce(F.get(m, i + 1) - x, F.lit(_WINDOW))))
            return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

        return _let(_let(placed, same), covered)

    def count(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) < F.size(w), marked(w)).otherwise(F.lit(0))

    return F.when(F.size(hashes) > _WINDOW, _let(windows, count)).otherwise(F.lit(0)).cast("long")


def _let(value: Column, body) -> Column:
    """body(value) with value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def measured(docs: DataFrame, columns: tuple = ()) -> DataFrame:
    """doc_id, lang, source, the base counts and ratios, then the named columns."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    own = [c for c in columns if c not in ("doc_id", "lang", "source")]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        # exploding one array a row keeps filters above from being worked into the lambdas below
        F.explode(F.array(F.transform(words(text), lambda w: F.xxhash64(w)))).alias("_words"),
        F.length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        _let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        _let(lines, F.size).cast("long").alias("_lines"),
        *[F.col(c) for c in own],
    )
    rows = rows.select(
        "doc_id", "lang", "source", F.size("_words").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        F.explode(F.array(_repeat_words(F.col("_words")))).alias("n_repeat_words"), "_lines", *own,
    )
    some = F.greatest(F.col("n_words"), F.lit(1))
    return rows.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", F.col("_lines").alias("n_lines"),
        ((F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))).alias("base_failed"),
        (F.col("word_chars") / some).alias("mean_word"),
        (F.col("n_symbols") / some).alias("symbol_ratio"),
        (F.col("n_dup_lines") / F.greatest(F.col("_lines"), F.lit(1))).alias("dup_line_ratio"),
        (F.col("n_repeat_words") / some).alias("repeat_ratio"),
        *own,
    )


#: Ratio of the borders of a bucket.
_GAMMA = 1.005
#: Name, measure and quantile of each fence: quartiles of mean word length, the median number of words, the ninth tenth of each ratio.
_QUANTILES = (("word_low", "mean_word", 0.25), ("word_high", "mean_word", 0.75), ("words_mid", "n_words", 0.5), *((c, c, 0.9) for c in COUNTS))


def _bucket(value: Column) -> Column:
    """The number of a value's bucket; null for 0, whose bucket is its own and the first."""
    return F.when(value > 0, F.ceil(F.log(value) / F.lit(math.log(_GAMMA)))).cast("int")


def _middle(bucket: Column) -> Column:
    return F.when(bucket.isNull(), F.lit(0.0)).otherwise(F.pow(F.lit(_GAMMA), bucket) * (2 / (1 + _GAMMA)))


def _fences(cells: DataFrame, keys: list[str]) -> DataFrame:
    """keys, n and fences of each group. cells: keys, measure, bucket, n."""
    merged = cells.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    order = Window.partitionBy(*keys, "measure").orderBy(F.col("bucket").asc_nulls_first())  # as many rows as buckets
    whole = Window.partitionBy(*keys, "measure")
    merged = merged.withColumn("upto", F.sum("n").over(order)).withColumn("all", F.sum("n").over(whole))
    at = lambda measure, p: F.min(F.when((F.col("measure") == measure) & (F.col("upto") >= p * F.col("all")), _middle(F.col("bucket"))))
    found = merged.groupBy(*keys).agg(F.max("all").alias("n"), *[at(m, p).alias(name) for name, m, p in _QUANTILES])
    return stored(found.select(*keys, "n", F.struct(*[q[0] for q in _QUANTILES]).alias("fences")), "fences")


def _inside(reach: float) -> Column:
    """Whether a document lies within its group's fences."""
    fence = lambda c: F.col(f"fences.{c}")
    n = F.greatest(F.col("n_words"), F.lit(1))
    # the mean of n words strays by the root of 1 / n: short texts get a wider fence than the group's middle one
    wide = reach * (fence("word_high") - fence("word_low")) * F.greatest(F.lit(1.0), F.sqrt(fence("words_mid") / n))
    inside = F.col("mean_word").between(fence("word_low") - wide, fence("word_high") + wide)
    for (c, unit), base in zip(COUNTS.items(), (n, F.greatest(F.col("n_lines"), F.lit(1)), n)):
        usual = fence(c) * base
        inside &= F.col(c) * base <= usual + reach * F.sqrt(unit * F.greatest(usual, F.lit(float(unit))))
    return inside


def thresholds(rows: DataFrame, enough: int = 200) -> DataFrame:
    """One row a (language, source): its fences, from the smallest enclosing group with enough documents.

    Only documents that pass the base rule are sketched.
    """
    key = [F.coalesce(F.concat(F.lit("="), c), F.lit("")).alias(f"{c}_key") for c in ("lang", "source")]
    good = rows.where(~F.col("base_failed")).select(*key, *SKETCHED)
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("measure"), _bucket(F.col(r).cast("double")).alias("bucket")) for r in SKETCHED]))
    cells = good.select("lang_key", "source_key", each.alias("x")).groupBy("lang_key", "source_key", "x.measure", "x.bucket").agg(F.count("*").alias("n"))
    cells = stored(cells, "sketches")  # at most some thousand rows a group and measure
    fine = _fences(cells, ["lang_key", "source_key"])
    by_lang = _fences(cells, ["lang_key"])
    overall = _fences(cells.withColumn("one", F.lit(1)), ["one"])
    groups = rows.select(*key).distinct().withColumn("one", F.lit(1))  # counts are pruned away here: only the two columns are read
    pick = lambda df, keys, to: df.where(F.col("n") >= enough).select(*keys, F.col("fences").alias(to))
    groups = (
        groups.join(pick(fine, ["lang_key", "source_key"], "f1"), ["lang_key", "source_key"], "left")
        .join(pick(by_lang, ["lang_key"], "f2"), "lang_key", "left")
        .join(overall.select("one", F.col("fences").alias("f3")), "one", "left")
    )
    return stored(groups.select("lang_key", "source_key", F.coalesce("f1", "f2", "f3").alias("fences")), "bounds")


def judge(docs: DataFrame, columns: tuple = (), reach: float = 6.0, enough: int = 200) -> DataFrame:
    """doc_id, counts, base_failed and kept, then the named columns."""
    narrow = stored(measured(docs), "measured")
    bounds = thresholds(narrow, enough)
    rows = measured(docs, columns) if columns else narrow
    rows = rows.withColumns({f"{c}_key": F.coalesce(F.concat(F.lit("="), c), F.lit("")) for c in ("lang", "source")})
    # one row a group of language and source, whose number the catalogue of sources bounds; Spark checks its size
    return rows.join(bounds, ["lang_key", "source_key"], "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(_inside(reach), F.lit(True))).alias("kept"),
        *[c for c in columns if c != "doc_id"],
    )
