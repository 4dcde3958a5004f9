"""Protein names: cleaning, confidence marks, identifiers, cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "Uncharacterized protein"
# Stock phrases that say nothing, and words of transposable elements.
EMPTY_NAMES = ("hypothetical protein", "predicted protein", "unknown protein", "unnamed protein product", "uncharacterized protein", "putative protein", "conserved hypothetical protein")
TE_WORDS = ("transposon", "transposase", "retrotransposon", "reverse transcriptase", "gag-pol", "gypsy", "copia", "integrase", "polyprotein")

#: Pattern and replacement, applied in this order.
RULES = (
    (r"\s+", " "),
    (r"(?i)\bhomologue\b", "homolog"),
    (r"(?i)\btumour\b", "tumor"),
    (r"(?i)\bhaem", "hem"),
    (r"(?i)\bsulph", "sulf"),
    (r"(?i)^(?:similar to|predicted:?|putative|probable)\s+", ""),
    (r"(?i),?\s*(?:isoform|transcript variant)\s+\w+$", ""),
    (r"(?i)\s*\((?:fragment|partial|ec [\d.-]+)\)", ""),
    (r"\s*\[[^\]]*\]$", ""),
    (r"^[\s,;:.-]+|[\s,;:-]+$", ""),
)


def is_te(name: Column) -> Column:
    return F.lower(name).rlike("|".join(TE_WORDS))


def cleaned(name: Column) -> Column:
    """A name without spelling variants, tags and empty phrases; nothing left gives the unknown name."""
    out = F.trim(F.coalesce(name, F.lit("")))
    for pattern, to in RULES:
        out = F.regexp_replace(out, pattern, to)
    unbalanced = F.length(F.translate(out, "(", "")) != F.length(F.translate(out, ")", ""))
    out = F.when(unbalanced, F.translate(out, "()", "")).otherwise(out)
    return F.when((F.length(out) < 3) | F.lower(out).isin(*EMPTY_NAMES), UNKNOWN).otherwise(out)


def graded(name: Column, percent: Column, low: int = 33, likely: int = 66) -> Column:
    """Cleaned name by identity to its reference: unknown below low, '-like' below likely, TE names marked."""
    clean = cleaned(name)
    out = F.when(percent < low, F.lit(UNKNOWN)).when((percent < likely) & (clean != UNKNOWN) & ~clean.rlike("(?i)-like|domain"), F.concat(clean, F.lit("-like protein"))).otherwise(clean)
    return F.when(is_te(name) & (percent >= low), F.concat(F.lit("TE: "), clean)).otherwise(out)


def species_prefix(id_: Column) -> Column:
    """What stands before the first ':' or '|', else the leading letters."""
    return F.when(id_.rlike("[:|]"), F.regexp_extract(id_, r"^([^:|]*)", 1)).otherwise(F.regexp_extract(id_, r"^([A-Za-z]*)", 1))


def gene_of(id_: Column) -> Column:
    """A transcript id without its alternate suffix t<number>."""
    return F.regexp_replace(id_, r"t\d+$", "")


def public_id(prefix: str, gene: Column, alt: Column) -> Column:
    """prefix, six digits of the gene number, t and the alternate's number."""
    return F.concat(F.lit(prefix), F.lpad(gene.cast("string"), 6, "0"), F.lit("t"), alt.cast("string"))


def recased(names: DataFrame) -> DataFrame:
    """(lower, name, n): the most frequent spelling of each name regardless of case, ties to the smaller."""
    each = names.groupBy(F.lower("name").alias("lower"), "name").agg(F.count("*").alias("c"))
    return each.groupBy("lower").agg(F.min_by("name", F.struct(-F.col("c"), "name")).alias("name"), F.sum("c").alias("n"))


def short_list(ids: Column, most: int = 20) -> Column:
    """Ids joined by commas; beyond most, the rest as '..n'."""
    rest = F.size(ids) - most
    return F.when(rest > 0, F.concat(F.array_join(F.slice(ids, 1, most), ","), F.lit(",.."), rest.cast("string"))).otherwise(F.array_join(ids, ","))
