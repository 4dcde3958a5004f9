"""Sequence records of flat files: features with the spans of their places, their qualifiers, and their bases.

The text reader splits at the line that ends a record, so that files split over tasks and a row is a record. A small helper takes one
record apart; a place is read by recursive descent. A record that can't be read is one row that says why; the others go on.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspan.functions.sequences import reverse_complement

_FEATURE = (
    "array<struct<type: string, place: string, spans: array<struct<ref: string, begin: long, end: long, strand: string>>, "
    "open_left: boolean, open_right: boolean, qualifiers: array<struct<key: string, value: string>>, error: string>>"
)
_RECORD = f"struct<accession: string, version: string, length: long, molecule: string, definition: string, organism: string, features: {_FEATURE}, seq: string, error: string>"
_TOKEN = re.compile(r"\s*(join|order|bond|one-of|complement|gap|[A-Za-z0-9_.]+:|[<>]?\d+|\.\.|[\^.,()]|\S)")


class _Place:
    """Reads a place from the left: name(place, ...), [record:]begin..end, begin^end or a single base."""

    def __init__(self, text: str):
        self.tokens, self.at, self.open = [t for t in _TOKEN.findall(text)], 0, [False, False]

    def next(self, *wanted: str) -> str:
        if self.at >= len(self.tokens) or (wanted and self.tokens[self.at] not in wanted):
            raise ValueError(f"place: {' or '.join(wanted) or 'more'} expected after {''.join(self.tokens[: self.at])!r}")
        self.at += 1
        return self.tokens[self.at - 1]

    def peek(self) -> str:
        return self.tokens[self.at] if self.at < len(self.tokens) else ""

    def number(self, right: bool = False) -> int:
        text = self.next()
        if text[0] in "<>":
            self.open[right] = True
            text = text[1:]
        if not text.isdigit():
            raise ValueError(f"place: number expected, not {text!r}")
        return int(text)

    def read(self) -> list[tuple]:
        """Spans (record, begin, end, strand) in the order of reading: those of a complement turn about and come in reverse."""
        name = self.peek()
        if name in ("join", "order", "bond", "one-of"):
            self.next()
            self.next("(")
            out = self.read()
            while self.next(",", ")") == ",":
                out += self.read()
            return out
        if name == "complement":
            self.next()
            self.next("(")
            out = self.read()
            self.next(")")
            return [(r, b, e, "-" if s == "+" else "+") for r, b, e, s in out[::-1]]
        record = self.next()[:-1] if name.endswith(":") else None
        begin = self.number()
        end = begin
        if self.peek() in ("..", "^", "."):
            self.next()
            end = self.number(True)
        if end < begin:
            raise ValueError(f"place: {begin}..{end} runs backwards")
        return [(record, begin, end, "+")]


def read_place(text: str) -> tuple[list[tuple], bool, bool]:
    """Spans of a place, and whether it goes on beyond its left and right end."""
    place = _Place(text)
    spans = place.read()
    if place.peek():
        raise ValueError(f"place: {place.peek()!r} is left over")
    return spans, *place.open


def _qualifiers(text: str) -> list[tuple]:
    """(key, value) of /key, /key=value and /key="value", where a doubled quote stands for one; values may run over lines."""
    out = []
    for found in re.finditer(r'/([\w-]+)(?:=("(?:[^"]|"")*"|[^\n]*))?(?=\n|$)', text):
        key, value = found.groups()
        if value is not None and value.startswith('"'):
            value = value[1:-1].replace('""', '"')
            value = re.sub(r"\s*\n\s*", "" if key == "translation" else " ", value)
        out.append((key, value))
    return out


def _feature(kind: str, text: str) -> dict:
    place, _, rest = re.sub(r"\n\s+", "\n", text).partition("\n/")
    place = re.sub(r"\s+", "", place)
    out = {"type": kind, "place": place, "spans": None, "open_left": None, "open_right": None, "qualifiers": [{"key": k, "value": v} for k, v in _qualifiers("/" + rest if rest else "")], "error": None}
    try:
        spans, left, right = read_place(place)
        out |= {"spans": [dict(zip(("ref", "begin", "end", "strand"), s)) for s in spans], "open_left": left, "open_right": right}
    except ValueError as fault:
        out["error"] = str(fault)
    return out


def read_record(text: str) -> dict:
    """One record as a dict of _RECORD's fields; error is set where what must be there is missing or bases don't add up."""
    field = lambda name: re.sub(r"\s+", " ", m[1]).strip() if (m := re.search(rf"^{name}\b(.*(?:\n[ ]{{3,}}.*)*)", text, re.M)) else None
    locus = (field("LOCUS") or "").split()
    organism = re.search(r"^  ORGANISM +(.*)$", text, re.M)
    head, _, body = text.partition("\nORIGIN")
    table = re.search(r"^FEATURES.*\n((?:[ ]{5}.*(?:\n|$))*)", head, re.M)
    features = []
    if table:
        for found in re.finditer(r"^ {5}(\S+) +(.*(?:\n {6,}.*)*)", table[1], re.M):
            features.append(_feature(found[1], found[2]))
    seq = re.sub(r"[^A-Za-z]", "", body.partition("\n")[2]).upper() or None
    length = next((int(a) for a, b in zip(locus[1:], locus[2:]) if a.isdigit() and b in ("bp", "aa", "rc")), None)
    error = None
    if not locus:
        error = "no LOCUS line"
    elif length is None:
        error = "no length in the LOCUS line"
    elif seq is not None and len(seq) != length:
        error = f"{len(seq)} bases, where LOCUS says {length}"
    accession = (field("ACCESSION") or "").split() or locus[:1]
    return {
        "accession": accession[0] if accession else None, "version": (field("VERSION") or " ").split(" ")[0] or None, "length": length, "molecule": locus[3] if len(locus) > 3 else None,
        "definition": field("DEFINITION"), "organism": organism[1].strip() if organism else None, "features": features, "seq": seq, "error": error,
    }


def records(spark: SparkSession, path: str) -> DataFrame:
    """One row a record: accession, version, length, molecule, definition, organism, features, seq, error."""

    def run(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([read_record(t) for t in texts], columns=["accession", "version", "length", "molecule", "definition", "organism", "features", "seq", "error"]).astype({"length": "Int64"})

    rows = spark.read.option("lineSep", "\n//").text(path)
    rows = rows.select(F.regexp_replace(F.regexp_replace("value", "\r", ""), r"^\s*\n", "").alias("value")).where(F.col("value").rlike(r"\S"))
    return rows.select(F.pandas_udf(run, _RECORD)("value").alias("r")).select("r.*")


def features(rows: DataFrame, kinds: tuple | None = None) -> DataFrame:
    """One row a feature of records(): accession, feature (number), type, place, spans, open_left, open_right, qualifiers (map, of repeated keys the first), error."""
    each = rows.select("accession", F.posexplode("features").alias("feature", "f"))
    each = each if kinds is None else each.where(F.col("f.type").isin(*kinds))
    keys = F.transform("f.qualifiers", lambda q: q["key"])
    first = F.filter("f.qualifiers", lambda q, i: F.array_position(keys, q["key"]) == i + 1)
    return each.select("accession", "feature", "f.type", "f.place", "f.spans", "f.open_left", "f.open_right", F.map_from_entries(first).alias("qualifiers"), "f.error")


def feature_sequence(seq: Column, spans: Column) -> Column:
    """The bases of a place on its own record, read in its order; null where it has spans on other records."""
    part = lambda s: seq.substr(s["begin"].cast("int"), (s["end"] - s["begin"] + 1).cast("int"))
    pieces = F.transform(spans, lambda s: F.when(s["strand"] == "-", reverse_complement(part(s))).otherwise(part(s)))
    return F.when(~F.exists(spans, lambda s: s["ref"].isNotNull()), F.array_join(pieces, ""))


def transcripts(rows: DataFrame) -> DataFrame:
    """One row a coding sequence: accession, gene, product, protein_id, protein, cds, complete and pcds (its percent of the record)."""
    each = rows.select("accession", "seq", "length", F.posexplode("features").alias("feature", "f")).where("f.type = 'CDS' and f.error is null")
    of = lambda key: F.get(F.filter("f.qualifiers", lambda q: q["key"] == key), 0)["value"]
    size = F.aggregate("f.spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["begin"] + 1)
    minus = F.get("f.spans", 0)["strand"] == "-"  # the right end of a reversed one is where it begins
    head, tail = (F.when(minus, F.col(a)).otherwise(F.col(b)) for a, b in (("f.open_right", "f.open_left"), ("f.open_left", "f.open_right")))
    word = F.when(head & tail, "partial").when(head, "partial5").when(tail, "partial3").otherwise("complete")
    return each.select(
        "accession", "feature", of("gene").alias("gene"), of("product").alias("product"), of("protein_id").alias("protein_id"), of("translation").alias("protein"),
        feature_sequence(F.col("seq"), F.col("f.spans")).alias("cds"), word.alias("complete"), F.floor(0.5 + 100 * size / F.col("length")).alias("pcds"),
    )
