"""Vector and gap trimming of transcripts, their reading frames carried through the cuts.

Vector hits of a transcript become disjoint spans by a union. What is left is put together twice, plainly and with a short gap of the
span's phase in each cut's place; unknown bases at and near the ends go; the variant with the longer frame stays.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .intervals import islands
from .repair import best_orf, unknown_head


def vector_spans(hits: DataFrame) -> DataFrame:
    """Disjoint spans per id: id, begin, end, kind (of the first hit in each). hits: id, begin, end, kind; weak and impossible ones are left out."""
    sound = hits.where(~F.lower("kind").contains("weak") & (F.col("begin") >= 1) & (F.col("end") >= F.col("begin"))).select("id", "begin", "end", "kind")
    rows = islands(sound, ["id"], gap=-1).groupBy("id", "island")
    return rows.agg(F.min("begin").alias("begin"), F.max("end").alias("end"), F.min(F.struct("begin", "end", "kind"))["kind"].alias("kind")).drop("island")


def edits(seq: str, spans: list[tuple], cds: tuple[int, int] | None) -> list[tuple]:
    """The spans to cut, the start codon of the frame being kept: a span that touches it but leaves some of the frame falls in two."""
    out = []
    for b, e in spans:
        e = min(e, len(seq))
        if cds and seq[cds[0] - 1 : cds[0] + 2] == "ATG" and e >= cds[0] and b <= cds[0] + 2 and not (b <= cds[0] and e >= cds[1]):
            out += [(x, y) for x, y in ((b, cds[0] - 1), (cds[0] + 3, e)) if x <= y]
        elif b <= e:
            out.append((b, e))
    return out


def applied(seq: str, cuts: list[tuple], fill: bool) -> tuple[str, list[tuple]]:
    """seq without the cuts, or with three to five N in each one's place, and its runs: (place in the new, place in the old, length)."""
    text, runs, at = "", [], 0
    for b, e in [*cuts, (len(seq) + 1, len(seq))]:
        if b - 1 > at:
            runs.append((len(text), at, b - 1 - at))
            text += seq[at : b - 1]
        if fill and b <= len(seq):
            text += "N" * (3 + (e - b + 1) % 3)
        at = e
    head = unknown_head(text)
    tail = unknown_head(text[head:][::-1])
    stop, kept = len(text) - tail, []
    for new, old, n in runs:
        lo, hi = max(new, head), min(new + n, stop)
        if lo < hi:
            kept.append((lo - head, old + lo - new, hi - lo))
    return text[head:stop], kept


def carried(runs: list[tuple], begin: int, end: int) -> tuple[int, int] | None:
    """Where the bases begin..end (from 1, closed) of the old sequence lie in the new one: first and last of those that are left."""
    left = [(new + max(begin - 1, old) - old + 1, new + min(end, old + n) - old) for new, old, n in runs if max(begin - 1, old) < min(end, old + n)]
    return (left[0][0], left[-1][1]) if left else None


def trimmed_row(seq: str | None, spans: list[tuple], cds: tuple[int, int] | None) -> dict:
    """One transcript: see trim_transcripts."""
    seq = (seq or "").upper()
    cuts = edits(seq, spans, cds)
    text, runs = applied(seq, cuts, False)
    frame, how = best_orf(text), "plain"
    old = (cds[1] - cds[0] + 1) // 3 if cds else 0
    if cuts and text and frame[5] < old:
        other, other_runs = applied(seq, cuts, True)
        found = best_orf(other)
        known = lambda f: f[5] - (f[5] - f[0]) // 3  # noqa: E731  amino acids that aren't unknown
        if len(other) > len(text) and known(found) > frame[5]:
            text, runs, frame, how = other, other_runs, found, "gapped"
    held = carried(runs, *cds) if cds else None
    gone = len(seq) - sum(n for _, _, n in runs)
    state = "allcut" if not text else "uncut" if text == seq else how
    return {
        "seq": text, "state": state, "cut": gone, "in_frame": (cds[1] - cds[0] + 1 - sum(max(0, min(cds[1], o + n) - max(cds[0] - 1, o)) for _, o, n in runs)) if cds else 0,
        "held_begin": held and held[0], "held_end": held and held[1], "frame_begin": frame[2] + 1 if frame[5] else None, "frame_end": frame[3] if frame[5] else None, "kind": frame[4] or None, "aa": frame[5],
    }


_ROW = "struct<seq: string, state: string, cut: long, in_frame: long, held_begin: long, held_end: long, frame_begin: long, frame_end: long, kind: string, aa: long>"


def trim_transcripts(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """rows (id, seq, cds_begin, cds_end) trimmed: id, seq, state, cut, in_frame, held_begin, held_end, frame_begin, frame_end, kind, aa.

    spans: vector_spans. cut: bases taken out, in_frame of them in the frame given. held: where what is left of that frame lies now; frame,
    kind and aa: the longest frame of the result. state: uncut, plain, gapped (N in place of the cuts makes the longer frame), allcut.
    A start codon under a span stays unless the span covers the whole frame. Null sequences are empty ones.
    """
    names = [f.split(":")[0].strip() for f in _ROW[7:-1].split(",")]

    def run(seq: pd.Series, begins: pd.Series, ends: pd.Series, first: pd.Series, last: pd.Series) -> pd.DataFrame:
        out = []
        for s, b, e, f, t in zip(seq, begins, ends, first, last):
            cds = (int(f), int(t)) if pd.notna(f) and pd.notna(t) and 0 < f <= t else None
            out.append(trimmed_row(s, list(zip(b.tolist(), e.tolist())) if b is not None else [], cds))
        kinds = {n: "Int64" for n in names if n not in ("seq", "state", "kind")}
        return pd.DataFrame(out, columns=names).astype(kinds)

    lists = spans.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("s"))
    held = rows.select("id", "seq", "cds_begin", "cds_end").join(lists, "id", "left")
    return held.select("id", F.pandas_udf(run, _ROW)("seq", "s.begin", "s.end", "cds_begin", "cds_end").alias("r")).select("id", "r.*")
