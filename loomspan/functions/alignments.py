"""Column statistics of aligned coding sequences."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

_COUNTS = ("ds", "dn", "gp", "es", "en", "tn")
#: total and first, middle and last third: each with its counts; er is the longest run of equal columns.
_TYPE = "struct<" + ", ".join(f"{p}_{c}: long" for p in "tbme" for c in _COUNTS) + ", er: long, len1: long, len2: long>"


def _patterns(x: str | None, y: str | None) -> dict | None:
    """Counts of one pair of rows of an alignment; null for a missing row, rows of unlike length or fewer than two columns."""
    if x is None or y is None or len(x) != len(y):
        return None
    first, other = x.find("ATG"), y.find("ATG")
    start = max(first, 0)
    if 0 <= other < start:
        start = other
    a, b = (np.frombuffer(s[start:].encode("utf-32-le"), np.uint32) for s in (x, y))
    if len(a) < 2:
        return None
    n, dash, unknown = len(a), ord("-"), ord("N")
    gap1, gap2 = a == dash, (b == dash) & (a != dash)
    equal = (a == b) & ~gap1
    silent = ~(gap1 | gap2 | equal) & ((a == unknown) | (b == unknown))
    differ, third = ~(gap1 | gap2 | equal | silent), np.arange(n) % 3 == 2
    marks = {"ds": differ & third, "dn": differ & ~third, "gp": gap1 | gap2, "es": equal & third, "en": equal & ~third, "tn": ~silent}
    step = 1 + n // 3
    out = {f"{p}_{c}": int(m[lo:hi].sum()) for p, lo, hi in (("t", 0, n), ("b", 0, step), ("m", step, 2 * step), ("e", 2 * step, n)) for c, m in marks.items()}
    # unknown columns neither break a run of equal ones nor count in it
    told = equal[~silent]
    ends = np.flatnonzero(np.diff(np.concatenate([[False], told, [False]]).astype(np.int8)))
    out["er"] = int((ends[1::2] - ends[::2]).max(initial=0))
    return out | {"len1": int((~gap1).sum()), "len2": int((~gap2).sum())}


def alignment_patterns(x: Column, y: Column) -> Column:
    """Differences at third (ds) and other (dn) codon places, gaps (gp), equal columns (es, en), columns told (tn), er, len1, len2.

    x and y are rows of one alignment in upper case, gaps as '-', read from the first ATG of x, or of y if that lies before it.
    """

    def run(x: pd.Series, y: pd.Series) -> pd.DataFrame:
        names = [f.split(":")[0].strip() for f in _TYPE[7:-1].split(",")]
        return pd.DataFrame([_patterns(a, b) or dict.fromkeys(names) for a, b in zip(x, y)], columns=names).astype("Int64")

    return F.pandas_udf(run, _TYPE)(x, y)


def rates(counts: Column) -> list[Column]:
    """Whole percents, halves up: ks and ka, differences of the places they could be at; gaps of all columns; the longest equal run of the shorter sequence."""
    percent = lambda part, whole: F.when(whole > 0, F.floor(0.5 + 100 * part / whole)).otherwise(0)
    c = lambda name: counts.getField(name)
    run = F.least(c("t_tn") - c("t_gp"), c("len1"), c("len2"))
    return [
        percent(c("t_ds"), c("t_ds") + c("t_es")).alias("ks"), percent(c("t_dn"), c("t_dn") + c("t_en")).alias("ka"),
        percent(c("t_gp"), c("t_tn")).alias("gaps"), percent(c("er"), run).alias("run"),
    ]
