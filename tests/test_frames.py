"""Searches for reading frames step from mark to mark, not from codon to codon."""

from __future__ import annotations

import random
import sys

from loomspan.functions.sequences import CODONS, _frames
from loomspan.operators.repair import best_orf


def _steps(call) -> int:
    seen = 0

    def trace(frame, event, arg):
        nonlocal seen
        seen += event == "line"
        return trace

    before = sys.gettrace()
    sys.settrace(trace)
    try:
        call()
    finally:
        sys.settrace(before)
    return seen


def test_frames_step_at_marks_alone():
    assert _steps(lambda: _frames("C" * 30_000, 30)) < 500
    assert _steps(lambda: best_orf("C" * 30_000)) < 500


def _plain(seq: str) -> list[tuple]:
    """(begin, end, kind, aa, xs) of the + strand by codons."""
    out = []
    for frame in range(3):
        codons = [seq[i : i + 3] for i in range(frame, len(seq) - 2, 3)]
        stops = [k for k, c in enumerate(codons) if CODONS.get(c) == "*"]
        at, head = 0, True
        for stop in [*stops, None]:
            end = len(codons) if stop is None else stop
            starts = [k for k in range(at, end) if codons[k] == "ATG"][:1]
            for k, whole in [(k, True) for k in starts] + [(0, False)] * (head and starts != [0]):
                if end - k >= 1:
                    kind = ("partial3" if stop is None else "complete") if whole else ("partial" if stop is None else "partial5")
                    last = end if stop is None else end + 1
                    out.append((frame + 3 * k, frame + 3 * last, kind, end - k, sum("N" in c for c in codons[k:last])))
            at, head = end + 1, False
    return out


def test_frames_and_best_frame_equal_a_walk_over_codons():
    rng = random.Random(7)
    for n in range(1500):
        letters = ["ACGT", "ACGTN", "ATG", "TAGN", "TAG"][n % 5]
        seq = "".join(rng.choice(letters) for _ in range(rng.choice([0, 2, 3, 5, 9, 40, 200])))
        want = _plain(seq)
        assert sorted(x[2:] for x in _frames(seq, 1, "+")) == sorted((b + 1, e, *rest) for b, e, *rest in want)
        ranked = [(aa - 3 * xs, kind == "complete", b, e, kind, aa) for b, e, kind, aa, xs in want]
        assert best_orf(seq) == max(ranked, key=lambda f: (f[0], f[1], -f[2], -f[3]), default=(0, False, 0, 0, "", 0))


def test_genes_are_mended_and_texts_read_as_bases_once(spark, small):
    from loomspan.plans.catalog import QUERIES

    plan = QUERIES["job02_repaired_genes"](spark, small)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [_mend(") == 1
    scans = plan.count("FileScan")
    assert plan.count("ArrowEvalPython [_bases(") == scans
