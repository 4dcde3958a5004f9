"""Fragments are found where the longer text lies: no join pairs texts that begin alike."""

import random

import numpy as np
import pandas as pd
import pytest

from loomspan.operators import classify


def walk(rows, k):
    rows = [(i, t) for i, t in rows if i is not None and t is not None]
    found = {i: [j for j, u in rows if len(u) > len(t) and t in u] for i, t in rows if len(t) >= k}
    return {i: min(held) for i, held in found.items() if held}


def seek(rows, k, bits, batches=2):
    """fragments() without Spark."""
    frame = pd.DataFrame([(i, t) for i, t in rows if t is not None and len(t) >= k], columns=["id", "seq"])
    parts = [frame.iloc[n::batches] for n in range(batches)]
    keys = pd.concat(list(classify._marks(k, bits)(iter(parts))))
    sketch = type("Held", (), {"value": np.zeros(max(1, 1 << bits >> 3), np.uint8)})
    for slot in {int(m) for marks in keys["marks"] for m in marks}:
        sketch.value[slot >> 3] |= 1 << (slot & 7)
    least = {}
    for part in classify._words(k, bits, sketch)(iter(parts)):
        for i, key in zip(part["id"], part["key"]):
            least[key] = min(i, least.get(key, i))
    return {i: least[key] for i, key in zip(keys["id"], keys["key"]) if key in least}


def shuffled(spark):
    """Rows that all stages up to now have written for shuffles."""
    sc = spark.sparkContext
    sc._jsc.sc().listenerBus().waitUntilEmpty()
    none = lambda: sc._jvm.java.util.ArrayList()
    stages = sc._jsc.sc().statusStore().stageList(none(), False, False, sc._gateway.new_array(sc._jvm.double, 0), none())
    return {(s.stageId(), s.attemptId()): s.shuffleWriteRecords() for s in (stages.apply(n) for n in range(stages.size()))}


def test_texts_that_begin_alike_are_not_paired(spark):
    draw = random.Random(8)
    letters = lambda n: "".join(draw.choice("ACGT") for _ in range(n))
    head = letters(120)
    texts = [head + letters(draw.randrange(50, 300)) for _ in range(400)]
    texts += [t[:-30] + letters(30) for t in texts[:100]] + [t[draw.randrange(90) :][:100] for t in texts[:60]] + [t[:-1] for t in texts[60:90]] + texts[90:100] + [head, head[5:60]]
    rows = list(enumerate(texts))
    draw.shuffle(rows)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        old = shuffled(spark)
        got = {r["id"]: r["holder"] for r in classify.fragments(spark.createDataFrame(rows, "id long, seq string")).collect()}
        sent = sum(n for stage, n in shuffled(spark).items() if stage not in old)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == walk(rows, 24) and len(got) > 80
    assert 0 < sent < 20 * len(rows)  # 400 texts that meet in pairs are 160,000


@pytest.mark.parametrize("chunk", [1, 37, 1 << 18])
def test_runs_against_all_pairs(monkeypatch, chunk):
    monkeypatch.setattr(classify, "_CHUNK", chunk)
    draw = random.Random(chunk)
    for letters, longest in (("A", 70), ("AB", 60), ("ACGT", 90), ("aé\U0001f600", 50)):
        texts = ["".join(draw.choice(letters) for _ in range(draw.randrange(longest))) for _ in range(25)]
        texts += [t[draw.randrange(len(t) + 1) :][: draw.randrange(longest)] for t in texts] + ["".join(texts[:9]), "", "AB" * 40, "AB" * 17, texts[3]]
        rows = list(enumerate(texts)) + [(500, None)]
        draw.shuffle(rows)
        for k, bits in ((1, 25), (3, 20), (5, 3), (24, 27)):
            assert seek(rows, k, bits) == walk(rows, k)


def test_a_text_meets_one_laid_beside_it():
    """What runs over the border of two texts is no run of either."""
    a, b = "ACGT" * 8, "GGTA" * 9
    assert seek([(1, a), (2, b), (3, a[-12:] + b[:12])], 24, 25, batches=1) == {}
    assert seek([(1, a), (2, a), (3, a + b), (4, a + b)], 24, 25, batches=1) == {1: 3, 2: 3}


def test_places_of_a_repeating_text_are_not_paired(monkeypatch):
    tried, whole = [], classify._Runs.whole
    monkeypatch.setattr(classify._Runs, "whole", lambda self, begin, end: tried.append(len(begin)) or whole(self, begin, end))
    for unit in ("A", "ACGTTGCAAC"):
        text = unit * (6000 // len(unit))
        assert seek([(1, text), (2, text[:2500]), (3, text[3:53])], 24, 25) == {2: 1, 3: 1}
    assert sum(tried) < 1_000_000  # all places of a text that meet in pairs are 5,000,000


def test_ids_of_letters_and_equal_ids(spark):
    a, b = "ACGTTGCA" * 5, "TTGACCAG" * 4
    rows = spark.createDataFrame([("x", a), ("z", a + b), ("y", b + a), ("x", b), (None, a + a), ("w", None), ("v", "ACGT")], "id string, seq string")
    assert sorted(map(tuple, classify.fragments(rows).collect())) == [("x", "y")]
    assert classify.fragments(rows.limit(0)).collect() == []
