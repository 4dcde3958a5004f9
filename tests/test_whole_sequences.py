"""Queries over texts longer than any prefix, against brute force on whole sequences."""

import hashlib
import random
from collections import Counter

import pytest

from loomspan.functions import sequences as sq
from loomspan.plans.catalog import QUERIES

FLIP = str.maketrans("ACGT", "GTAC")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("long"))
    draw = random.Random(7)
    long_ = "".join(draw.choice("abcdefgh ") for _ in range(40_000))
    texts = [long_ + "a", long_ + "b", long_[5000:30_000], "abcdefgh" * 5]
    rows = [(i, t, "en", "a", len(t)) for i, t in enumerate(texts, 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"file://{path}/documents.parquet")
    return "file://" + path, {i: t.replace(" ", "").translate(str.maketrans("abcdefgh", "ACGTACGT")) for i, t, *_ in rows}


def protein(s):
    return "".join(sq.CODONS[s[i : i + 3]] for i in range(0, len(s) - 2, 3))


def by_id(spark, folder, name):
    return {r["id"]: r for r in QUERIES[name](spark, folder[0]).collect()}


def test_sequences_are_whole(spark, folder):
    seqs = folder[1]
    assert {i: r["rc"] for i, r in by_id(spark, folder, "seq02_reverse_complement").items()} == {i: s[::-1].translate(str.maketrans("ACGT", "TGCA")) for i, s in seqs.items()}
    assert {i: r["plus1"] for i, r in by_id(spark, folder, "seq01_translate").items()} == {i: protein(s) for i, s in seqs.items()}
    assert {i: r["bases"] for i, r in by_id(spark, folder, "seq09_letter_counts").items()} == {i: len(s) for i, s in seqs.items()}
    assert QUERIES["seq20_n50"](spark, folder[0]).first()["total"] == sum(map(len, seqs.values()))


def test_back_translation_and_asymmetry_are_whole(spark, folder):
    seqs = folder[1]
    assert {i: r["cds"] for i, r in by_id(spark, folder, "seq08_back_translate").items()} == {i: "".join(sq.BACK[a] for a in protein(s)) for i, s in seqs.items()}
    got = by_id(spark, folder, "seq11_position_asymmetry")
    for i, s in seqs.items():
        n = [s[k : len(s) - len(s) % 3 : 3].count("A") for k in range(3)]
        assert got[i]["asym_a"] == pytest.approx(max(n) / (min(n) + 1), abs=1e-6)


def test_frames_beyond_the_head(spark, folder):
    rows = QUERIES["seq03_open_frames"](spark, folder[0]).where("id = 1").collect()
    assert max(r["end"] for r in rows) > 30_000
    assert by_id(spark, folder, "seq04_best_frame")[1]["length"] == len(folder[1][1])


def test_changed_bases_reach_the_tail(spark, folder):
    want = set()
    for i, s in folder[1].items():
        for p in range(3, len(s) - len(s) % 3, 7):
            k = p % 3
            old = s[p - k : p - k + 3]
            new = old[:k] + old[k].translate(FLIP) + old[k + 1 :]
            want.add((i, p, sq.CODONS[old], sq.CODONS[new]))
    rows = QUERIES["seq15_snp_effects"](spark, folder[0]).collect()
    assert len(rows) == len(want)
    assert {(r["id"], r["pos"], r["before"], r["after"]) for r in rows} == want


def test_hexamers_are_whole(spark, folder):
    rows = sq.hexamers(spark.createDataFrame(list(folder[1].items()), "id long, seq string"), "id").collect()
    want = {(i, h): n for i, s in folder[1].items() for h, n in Counter(s[p : p + 6] for p in range(0, len(s) - 5, 3)).items()}
    assert {(r["id"], r["hexamer"]): r["n"] for r in rows} == want
    tiny = spark.createDataFrame([(1, "ACGTA"), (2, ""), (3, "ACGTACG")], "id long, seq string")
    assert [(r["id"], r["hexamer"]) for r in sq.hexamers(tiny, "id").collect()] == [(3, "ACGTAC")]


def test_duplicates_and_fragments_differ_late(spark, folder):
    seqs = folder[1]
    assert {r["key"]: r["copies"] for r in QUERIES["cls02_duplicates"](spark, folder[0]).collect()} == {hashlib.sha256(s.encode()).hexdigest(): 1 for s in seqs.values()}
    held = {i: min(j for j, t in seqs.items() if len(t) > len(s) and s in t) for i, s in seqs.items() if any(len(t) > len(s) and s in t for t in seqs.values())}
    assert held[3] == 1
    assert {i: r["holder"] for i, r in by_id(spark, folder, "cls04_fragments").items()} == held


def test_hexamers_are_counted_where_their_sequence_lies(spark, small):
    from loomspan.functions.sequences import hexamers
    from loomspan.plans.catalog import QUERIES

    plan = QUERIES["seq10_hexamer_score"](spark, small)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(dealt) == 2  # the table by word, the scores by id: no word of a sequence is dealt
    rows = spark.createDataFrame([(1, "ACGTTTACGTTTA"), (1, "ACGTTT"), (2, "ACGTNa"), (3, "ACGTT"), (4, None)], "id long, seq string")
    assert sorted(map(tuple, hexamers(rows, "id").collect())) == [(1, "ACGTTT", 3), (1, "TTTACG", 1), (2, "ACGTNa", 1)]
