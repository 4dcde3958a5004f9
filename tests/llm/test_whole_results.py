"""Verdicts, surrogates and packing over whole tables against versions without Spark."""

import re

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from loomspan.llm import packing, passages, quality, surrogates

from . import helpers as H


@pytest.fixture(scope="module")
def replaced(spark, medium):
    df = spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "text")
    return {r["doc_id"]: r["text"] for r in df.collect()}, {r["doc_id"]: r for r in surrogates.replace(df).collect()}


def entities(text):
    return [m[0] for m in regex.finditer(surrogates.ANY.replace("IsCyrillic", "Cyrillic"), text or "")]


def kind(value):
    return next(name for name, pattern in surrogates.PATTERNS if regex.fullmatch(pattern, value))


def test_surrogates_over_a_whole_table(replaced):
    before, after = replaced
    assert set(before) == set(after)
    given = {}
    for doc, text in before.items():
        found, new = entities(text), after[doc]["text"]
        assert after[doc]["n_entities"] == len(found)
        kept = regex.split(surrogates.ANY, text or "")
        at = 0
        for i, piece in enumerate(kept):  # what lies between entities stays, and in order
            at_new = (new or "").find(piece, at)
            assert at_new >= at and (i or at_new == 0)
            if i:
                given.setdefault((kind(found[i - 1]), found[i - 1]), set()).add(new[at:at_new] if i < len(kept) - 1 or piece else new[at:])
            at = at_new + len(piece)
    assert len(given) > 20
    drawn = {}
    for (k, value), new in given.items():
        if k in ("email", "ip", "secret", "card", "phone"):
            assert len(new) == 1, (value, new)
            form = re.sub(r"\D", "", value)[-10:] if k == "phone" else re.sub(r"\D", "", value) if k == "card" else value.lower() if k == "email" else value
            drawn.setdefault((k, next(iter(new)).lower() if k == "email" else next(iter(new))), set()).add(form)
    assert all(len(forms) == 1 for forms in drawn.values())


def test_surrogates_keep_coreference_and_form(spark):
    rows = [(1, "Mr Smith, Mr. Smith, Mr. John Smith and Dr Smith; +49 (030) 555-7713, (030) 555-7713", "en", "a"), (2, "господин Иванов AKIA" + "ABCD1234" * 2, "ru", "a"),
            (3, "4111 1111 1111 1111 and sk-" + "aB3" * 8 + " and sk-" + "ab3" * 8, "en", "a")]
    got = {r["doc_id"]: r["text"] for r in surrogates.replace(H.documents(spark, rows)).collect()}
    names = re.fullmatch(r"Mr (\w+), Mr\. (\w+), Mr\. (\w+) (\w+) and Dr (\w+); \+49 \((\d{3})\) (\d{3}-\d{4}), \((\d{3})\) (\d{3}-\d{4})", got[1]).groups()
    assert len({names[0], names[1], names[3], names[4]}) == 1 and names[0] != "Smith" and names[2] != "John"
    assert names[5:7] == names[7:9]
    assert re.fullmatch(r"господин \w+ AKIA(?:[A-Z]{4}[0-9]{4}){2}", got[2]) and "Иванов" not in got[2]
    card, upper, lower = re.fullmatch(r"(\d{4} \d{4} \d{4} \d{4}) and sk-(\S+) and sk-(\S+)", got[3]).groups()
    digits = [int(x) for x in reversed(card.replace(" ", ""))]
    assert (sum(digits[::2]) + sum(sum(divmod(2 * d, 10)) for d in digits[1::2])) % 10 == 0
    assert re.fullmatch(r"(?:[a-z][A-Z][0-9]){8}", upper) and re.fullmatch(r"(?:[a-z][a-z][0-9]){8}", lower) and upper.lower() != lower


def test_surrogates_of_many_names_end(spark):
    letters = "абвгдежзик"
    rows = [(i, "господин Ко" + "".join(letters[int(d)] for d in f"{i:04d}"), "ru", "a") for i in range(3000)]
    got = surrogates.replace(H.documents(spark, rows, extra=False)).collect()
    assert len({r["text"] for r in got}) == 3000 and all(re.fullmatch(r"господин \w+", r["text"]) for r in got)


def test_quality_verdict_matches_plain_quantiles(spark):
    """One group: outliers of each ratio go, the rest stays."""
    rng = np.random.default_rng(1)
    word = lambda: "".join(rng.choice(list("abcdefgh"), rng.integers(3, 8)))
    text = lambda n: "\n".join(" ".join(word() for _ in range(20)) for _ in range(n // 20))
    rows = [(i, text(400), "en", "a") for i in range(300)]
    clean, line = text(400), " ".join(word() for _ in range(20))
    rows += [(1000, clean + " ###" * 40, "en", "a"), (1001, clean + ("\n" + line) * 16, "en", "a"), (1002, " ".join(word() * 3 for _ in range(400)), "en", "a")]
    rows += [(1003, clean + "\n" + line + "\n" + text(400) + "\n" + line, "en", "a"), (1004, " ".join(word() for _ in range(12)), "en", "a")]
    got = {r["doc_id"]: r for r in quality.judge(H.documents(spark, rows)).collect()}
    assert all(got[i]["kept"] for i in range(300)) and got[1003]["kept"] and got[1004]["kept"]
    assert not any(got[i]["kept"] for i in (1000, 1001, 1002))
    assert not got[1000]["base_failed"] and not got[1002]["base_failed"]


def test_passages_with_two_texts_of_one_id(spark):
    shared = " ".join(f"s{i}" for i in range(60))
    rows = [(1, "a " + shared, "en", "a"), (2, shared + " b", "en", "a"), (2, "c d " + shared, "en", "a"), (2, "none of it", "en", "a"), (2, shared + " b", "en", "a")]
    got = sorted((r["doc_id"], r["n_words"], r["n_removed"]) for r in passages.remove_repeats(H.documents(spark, rows)).collect())
    assert got == [(1, 61, 0), (2, 3, 0), (2, 61, 60), (2, 61, 60), (2, 62, 60)]


def test_packing_special_and_long_texts(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path
    rows = [(1, "a <|endoftext|> b<|endoftext|>", "en", "a"), (2, "word " * 500_000, "en", "a"), (3, " " * 2_100_000 + "x", "en", None)]
    got = packing.pack(H.documents(spark, rows), path("byte_bpe_50k.tiktoken"), path("byte_bpe_50k.json"))
    plain = Tokenizer.from_file(path("byte_bpe_50k.json"))
    held = {r["doc_id"]: r for r in got.groupBy("doc_id").agg(F.first("doc_tokens").alias("n"), F.sum("length").alias("length")).collect()}
    for doc, text, *_ in rows:
        assert held[doc]["n"] == held[doc]["length"] == len(plain.encode(text, add_special_tokens=False).ids) + 1


def test_quality_verdicts_agree_between_partitionings(spark):
    """The same verdicts however the table lies in partitions, and fences near plain quantiles."""
    df = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    found = [sorted((r["doc_id"], r["kept"]) for r in quality.judge(df.repartition(n, *by)).select("doc_id", "kept").collect()) for n, by in ((2, ()), (7, ("doc_id",)), (13, ("source",)))]
    assert found[0] == found[1] == found[2] and 0 < sum(k for _, k in found[0]) < len(found[0])
    rows = quality.measured(df).where("not base_failed").toPandas()
    bounds = quality.thresholds(quality.measured(df)).collect()
    for b in bounds[:20]:
        mine = rows[(rows["lang"] == b["lang_key"][1:]) & (rows["source"] == b["source_key"][1:])]
        if len(mine) >= 200:
            assert b["fences"]["word_low"] == pytest.approx(np.quantile(mine["mean_word"], 0.25, method="inverted_cdf"), rel=0.003)
            assert b["fences"]["words_mid"] == pytest.approx(np.quantile(mine["n_words"], 0.5, method="inverted_cdf"), rel=0.003)
