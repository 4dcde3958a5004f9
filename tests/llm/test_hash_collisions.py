"""Texts in Thue-Morse order of two parts collide under polynomials modulo a power of two: operators must tell them apart."""

from loomspan.llm import ngram_join, passages

from . import helpers as H


def morse(n, a, b):
    return [b if bin(i).count("1") % 2 else a for i in range(n)]


def pair(join):
    """Two lists of 1,024 parts, each the other with its parts swapped."""
    return join(morse(1024, "a", "b")), join(morse(1024, "b", "a"))


def test_words_of_swapped_letters_are_not_linked(spark):
    x, y = pair("".join)
    filler = [f"w{i}" for i in range(60)]
    docs = [" ".join([w if i % 4 else long for i, w in enumerate(filler)]) for long in (x, y)]
    rows = [(i + 1, d, "en", "a") for i, d in enumerate(docs)]
    got = {r["doc_id"]: r["component_id"] for r in ngram_join.join(H.documents(spark, rows)).collect()}
    assert got == {1: 1, 2: 2}
    kept = {r["doc_id"]: r["n_removed"] for r in passages.remove_repeats(H.documents(spark, rows)).collect()}
    assert kept == {1: 0, 2: 0}


def test_texts_of_swapped_words_are_not_copies(spark):
    x, y = pair(lambda parts: " ".join(f"{p}x" for p in parts))
    rows = [(1, x, "en", "a"), (2, y, "en", "a")]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in passages.remove_repeats(H.documents(spark, rows)).collect()}
    assert got == H.repeats_brute([r[:2] for r in rows])
