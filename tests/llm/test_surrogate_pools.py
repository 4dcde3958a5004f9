"""Surrogates of more names than the first draw can tell apart."""

from itertools import product

import pytest

from loomspan.llm import surrogates

from . import helpers as H


@pytest.mark.parametrize("title, given, letters", [("господин", "", "абвгдежз"), ("госпожа", "Яна ", "абвгдежзи")])
def test_names_of_one_title_outgrow_the_first_pool(spark, title, given, letters):
    names = [f"{title} {given}Щ{''.join(x)}" for x in product(letters, repeat=3)]  # 512 and 729; first pools of 40 and 320
    rows = [(i, f"Это {n}.", "ru", "a") for i, n in enumerate(names)]
    got = {r["doc_id"]: r["text"] for r in surrogates.replace(H.documents(spark, rows, extra=False)).collect()}
    assert len(got) == len(names) == len(set(got.values()))
    new = {t.removeprefix("Это ").removesuffix(".") for t in got.values()}
    assert not new & set(names)
    assert all(n.lower().startswith(title) and len(n.split(" ")) == (3 if given else 2) and all("а" <= c <= "я" for c in n.split(" ")[-1][1:]) for n in new)
