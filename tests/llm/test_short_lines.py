"""Lines of fewer than five distinct words take part in line dedup."""

from loomspan.llm import line_dedup

from . import helpers as H
from .test_pairs_and_lines import lines_brute

TEXTS = ["All rights reserved\nfirst text here\n\nshare", "share\nreserved All rights\nan own line\n ", "很长的一行没有空格\na b c d\nla la la la la la", "很长的一行没有空格\na b c d e\nla", "a b c\na b c d f\n\nsay it"]


def test_short_lines_match_brute_force(spark):
    rows = [(i, t, "en", "a") for i, t in enumerate(TEXTS, 1)]
    df = H.documents(spark, rows)
    found = {(r["doc_id"], i) for r in line_dedup.removed_lines(df).collect() for i in r["removed"]}
    assert found == lines_brute([(i, t) for i, t, *_ in rows], least=1)
    assert found == {(2, 0), (2, 1), (4, 0), (4, 1), (4, 2), (5, 1)}
    assert {r["doc_id"]: r["text"] for r in line_dedup.apply(df).collect()}[2] == "an own line\n "
