"""Blocks of line dedup: entries that no other may match go before lines are paired, and leaders are of about a line's size."""

from loomspan.llm import line_dedup

CLASSES = "doc_id long, line_no int, size int, even long, odd long, prefix array<int>"


def _blocks(spark, rows):
    classes = spark.createDataFrame([(d, 0, size, 0, 0, prefix) for d, size, prefix in rows], CLASSES)
    return {(r["word"], r["doc_id"]): r["head_doc_id"] for r in line_dedup._blocks(classes, 80).collect()}


def test_entries_by_place(spark):
    # word 7 stands so late in both that 16 of 20 words can't be shared any more; word 8 early in both
    found = _blocks(spark, [(1, 20, [1, 2, 3, 4, 7]), (2, 20, [11, 12, 13, 14, 7]), (3, 20, [8, 21, 22]), (4, 20, [31, 8, 33])])
    assert found == {(8, 3): None, (8, 4): 3}


def test_late_place_of_the_larger(spark):
    # the larger line may hold the word late if the smaller one holds it first
    assert _blocks(spark, [(1, 80, [5]), (2, 100, [*range(100, 119), 5])]).keys() == {(5, 1), (5, 2)}


def test_leaders_by_size(spark):
    found = _blocks(spark, [(1, 100, [9]), (2, 60, [9]), (3, 62, [9]), (4, 101, [9])])
    assert found[9, 3] == 2 and found[9, 4] == 1
