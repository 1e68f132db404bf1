"""Exact copies of items in which few runs of words have many places."""

import pytest

from ledgerline.llm import contamination

ITEMS = {
    "grid": ("0 " * 10 + "3 ") * 30,
    "one word": "no " * 12,
    "sung": "and so we sing this one line once more " * 11,
}


@pytest.mark.parametrize("name", ITEMS)
def test_a_copy_of_a_repetitive_item_is_a_leak(spark, name):
    item = ITEMS[name]
    docs = spark.createDataFrame([(1, f"before it {item} after it"), (2, "nothing of this is in any item")], "doc_id long, text string")
    items = spark.createDataFrame([(7, item)], "item_id long, text string")
    (row,) = contamination.report(docs, items).collect()
    n = len(item.split())
    assert (row.doc_id, row.item_id, row.item_words, row.covered_words, row.longest_tile) == (1, 7, n, n, n)
    assert [r.doc_id for r in contamination.without_contaminated(docs, items).collect()] == [2]
