"""Repeated, missing and short benchmark items."""

from ledgerline.llm import contamination

FIRST = "alpha beta gamma delta epsilon zeta eta theta"
SECOND = "one fine day we went down to the river"
THIRD = "nobody gave this question any number at all"


def test_each_text_of_an_id_and_short_ones_count(spark):
    items = [(1, FIRST), (1, SECOND), (1, FIRST.upper()), (2, FIRST), (None, THIRD), (None, SECOND), (3, "Quick brown fox!"), (4, "zyx"), (5, " - ")]
    docs = [(1, f"x {FIRST} y"), (2, SECOND), (3, f"{THIRD} {THIRD}"), (4, "a quick, brown fox ran"), (5, "brown quick fox"), (6, "zyxw"), (None, "zyx")]
    for partitions in (1, 5):
        benchmark = spark.createDataFrame(items, "item_id long, text string").repartition(partitions)
        frame = spark.createDataFrame(docs, "doc_id long, text string")
        got = sorted(((r.doc_id, r.item_id, r.covered_words, r.item_words) for r in contamination.report(frame, benchmark).collect()), key=str)
        want = [(1, 1, 8, 8), (1, 2, 8, 8), (2, 1, 9, 9), (3, None, 8, 8), (4, 3, 3, 3), (None, 4, 1, 1)]
        assert got == sorted(want, key=str)
        left = contamination.without_contaminated(frame, benchmark)
        assert sorted(r.doc_id for r in left.collect()) == [5, 6]
