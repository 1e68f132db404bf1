"""Near duplicates where an id names several texts, and names of rows."""

import random

from ledgerline.llm import neardup


def test_two_texts_under_one_id_keep_their_links(spark):
    a, b = (" ".join(f"{k}{i}" for i in range(60)) for k in "ab")
    rows = [(1, a), (1, b), (2, a + " more"), (3, b + " more"), (4, b), (5, "alone"), (1, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.component_id) for r in neardup.near_duplicates(docs, 3, 85).collect())
    assert got == [(1, 1), (1, 1), (1, 1), (2, 1), (3, 1), (4, 1), (5, 5)]
    left = sorted(tuple(r) for r in neardup.without_near_duplicates(docs).collect())
    assert left == [(1, a), (1, b), (5, "alone")]


def test_a_link_of_the_larger_text_does_not_merge_the_other(spark):
    x, y = (" ".join(f"{k}{i}" for i in range(60)) for k in "xy")
    rows = [(7, x), (7, y), (-3, y + " more"), (9, x)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in neardup.near_duplicates(docs, 3, 85).collect()}
    assert got == {(7, 7), (7, -3), (-3, -3), (9, 7)}
    left = {tuple(r) for r in neardup.without_near_duplicates(docs).collect()}
    assert left == {(7, x), (-3, y + " more")}


def test_names_sort_as_ids_do(spark):
    rng = random.Random(11)
    ids = [0, 1, -1, 255, 256, 2**63 - 1, -(2**63)] + [rng.randrange(-(2**63), 2**63) for _ in range(100)]
    docs = spark.createDataFrame([(i, "t") for i in ids], "doc_id long, text string").withColumn("row", neardup.row_name())
    rows = docs.select("doc_id", "row", neardup.id_in("row").alias("back")).orderBy("row").collect()
    assert [r.doc_id for r in rows] == sorted(ids) and all(r.back == r.doc_id for r in rows)


def test_long_sets_make_more_blocks(spark, monkeypatch):
    """Blocks of a few shingles give the same components as one block."""
    rng = random.Random(8)
    base = [f"w{i}" for i in range(80)]
    rows = []
    for i in range(40):
        words = list(base if i % 7 == 0 else rows[-1][1].split())
        for _ in range(5):
            words[rng.randrange(80)] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(tuple(r) for r in neardup.near_duplicates(docs, 3, 60).collect())
    monkeypatch.setattr(neardup, "BLOCK_SHINGLES", 200)
    assert sorted(tuple(r) for r in neardup.near_duplicates(docs, 3, 60).collect()) == want
