"""Near duplicates, components, decontamination and licenses against brute force."""

import random
from itertools import combinations

import numpy as np
import pytest

from ledgerline.llm import contamination, licenses, neardup, queries
from ledgerline.llm.components import components
from ledgerline.llm.license_texts import NOTICES
from tests.llm.rows import ODD, none, odd, table


def sets_of(text, size):
    words = (text or "").encode().lower().split()
    k = min(size, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if k else set()


def by_hand(rows, size, percent):
    sets = {i: sets_of(t, size) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in combinations(sorted(sets), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {i: (len(sets[i]), root(i)) for i in sets}


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_components_equal_all_pairs(spark, size, percent):
    docs = table(spark, "documents")
    want = by_hand([(r.doc_id, r.text) for r in docs.collect()], size, percent)
    got = neardup.near_duplicates(docs, size, percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_components_equal_the_sql(spark):
    duckdb = pytest.importorskip("duckdb")
    got = queries.QUERIES["op7_minhash"](spark, "/root/testdata/sf0.01").toPandas().sort_values("doc_id")
    with duckdb.connect() as connection:
        connection.execute("create view documents as select * from '/root/testdata/sf0.01/documents.parquet'")
        want = connection.sql(queries.oracle_sql()["op7_minhash"]).fetchall()
    assert list(got[["doc_id", "n_shingles", "component_id", "kept"]].itertuples(index=False, name=None)) == sorted(want)


def test_a_group_of_edited_copies_equals_all_pairs(spark):
    """Chains and many copies of one text, so that hubs leave some members apart."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(500)}" for _ in range(120)]
    rows = []
    for i in range(150):
        words = base if i % 10 == 0 or not rows else rows[-1][1].split()
        words = list(words)
        for _ in range(rng.randrange(6)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    got = neardup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == by_hand(rows, 3, 85)


def test_odd_rows_and_near_duplicates(spark):
    got = neardup.near_duplicates(odd(spark), 3, 85).collect()
    assert len(got) == len(ODD)
    component = {r.doc_id: r.component_id for r in got if r.doc_id}
    assert component[2] == component[1] == 1 and component[3] == 3 and component[4] == 4
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    left = neardup.without_near_duplicates(odd(spark))
    assert left.columns == odd(spark).columns
    ids = sorted((r.doc_id for r in left.collect() if r.doc_id is not None))
    assert ids == [1, 3, 4, 5, 6, 7, 8, 9]
    assert left.where("doc_id is null").count() == 2
    assert neardup.near_duplicates(none(spark)).count() == 0
    assert neardup.without_near_duplicates(none(spark)).count() == 0


def test_alternating_stars_equal_a_search(spark):
    rng = random.Random(3)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)]
    links += [(5, 5), (None, 3), (4, None), links[0], links[0][::-1]]
    parent = list(range(400))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        if a is not None and b is not None:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    met = {i for a, b in links if a is not None and b is not None and a != b for i in (a, b)}
    got = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == sorted((i, root(i)) for i in met)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def greedy(item, doc, least):
    """Greedy string tiling by its definition."""
    free_a, free_b, tiles = [True] * len(item), [True] * len(doc), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                k = 0
                while i + k < len(item) and j + k < len(doc) and free_a[i + k] and free_b[j + k] and item[i + k] == doc[j + k]:
                    k += 1
                best = max(best, (k, -i, -j))
        k, i, j = best[0], -best[1], -best[2]
        if k < least:
            return tiles
        tiles.append((k, i, j))
        for t in range(k):
            free_a[i + t] = free_b[j + t] = False


@pytest.mark.parametrize("seed", range(25))
def test_tiles_equal_the_definition(seed):
    rng = random.Random(seed)
    item = [rng.randrange(1, 2 + seed) for _ in range(rng.randrange(1, 40))]
    doc = [rng.randrange(1, 2 + seed) for _ in range(20)]
    for _ in range(3):
        a = rng.randrange(len(item))
        at = rng.randrange(len(doc))
        doc[at:at] = item[a : a + rng.randrange(1, 20)]
    got = contamination.tiles(np.array(item, np.uint64), np.array(doc, np.uint64), 3)
    want = greedy(item, doc, 3)
    assert sum(k for k, _, _ in got) == sum(k for k, _, _ in want)
    assert sorted(k for k, _, _ in got) == sorted(k for k, _, _ in want)


def test_leaks_equal_tiling_all_pairs(spark):
    docs, items = table(spark, "documents"), table(spark, "benchmark")
    words = lambda t: list(next(contamination.numbered([t])))
    test = {r.item_id: words(r.text) for r in items.collect()}
    want = set()
    for r in docs.collect():
        doc = np.array(words(r.text), np.uint64)
        for k, item in test.items():
            if sum(t for t, _, _ in contamination.tiles(np.array(item, np.uint64), doc)) >= 0.5 * len(item) >= 2.5:
                want.add((r.doc_id, k))
    got = contamination.report(docs, items)
    assert {(r.doc_id, r.item_id) for r in got.collect()} == want and want
    left = contamination.without_contaminated(docs, items)
    assert {r.doc_id for r in left.collect()} == {r.doc_id for r in docs.collect()} - {i for i, _ in want}
    assert left.columns == docs.columns


def test_reordered_passages_and_odd_rows(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"
    parts = item.split()
    docs = [
        (20, " ".join(parts[7:]) + " in between " + " ".join(parts[:7])),
        (None, "x " + item.upper() + "!"),
        (21, " ".join(parts[:4])),
        (22, " ".join(reversed(parts))),
    ]
    frame = odd(spark).unionByName(spark.createDataFrame(docs, "doc_id long, text string"), allowMissingColumns=True)
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, "too short"), (None, item), (4, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.covered_words, r.n_tiles) for r in contamination.report(frame, items).collect()}
    assert got == {(20, 1): (15, 2), (None, 1): (15, 1)}
    left = contamination.without_contaminated(frame, items)
    assert left.count() == len(ODD) + 2 and left.columns == frame.columns
    assert contamination.report(none(spark), items).count() == 0
    assert contamination.report(frame, none(spark, "item_id long, text string")).count() == 0


@pytest.mark.parametrize("name, must, notice", NOTICES)
def test_each_notice_is_found_in_other_text(name, must, notice):
    assert set(must.split()) <= set(licenses.words_of(notice))
    text = f"Some words before.\n{notice.upper()}\nand some after, with the license of others."
    (found,) = licenses.found_in(text, licenses.templates(), licenses.COVERAGE)
    assert found[0] == name and found[1] >= 0.95
    assert text[found[2] : found[3]].lower().split()[0] == notice.lower().split()[0]


def test_edited_notice_and_foreign_words():
    words = NOTICES[1][2].split()
    edited = words[:20] + ["inserted", "words"] + words[23:]
    (found,) = licenses.found_in(" ".join(edited), licenses.templates(), licenses.COVERAGE)
    assert found[0] == "Apache-2.0" and found[1] < 1
    assert licenses.found_in("released under the old bridge we met the license", licenses.templates(), 0.8) == []


def test_alignment_is_a_common_subsequence():
    rng = random.Random(7)
    for _ in range(50):
        a = [rng.choice("abcdefghijkl") for _ in range(rng.randrange(30))]
        b = [rng.choice("abcdefghijkl") for _ in range(rng.randrange(30))]
        pairs = licenses.aligned(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:], strict=False))
        assert len(licenses.aligned(a, a)) == len(a)
    places = [rng.randrange(50) for _ in range(30)]
    got = [places[i] for i in licenses.increasing(places)]
    best = [1] * len(places)
    for i in range(len(places)):
        best[i] += max((best[j] for j in range(i) if places[j] < places[i]), default=0)
    assert got == sorted(set(got)) and len(got) == max(best)


def test_licenses_of_documents_and_odd_rows(spark):
    docs = table(spark, "documents")
    short = {n: name for name, _, n in NOTICES if len(n) < 80}
    want = {(r.doc_id, short[line]) for r in docs.collect() for line in r.text.split("\n") if line in short}
    got = licenses.find_licenses(docs)
    assert {(r.doc_id, r.license) for r in got.collect()} == want and want
    assert licenses.find_licenses(odd(spark)).count() == 0
    assert licenses.find_licenses(none(spark)).count() == 0
    assert licenses.find_licenses(docs, among=[]).count() == 0
