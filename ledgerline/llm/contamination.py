"""Benchmark decontamination by greedy string tiling.

Documents and benchmark items that share a run of ``SEED`` words meet in a join on
the run's hash. Each such pair is tiled by running Karp-Rabin matching: the longest
common run that overlaps no earlier one is marked, again and again down to ``SEED``
words. The share of the item under tiles is its coverage, which the order of the
passages in the document does not change. An item of fewer than ``SEED`` words is met
by its whole run of words.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import bitmap, broadcast_if_small, hashed, in_bitmap, map_texts, mixed, row_key, texts, unused
from ledgerline.sources.cuts import cut, kept_table

SEED = 5
COVERAGE = 0.5
FIRST_LENGTH = 20
WORDS_A_PASS = 200_000
WORD = re.compile(r"[^\W_]+")
BASE = np.uint64(0x100000001B3)


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def runs(h: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hash of each run of ``length`` words; none in a shorter text."""
    n = len(h) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(length):
        total = total * BASE + h[i : i + n]
    return total


def numbered(batch: list[str]) -> Iterator[np.ndarray]:
    """Hashed words of each text, in order."""
    waiting: list[list[str]] = []
    pending = 0

    def flush() -> Iterator[np.ndarray]:
        flat = hashed([w for words in waiting for w in words])
        yield from np.split(flat, np.cumsum([len(w) for w in waiting])[:-1]) if waiting else ()
        waiting.clear()

    for text in batch:
        waiting.append(words_of(text))
        pending += len(waiting[-1])
        if pending >= WORDS_A_PASS:
            yield from flush()
            pending = 0
    yield from flush()


def seeds(h: np.ndarray, length: int = SEED) -> np.ndarray:
    return mixed(runs(h, length))


def seed_length(words: int) -> int:
    """Of an item of so many words."""
    return min(SEED, words)


def tiles(item: np.ndarray, doc: np.ndarray, least: int = SEED) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (length, place in item, place in doc) of runs that overlap nowhere, longest first.

    Equal lengths go by the smaller place in the item, then in the document.
    """
    item_free, doc_free = np.ones(len(item), bool), np.ones(len(doc), bool)
    found: list[tuple[int, int, int]] = []
    length = min(max(FIRST_LENGTH, least), max(len(item), least))
    while True:
        matches = _scan(item, doc, item_free, doc_free, length)
        if matches and matches[0][0] > 2 * length:
            length = matches[0][0]
            continue
        for k, i, j in matches:
            if item_free[i : i + k].all() and doc_free[j : j + k].all():
                item_free[i : i + k] = doc_free[j : j + k] = False
                found.append((k, i, j))
        # A run that an earlier tile cut into may go on at this length, so scan until there is none.
        if not matches:
            if length <= least:
                return found
            length = max(least, length // 2)


def _scan(item: np.ndarray, doc: np.ndarray, item_free: np.ndarray, doc_free: np.ndarray, length: int):
    """Maximal unmarked common runs of at least ``length``, longest first."""
    places: dict[int, list[int]] = {}
    wanted = runs(item, length)
    for j in np.flatnonzero(np.isin(runs(doc, length), wanted)).tolist():
        if doc_free[j : j + length].all():
            places.setdefault(int(runs(doc[j : j + length], length)[0]), []).append(j)
    out = []
    for i, h in enumerate(wanted.tolist()):
        if not item_free[i : i + length].all():
            continue
        for j in places.get(h, ()):
            if i and j and item_free[i - 1] and doc_free[j - 1] and item[i - 1] == doc[j - 1]:
                continue  # part of the run that began earlier
            k = 0
            while i + k < len(item) and j + k < len(doc) and item_free[i + k] and doc_free[j + k] and item[i + k] == doc[j + k]:
                k += 1
            if k >= length:
                out.append((k, i, j))
    return sorted(out, key=lambda m: (-m[0], m[1], m[2]))


def shared_part(doc: np.ndarray, doc_seeds: np.ndarray, item_seeds: np.ndarray, length: int = SEED) -> np.ndarray:
    """The document's words inside runs of ``length`` that the item has too, with a gap of a word no item has between them."""
    hit = np.isin(doc_seeds, item_seeds)
    inside = np.zeros(len(doc), bool)
    for i in range(length):
        inside[i : i + len(hit)] |= hit
    # One more word at each end of a stretch, always a different one, so that stretches do not run together.
    out = np.where(inside, doc, np.uint64(0))
    return out[inside | np.pad(inside, (1, 0))[:-1]]


def _measured(batches: Iterator[pd.DataFrame], coverage: float) -> Iterator[pd.DataFrame]:
    for batch in batches:
        out = []
        for row, h in zip(batch.itertuples(), numbered(batch.text.tolist()), strict=True):
            own: dict[int, np.ndarray] = {}
            for item in row.items:
                words = np.array(item["words"], np.int64).view(np.uint64)
                n = seed_length(len(words))
                if n not in own:
                    own[n] = seeds(h, n)
                found = tiles(words, shared_part(h, own[n], seeds(words, n), n), n)
                covered = sum(k for k, _, _ in found)
                if covered >= coverage * len(words):
                    out.append((row.doc_id, row.key, item["item_id"], len(words), covered, len(found), found[0][0]))
        columns = ["doc_id", "key", "item_id", "item_words", "covered_words", "n_tiles", "longest_tile"]
        frame = pd.DataFrame(out, columns=columns)
        yield frame.astype({"doc_id": "Int64", "item_id": "Int64"})


def item_words(benchmark: DataFrame) -> DataFrame:
    """``item, item_id, words``: the hashed words of each item that has any; ``item`` names it by its id and words.

    One row for each id and run of words. An item without an id stands only for words that no item with an id has.
    """
    rows = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    made = map_texts(rows, lambda b: {"words": [h.view(np.int64) for h in numbered(b)]}, "words array<bigint>")
    made = cut(made.where(F.size("words") > 0).dropDuplicates(["item_id", "words"]))
    named, nameless = made.where("item_id is not null"), made.where("item_id is null")
    each = named.unionByName(nameless.join(named.select("words"), "words", "left_anti"))
    spelt = F.concat_ws(",", F.col("words").cast("array<string>"))
    return each.withColumn("item", F.md5(F.concat_ws("\u0000", F.coalesce(F.col("item_id").cast("string"), F.lit("-")), spelt)))


def seed_rows(items: DataFrame) -> DataFrame:
    """The distinct seeds of each item, with the number of places that each has in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, values, counts = [], [], []
            for item, words in zip(batch.column("item").to_pylist(), batch.column("words").to_pylist(), strict=True):
                h = np.array(words, np.int64).view(np.uint64)
                own, places = np.unique(seeds(h, seed_length(len(h))), return_counts=True)
                ids += [item] * len(own)
                values.append(own.view(np.int64))
                counts.append(places)
            flat = [np.concatenate(v) if v else np.zeros(0, np.int64) for v in (values, counts)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), *map(pa.array, flat)], names=["item", "seed", "places"])

    return items.mapInArrow(run, "item string, seed long, places long")


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """Pairs of a document and an item of which tiles cover ``coverage`` or more.

    ``doc_id, key, item_id, item_words, covered_words, n_tiles, longest_tile``; ``key`` names the row
    by its content, also where the id is null. Repeated rows count once. Null and empty
    texts and items are in no pair. Each text of a repeated item id counts, and one without an
    id. An item of fewer than ``SEED`` words is in each document that has them all in a row.
    """
    items = cut(item_words(benchmark))
    wanted = cut(seed_rows(items))
    bits = bitmap(wanted, "seed")
    lengths = sorted(r.n for r in items.select(F.least(F.size("words"), F.lit(SEED)).alias("n")).distinct().collect())

    def hits(batch: list[str]) -> dict:
        own = (np.concatenate([np.zeros(0, np.uint64), *(seeds(h, n) for n in lengths)]) for h in numbered(batch))
        found = [s[in_bitmap(bits, s)] for s in own]
        return {"seeds": [np.unique(s).view(np.int64) for s in found], None: [len(s) > 0 for s in found]}

    rows = kept_table(map_texts(texts(docs).where("text <> ''"), hits, "seeds array<bigint>", text=True).withColumn("key", row_key()))
    rows = rows.dropDuplicates(["key"])
    met = rows.select("key", F.explode("seeds").alias("seed")).join(wanted, "seed")
    # Each place of a shared run adds at most its own words to the coverage, so few places can't reach it.
    pairs = met.groupBy("key", "item").agg(F.sum("places").alias("n")).join(items, "item")
    pairs = pairs.where(F.col("n") * SEED >= coverage * F.size("words"))
    grouped = pairs.groupBy("key").agg(F.collect_list(F.struct("item_id", "words")).alias("items"))
    both = rows.select("key", "doc_id", "text").join(grouped, "key")
    schema = "doc_id long, key string, item_id long, item_words long, covered_words long, n_tiles long, longest_tile long"
    return both.mapInPandas(partial(_measured, coverage=coverage), schema)


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``contaminated`` without the row names: the documents to drop, each with the items that it holds."""
    return contaminated(docs, benchmark).drop("key")


def without_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no benchmark item."""
    key = unused(docs, "key")
    found = cut(contaminated(docs, benchmark).select(F.col("key").alias(key)).distinct())
    return docs.join(broadcast_if_small(found), row_key() == F.col(key), "left_anti")
