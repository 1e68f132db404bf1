"""Periodic runs against a version that compares every word with the one each period later."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from ledgerline.llm import periodic
from tests.llm.rows import LONG, none, odd, table


def brute(words):
    """(start, length, period) of every maximal run, by start and period."""
    n, out = len(words), []
    for q in range(1, n // 4 + 1):
        start = None
        for i in range(n - q + 1):
            if i < n - q and words[i] == words[i + q]:
                start = i if start is None else start
            elif start is not None:
                length = i - start + q
                inside = words[start : start + length]
                smaller = any(q % r == 0 and inside[r:] == inside[:-r] for r in range(1, q))
                if length >= max(6, 4 * q) and not smaller:
                    out.append((start, length, q))
                start = None
    return sorted(out)


def kept(words, runs):
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def told(words):
    runs = brute(words)
    best = (None,) * 4
    if runs:
        s, n, p = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]))
        best = (s, n, p, 1000 * n // p)
    return len(runs), *best, sha("".join(f"{s},{n},{p}\n" for s, n, p in runs)), sha(kept(words, runs))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(doc_id, w):
    h, n = zlib.crc32(str(doc_id).encode()), len(w)
    g = h // 10
    if doc_id is None or h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def random_text(rng):
    k, out = rng.choice([1, 2, 2, 3, 5, 50]), []
    while len(out) < rng.choice([0, 3, 20, 60, 200]):
        if rng.random() < 0.4:
            unit = [f"w{rng.randrange(k)}" for _ in range(rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 12, 16, 17]))]
            out += (unit * rng.randrange(1, 9))[: rng.randrange(1, 90)]
        else:
            out += [f"w{rng.randrange(k)}" for _ in range(rng.randrange(1, 12))]
    return rng.choice([" ", "\n", " \t "]).join(out)


ROWS = [(i, random_text(random.Random(i))) for i in range(400)]
ROWS += [(i, t) for i in (7, None) for t in (None, "", " \n", "a " * 40, "a\x1fb\x85c " * 9, "x y x y x y x y", "x y x y x y x", "z z z z z", "Z z Z z Z z Z z é")]


@pytest.mark.parametrize("long_text", [periodic.LONG_TEXT, 100, 0])
def test_random_texts_with_repeated_ids(spark, long_text):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").repartition(5)
    docs = docs.withColumns({c: F.lit(None).cast("string") for c in ("row", "runs", "start", "period", "g", "n", "words", "fragments")})
    made = periodic.report(periodic.with_planted_periods(docs), long_text)
    expected = [(doc, *told(planted(doc, words(text)))) for doc, text in ROWS]
    assert sorted(map(tuple, made.collect()), key=str) == sorted(expected, key=str)


def test_given_short_documents(spark):
    docs = table(spark, "documents").where("n_chars < 1200")
    expected = [(r.doc_id, *told(planted(r.doc_id, words(r.text)))) for r in docs.collect()]
    assert sorted(map(tuple, periodic.planted_report(docs).collect())) == sorted(expected)


def test_spans_and_collapsed_text(spark):
    docs = spark.createDataFrame([(1, "so a b a b a b a b on"), (2, None)], "doc_id long, text string")
    assert [tuple(map(tuple, r.runs)) for r in periodic.repeated_runs(docs).orderBy("doc_id").collect()] == [((1, 8, 2),), ()]
    assert [r.text for r in periodic.collapsed(docs).orderBy("doc_id").collect()] == ["so a b on", ""]


def test_odd_rows_and_empty_tables(spark):
    docs = odd(spark)
    out = periodic.repeated_runs(docs).collect()
    assert len(out) == docs.count()
    assert [tuple(map(tuple, r.runs)) for r in out if r.doc_id == 5] == [((0, len(words(LONG)), 3),)]
    assert periodic.planted_report(none(spark)).collect() == [] and periodic.collapsed(none(spark)).collect() == []


@pytest.mark.parametrize("seed", range(30))
def test_z_function(seed):
    rng = random.Random(seed)
    s = [rng.randrange(2) for _ in range(rng.randrange(1, 40))]
    naive = [next((k for k in range(len(s) - i) if s[k] != s[i + k]), len(s) - i) for i in range(len(s))]
    assert periodic.z_function(s) == naive
