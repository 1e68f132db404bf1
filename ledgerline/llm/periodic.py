"""Periodic runs of words by scale-tiled distribution.

Periods are sought octave by octave. For periods P..2P-1 a text is laid out in tiles round a
boundary every 2P words, each from 2P words before it to 5P after. A run repeats its
period at least four times, so the places that agree with the word one period later are a stretch of
3P words or more, and one of the boundaries has the P words after it inside. A hash of those words
finds the tiles with such a boundary; each tile is solved by itself with
the Z-functions of its boundary, forwards and backwards, for all periods of the octave at once, which also
tell a period from a multiple of a smaller one. What a tile sees of a stretch ends at the tile's
edges; the fragments are dealt out by document and period and stitched.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import mixed, slices, texts
from ledgerline.sources.cuts import kept_table

#: A run has this many words and this many periods at least.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Texts of more characters have their tiles dealt out to other tasks; the result is the same.
LONG_TEXT = 4_000_000
#: Words of the tiles that travel together.
DEALT_WORDS = 200_000
SCALE = np.uint64(0x9E3779B97F4A7C15)


class Numbers(dict):
    """Words by number in the order they come; equal numbers are equal words."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


def numbered(batch: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The words of all texts in one row, a number of its own after each text, and where each text starts."""
    numbers, out, starts = Numbers(), [], [0]
    for i, words in enumerate(batch):
        out.extend(map(numbers.__getitem__, words))
        out.append(-1 - i)
        starts.append(len(out))
    return np.array(out, np.int64), np.array(starts, np.int64)


@dataclass(frozen=True)
class Tile:
    """Words ``first``.. of a text round a ``boundary``, and the octave's smallest period."""

    octave: int
    boundary: int
    first: int
    words: list[int]


def tiles(words: np.ndarray, longest: int) -> Iterator[Tile]:
    """Every tile of every octave up to a fourth of ``longest`` whose P words after the boundary come again P to 2P - 1 words later.

    Equal words have equal hashes, so no such tile is missed; one that only seems to be such does no harm.
    """
    n, p = len(words), 1
    block = mixed(words.astype(np.uint64) + np.uint64(1))
    while LEAST_PERIODS * p <= longest:
        rows = -(-len(block) // (2 * p))
        padded = np.zeros(rows * 2 * p, np.uint64)
        padded[: len(block)] = block
        laid = padded.reshape(rows, 2 * p)
        again = (laid[:, p:] == laid[:, :1]).any(axis=1)
        for at in (np.flatnonzero(again) * 2 * p).tolist():
            first = max(0, at - 2 * p)
            yield Tile(p, at, first, words[first : at + 5 * p].tolist())
        block = mixed(block[:-p] * SCALE + block[p:]) if len(block) > p else block[:0]
        p *= 2


def z_function(s: list[int]) -> list[int]:
    """For each place, the length of the longest common beginning of ``s`` and what starts there."""
    n = len(s)
    z, left, right = [n] + [0] * (n - 1), 0, 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def primes_of(q: int) -> list[int]:
    out, d = [], 2
    while d * d <= q:
        if q % d == 0:
            out.append(d)
            while q % d == 0:
                q //= d
        d += 1
    return [*out, q] if q > 1 else out


def solve(tile: Tile) -> list[tuple[int, int, int]]:
    """(period, start, end): the places of the tile that agree with the word one period later, round its boundary.

    A period that some part of it divides into equal words is a multiple of a smaller one and left out.
    A stretch that ends within the tile on both sides and is too short for a run goes too.
    """
    p, at = tile.octave, tile.boundary - tile.first
    words, out = tile.words, []
    near = z_function(words[at : at + 3 * p])
    periods = [q for q in range(p, min(2 * p, len(near))) if near[q] >= p]
    periods = [q for q in periods if not any(near[q // r] >= q - q // r for r in primes_of(q))]
    if not periods:
        return out
    ahead = z_function(words[at:])
    behind = words[:at][::-1]
    back = z_function([*behind, None, *words[: at + 2 * p - 1][::-1]])
    last = min(at + 2 * p - 1, len(words))
    for q in periods:
        forth = min(ahead[q], 3 * p)
        # The word before the boundary against the one a period later.
        back_by = back[len(behind) + 1 + last - (at + q)] if behind else 0
        open_end = forth == 3 * p or back_by == 2 * p
        if open_end or forth + back_by + q >= max(LEAST_WORDS, LEAST_PERIODS * q):
            out.append((q, tile.boundary - back_by, tile.boundary + forth))
    return out


def found(batch: list[list[bytes]]) -> list[list[tuple[int, int, int]]]:
    """Fragments of each text; places count from its first word."""
    words, starts = numbered(batch)
    out: list[list[tuple[int, int, int]]] = [[] for _ in batch]
    for tile in tiles(words, int(np.diff(starts).max(initial=0))):
        doc = int(np.searchsorted(starts, tile.boundary, "right")) - 1
        for q, start, end in solve(tile):
            out[doc].append((q, start - int(starts[doc]), end - int(starts[doc])))
    return out


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+``, as they are: exactly what bytes split into."""
    return text.encode("utf-8", "replace").split()


def kept_words(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Without what follows the first period of each run (start, length, period)."""
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return [w for w, n in zip(words, np.cumsum(edge[:-1]).tolist(), strict=True) if not n]


FRAGMENTS = "array<struct<period: int, start: int, end: int>>"
RUNS = "array<struct<start: long, length: long, period: long>>"
NUMBERED = "row long, doc_id long, n_words long"


def _record(schema: list[tuple[str, pa.DataType]], columns: list) -> pa.RecordBatch:
    arrays = [c if isinstance(c, pa.Array) else pa.array(c, kind) for c, (_, kind) in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in schema])


def _spotted(rows: DataFrame, keep_text: bool) -> DataFrame:
    """Each row under a number of its own, with its fragments; its text where there are any or ``keep_text``, and the digest of its words where not."""
    fragment = pa.struct([("period", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
    made = [("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("plain_sha256", pa.string()),
            ("text", pa.string()), ("fragments", pa.list_(fragment))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 36
        for batch in slices(batches, "text"):
            given = batch.column("text").to_pylist()
            words = [words_of(t) for t in given]
            seen = found(words)
            digests = [None if s else hashlib.sha256(b" ".join(w)).hexdigest() for w, s in zip(words, seen, strict=True)]
            told = [t if s or keep_text else None for t, s in zip(given, seen, strict=True)]
            cut = [[{"period": q, "start": a, "end": b} for q, a, b in s] for s in seen]
            own = np.arange(number, number + len(given))
            number += len(given)
            yield _record(made, [own, batch.column("doc_id"), list(map(len, words)), digests, told, cut])

    return rows.mapInArrow(run, f"{NUMBERED}, plain_sha256 string, text string, fragments {FRAGMENTS}")


def _numbered_rows(rows: DataFrame) -> DataFrame:
    """Long texts under numbers below zero, which rows of :func:`_spotted` don't have."""
    made = [("row", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("text", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = -1 - (TaskContext.get().partitionId() << 36)
        for batch in slices(batches, "text"):
            sizes = [len(words_of(t)) for t in batch.column("text").to_pylist()]
            own = np.arange(number, number - batch.num_rows, -1)
            number -= batch.num_rows
            yield _record(made, [own, batch.column("doc_id"), sizes, batch.column("text")])

    return rows.mapInArrow(run, f"{NUMBERED}, text string")


def _dealt_tiles(rows: DataFrame) -> DataFrame:
    """The tiles of ``rows`` (row, text) as rows themselves."""
    made = [("row", pa.int64()), ("octave", pa.int64()), ("boundary", pa.int64()), ("first", pa.int64()), ("words", pa.list_(pa.int64()))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            for row, text in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist(), strict=True):
                words, starts = numbered([words_of(text)])
                held, out = 0, []
                for t in tiles(words, int(starts[1])):
                    out.append((row, t.octave, t.boundary, t.first, t.words))
                    held += len(t.words)
                    if held > DEALT_WORDS:
                        yield _record(made, list(zip(*out, strict=True)))
                        held, out = 0, []
                if out:
                    yield _record(made, list(zip(*out, strict=True)))

    return rows.mapInArrow(run, "row long, octave long, boundary long, first long, words array<long>")


def _solved(dealt: DataFrame) -> DataFrame:
    """Fragments (row, period, start, end) of tiles that are rows."""
    made = [("row", pa.int64()), ("period", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(n) for n in ("row", "octave", "boundary", "first", "words")]
            out = [(r.as_py(), *f) for r, *t in zip(*columns, strict=True) for f in solve(Tile(*(x.as_py() for x in t)))]
            if out:
                yield _record(made, list(zip(*out, strict=True)))

    return dealt.mapInArrow(run, "row long, period int, start int, end int")


def stitched(fragments: DataFrame) -> DataFrame:
    """Runs (row, start, length, period) from fragments (row, period, start, end) that overlap or touch.

    Fragments of one stretch always do, and those of two never, for a word that differs lies between them.
    A group has one text's fragments of one period.
    """
    here = Window.partitionBy("row", "period").orderBy("start", "end")
    before = F.max("end").over(here.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(before.isNull() | (F.col("start") > before), 1).otherwise(0)
    joined = (
        fragments.withColumn("opens", opens)
        .withColumn("stretch", F.sum("opens").over(here.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("row", "period", "stretch")
        .agg(F.min("start").cast("long").alias("start"), F.max("end").cast("long").alias("end"))
        .select("row", "start", (F.col("end") - F.col("start") + F.col("period")).alias("length"), F.col("period").cast("long").alias("period"))
    )
    return joined.where(F.col("length") >= F.greatest(F.lit(LEAST_WORDS), LEAST_PERIODS * F.col("period")))


def _with_runs(docs: DataFrame, long_text: int, keep_text: bool = False) -> DataFrame:
    """``doc_id``, ``n_words``, ``text``, ``runs`` by start and period, and the digest of the words of rows whose text isn't kept."""
    rows = texts(docs)
    short = kept_table(_spotted(rows.where(F.length("text") <= long_text), keep_text))
    long_ones = kept_table(_numbered_rows(rows.where(F.length("text") > long_text)))
    dealt = _solved(_dealt_tiles(long_ones.select("row", "text")).repartition("row", "octave", "boundary"))
    fragments = short.select("row", F.inline("fragments")).unionByName(dealt)
    in_order = F.sort_array(F.collect_list(F.struct("start", "length", "period"))).alias("runs")
    runs = stitched(fragments).groupBy("row").agg(in_order)
    none, missing = F.array().cast(RUNS), F.lit(None).cast("string")
    columns = ("row", "doc_id", "n_words", "plain_sha256", "text")
    sighted = short.where(F.size("fragments") > 0).select(*columns)
    sighted = sighted.unionByName(long_ones.withColumn("plain_sha256", missing).select(*columns))
    sighted = sighted.join(runs, "row", "left").withColumn("runs", F.coalesce("runs", none))
    plain = short.where(F.size("fragments") == 0).select(*columns, none.alias("runs"))
    return plain.unionByName(sighted).drop("row")


def repeated_runs(docs: DataFrame, long_text: int = LONG_TEXT) -> DataFrame:
    """``doc_id``, ``n_words`` and ``runs`` (start, length, period) of every row, by start and period.

    A run is a stretch of at least six words that repeats with a smallest period, at least four
    times, and that no neighbouring word extends. A null or empty text has no words and no runs. Repeated
    rows and ids count each by itself.
    """
    return _with_runs(docs, long_text).select("doc_id", "n_words", "runs")


def collapsed(docs: DataFrame, long_text: int = LONG_TEXT) -> DataFrame:
    """``doc_id`` and the ``text`` with each run cut to its first period, its words joined by one space; null becomes empty."""
    made = [("doc_id", pa.int64()), ("text", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            runs = [[tuple(r.values()) for r in of] for of in batch.column("runs").to_pylist()]
            given = batch.column("text").to_pylist()
            out = [b" ".join(kept_words(words_of(t), r)).decode("utf-8", "replace") for t, r in zip(given, runs, strict=True)]
            yield _record(made, [batch.column("doc_id"), out])

    return _with_runs(docs, long_text, keep_text=True).select("doc_id", "text", "runs").mapInArrow(run, "doc_id long, text string")


REPORT = (
    "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, "
    "runs_sha256 string, collapsed_sha256 string"
)


def described(text: str | None, runs: list[tuple[int, int, int]], plain_sha256: str | None) -> tuple:
    """What the report says of one text with its runs (start, length, period)."""
    best: tuple | None = None
    for start, length, period in runs:
        if best is None or length * best[2] > best[1] * period:
            best = (start, length, period)
    listed = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    told = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    kept = plain_sha256 or hashlib.sha256(b" ".join(kept_words(words_of(text or ""), runs))).hexdigest()
    return len(runs), *told, hashlib.sha256(listed.encode()).hexdigest(), kept


def report(docs: DataFrame, long_text: int = LONG_TEXT) -> DataFrame:
    """One row per document: number of runs, the run with the greatest exponent, digests of all runs and of the collapsed text.

    Of equal exponents the first start counts, then the smaller period; without runs the four columns are null.
    """
    made = [("doc_id", pa.int64()), *((n, pa.int64()) for n in ("n_runs", "start", "length", "period", "exponent_milli")),
            ("runs_sha256", pa.string()), ("collapsed_sha256", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            runs = [[tuple(r.values()) for r in of] for of in batch.column("runs").to_pylist()]
            given = zip(batch.column("text").to_pylist(), runs, batch.column("plain_sha256").to_pylist(), strict=True)
            yield _record(made, [batch.column("doc_id"), *zip(*(described(*x) for x in given), strict=True)])

    return _with_runs(docs, long_text).mapInArrow(run, REPORT)


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """The documents of the report's query: those whose crc32(doc_id as text) ends in 0 repeat a stretch of their words to their end.

    From word a on, word i is word a + (i - a) mod p; a and p follow from the other digits of that number.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # Bound as a variable, so that the text is split once and not once for each word.
    again = """transform(array(words), ws -> array_join(transform(ws, (w, i) -> if(
        i < g % size(ws), w,
        ws[int(g % size(ws) + (i - g % size(ws)) % (1 + (size(ws) - g % size(ws)) div (3 + g % 8)))])), ' '))[0]"""
    laid = texts(docs).select("doc_id", "text", h.alias("h"), F.floor(h / 10).cast("long").alias("g"), words.alias("words"))
    return laid.select("doc_id", F.expr(f"if(h % 10 = 0 and text rlike '[^\\\\x20\\\\x09-\\\\x0D]', {again}, text)").alias("text"))


def planted_report(docs: DataFrame) -> DataFrame:
    return report(with_planted_periods(docs))
