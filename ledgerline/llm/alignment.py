"""Cross-tokenizer alignment by divide and conquer at shared cuts.

Two vocabularies cut the same bytes into tokens. A byte offset at which tokens of both
end is a shared cut. A common end near the middle of an interval is found by bisecting the
other side's ends; both halves are then searched in the same way, and an interval
without any cut is a group. All intervals of a batch take a step together.

The two tokens that end at a cut are linked. How often a pair of ids is linked is counted
over the whole corpus: the most frequent pairs, of which there is a fixed number, are
looked up without a shuffle, so that no join key is hot; all others by a join.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property
from itertools import pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import slices, texts
from ledgerline.sources.cuts import kept_table

BYTE_VOCABULARY = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
SLICE_BYTES = 1_000_000
#: Pairs looked up without a shuffle: at most so many are sent to every executor, about 6 MB.
HOT_PAIRS = 2**18
#: Chunks whose pieces a worker remembers, and the longest such chunk.
MEMO_CHUNKS, MEMO_LENGTH = 150_000, 48
#: Words over so many characters are merged by the library that does it in n log n.
LONG_WORD = 1_000

# A chunk starts with one space between two characters that are not white space; other white space stays inside.
CHUNK = re.compile(r"\s*+\S++(?:(?! \S)\s++\S++)*+(?:\s++\Z)?|\s++")
# How the byte-level vocabulary cuts a text before merging: contractions, letters, digits, signs, white space.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary: printable ones as they are, the rest from 256 on."""
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    known = set(plain)
    others = [b for b in range(256) if b not in known]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


@dataclass(frozen=True)
class Spelling:
    """The bytes of every token of a vocabulary, by id."""

    tokens: tuple[bytes, ...]

    @cached_property
    def lengths(self) -> np.ndarray:
        return np.fromiter(map(len, self.tokens), np.int64, len(self.tokens))

    @cached_property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.lengths) - self.lengths

    @cached_property
    def letters(self) -> np.ndarray:
        return np.frombuffer(b"".join(self.tokens), np.uint8)

    def spelt(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of a sequence of ids."""
        at, _ = ranges(self.starts[ids], self.starts[ids] + self.lengths[ids])
        return self.letters[at]


class ByteCoder:
    """Byte-level BPE from a vocabulary in JSON. Strings of special tokens are plain text."""

    def __init__(self, source: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(source)
        self.library.encode_special_tokens = True
        read = json.loads(source)
        letters = byte_letters()
        special = {t["id"]: t["content"].encode() for t in read.get("added_tokens", ())}
        named = {i: t for t, i in self.library.get_vocab().items()}
        raw = {i: bytes(letters[c] for c in t) for i, t in named.items() if i not in special}
        self.spelling = Spelling(tuple(special.get(i, raw.get(i, b"")) for i in range(max(named) + 1)))
        self.quick = self._merges_by_id(read["model"], raw)

    def _merges_by_id(self, model: dict, raw: dict[int, bytes]):
        """A faster merger of the same vocabulary, if merges rank as the ids of what they make; else none."""
        import tiktoken

        made = [model["vocab"].get("".join(m if isinstance(m, list) else m.split(" "))) for m in model["merges"]]
        if made != list(range(256, 256 + len(made))) or set(range(256)) - set(raw):
            return None
        ranks = {raw[i]: i for i in range(256 + len(made))}
        return tiktoken.Encoding("by-id", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        out = []
        for text in batch:
            long_word = self.quick is None or max(map(len, text.split()), default=0) > LONG_WORD
            ids = self.library.encode(text, add_special_tokens=False).ids if long_word else self.quick.encode_ordinary(text)
            out.append(np.array(ids, np.int64))
        return out


class PieceCoder:
    """A sentence-piece model. Words are encoded once and remembered where the model merges no two of them."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = self.library.get_piece_size()
        pieces = [self.library.id_to_piece(i) for i in range(n)]
        plain = [not (self.library.is_control(i) or self.library.is_unknown(i)) for i in range(n)]
        spelt = [
            bytes([int(p[3:5], 16)]) if self.library.is_byte(i) else p.replace(MARK, " ").encode() if plain[i] else p.encode()
            for i, p in enumerate(pieces)
        ]
        self.spelling = Spelling(tuple(spelt))
        # Independent words: no piece holds a mark after another character, and nothing is rewritten before merging.
        probe = " ﬁ①  é\tx "
        kept = self.spelling.spelt(np.array(self.library.encode(probe), np.int64)).tobytes() == f" {probe}".encode()
        self.independent = kept and not any(MARK in p.lstrip(MARK) for p, real in zip(pieces, plain, strict=True) if real)
        self.memo: dict[str, bytes] = {}

    def encode(self, batch: list[str]) -> list[np.ndarray]:
        if not self.independent:
            return [np.array(self.library.encode(t), np.int64) for t in batch]
        if len(self.memo) > MEMO_CHUNKS:
            self.memo.clear()
        cut, known = [CHUNK.findall(f" {t}") for t in batch], self.memo
        new = list({c for chunks in cut for c in chunks if c not in known})
        # The leading space is the one that the model adds.
        for chunk, ids in zip(new, self.library.encode([c[1:] for c in new]), strict=True):
            known[chunk] = np.array(ids, np.int32).tobytes()
        out = [np.frombuffer(b"".join(map(known.__getitem__, chunks)), np.int32).astype(np.int64) for chunks in cut]
        for chunk in new:
            if len(chunk) > MEMO_LENGTH:
                del known[chunk]
        return out


def ranges(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers ``lo``..``hi`` - 1 of all rows one after the other, and the row of each."""
    n = np.maximum(hi - lo, 0)
    row = np.repeat(np.arange(len(n)), n)
    first = np.cumsum(n) - n
    return np.arange(len(row)) + (lo - first)[row], row


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Places in ``ends_a`` of the ends inside the intervals ``lo``..``hi`` - 1 that ``ends_b`` has too, unordered.

    Both are ascending. Each step looks in every open interval for the common end nearest to
    the middle: first the middle itself, then twice as far each time. Where there is one, the
    interval splits; where nothing is left to look at, it is a leaf.
    """
    found = []
    lo, hi, near = lo[lo < hi], hi[lo < hi], np.zeros(int((lo < hi).sum()), np.int64)
    while len(lo):
        mid = (lo + hi) // 2
        far = np.maximum(1, 2 * near)
        left, of_left = ranges(np.maximum(lo, mid - far + 1), np.maximum(lo, mid - near + 1))
        right, of_right = ranges(np.minimum(hi, mid + np.maximum(near, 1)), np.minimum(hi, mid + far))
        at, row = np.concatenate([left, right]), np.concatenate([of_left, of_right])
        place = np.searchsorted(ends_b, ends_a[at])
        common = ends_b[np.minimum(place, len(ends_b) - 1)] == ends_a[at]
        at, row = at[common], row[common]
        order = np.lexsort((np.abs(at - mid[row]), row))
        at, row = at[order], row[order]
        first = np.ones(len(row), bool)
        first[1:] = row[1:] != row[:-1]
        cut, split = at[first], row[first]
        found.append(cut)
        on = np.ones(len(lo), bool)
        on[split] = False
        on &= (mid - far >= lo) | (mid + far < hi)
        next_lo = np.concatenate([np.column_stack([lo[split], cut + 1]).ravel(), lo[on]])
        next_hi = np.concatenate([np.column_stack([cut, hi[split]]).ravel(), hi[on]])
        near = np.concatenate([np.zeros(2 * len(split), np.int64), far[on]])
        open_ = next_lo < next_hi
        lo, hi, near = next_lo[open_], next_hi[open_], near[open_]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


@dataclass
class Aligned:
    """Tokens of a batch, one document after the other, and where shared cuts end groups."""

    a: np.ndarray
    b: np.ndarray
    first_a: np.ndarray
    first_b: np.ndarray
    last_a: np.ndarray
    last_b: np.ndarray

    def groups(self) -> np.ndarray:
        """Number of cuts before each document, and at the end of all."""
        return np.concatenate([[0], np.cumsum(self.last_a)])[self.first_a]


class Aligner:
    def __init__(self, byte_vocabulary: str, piece_model: bytes):
        self.a, self.b = ByteCoder(byte_vocabulary), PieceCoder(piece_model)
        self.width = len(self.b.spelling.tokens)
        # Each token with what follows it: a comma within its half of a group, or the sign that ends the half.
        self.written = [f"{i}{sign}" for i in range(len(self.a.spelling.tokens)) for sign in ",|"]
        self.written += [f"{i}{sign}" for i in range(self.width) for sign in ",;"]

    def align(self, batch: list[str]) -> Aligned:
        raw = [f" {t}".encode("utf-8", "replace") if t else b"" for t in batch]
        tokens = [[ids if t else ids[:0] for t, ids in zip(batch, made, strict=True)] for made in (
            self.a.encode([f" {t}" for t in batch]), self.b.encode(batch))]
        # A document that one side spells otherwise has no tokens.
        kept = [
            all(x.spelling.spelt(ids).tobytes() == r for x, ids in ((self.a, a), (self.b, b)))
            for r, a, b in zip(raw, *tokens, strict=True)
        ]
        flat, first = [], []
        for side in tokens:
            own = [ids if k else ids[:0] for ids, k in zip(side, kept, strict=True)]
            flat.append(np.concatenate([np.zeros(0, np.int64), *own]))
            first.append(np.cumsum([0, *map(len, own)]))
        (a, b), (first_a, first_b) = flat, first
        ends_a, ends_b = (np.cumsum(s.lengths[ids]) for s, ids in ((self.a.spelling, a), (self.b.spelling, b)))
        last_a, last_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        some = first_a[1:] > first_a[:-1]
        # A document's last end is a cut; the search is for those inside.
        last_a[first_a[1:][some] - 1] = True
        last_a[shared_cuts(ends_a, ends_b, first_a[:-1][some], first_a[1:][some] - 1)] = True
        if len(a):
            last_b[np.searchsorted(ends_b, ends_a[last_a])] = True
        return Aligned(a, b, first_a, first_b, last_a, last_b)

    def texts_of(self, x: Aligned) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for each document, '' for one without tokens."""
        group_a, group_b = (np.cumsum(last) - last for last in (x.last_a, x.last_b))
        ends_of_a, ends_of_b = (np.flatnonzero(last) + 1 for last in (x.last_a, x.last_b))
        before_b = np.concatenate([[0], ends_of_b])
        out = np.empty(len(x.a) + len(x.b), np.int64)
        out[np.arange(len(x.a)) + before_b[group_a]] = 2 * x.a + x.last_a
        if len(x.b):
            out[np.arange(len(x.b)) + ends_of_a[group_b]] = 2 * (len(self.a.spelling.tokens) + x.b) + x.last_b
        codes, at = out.tolist(), (x.first_a + x.first_b).tolist()
        return ["".join(map(self.written.__getitem__, codes[s:e]))[:-1] for s, e in pairwise(at)]

    def links(self, x: Aligned) -> tuple[np.ndarray, np.ndarray]:
        """The id pair of every link, and the document it is in."""
        pairs = x.a[x.last_a] * self.width + x.b[x.last_b]
        return pairs, np.searchsorted(x.first_a, np.flatnonzero(x.last_a), "right") - 1


_ALIGNERS: dict[int, Aligner] = {}


def aligner(byte_vocabulary: str, piece_model: bytes) -> Aligner:
    """This worker's aligner; it outlives a task, with its memory of words."""
    key = hash((byte_vocabulary, piece_model))
    if key not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[key] = Aligner(byte_vocabulary, piece_model)
    return _ALIGNERS[key]


def vocabularies(byte_vocabulary: str = BYTE_VOCABULARY, piece_model: str = PIECE_MODEL) -> tuple[str, bytes]:
    """Read on the driver; executors get both with the task, so they need no files."""
    return Path(byte_vocabulary).read_text(), Path(piece_model).read_bytes()


def _lists(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values))


def alignments(docs: DataFrame, files: tuple[str, bytes] | None = None) -> DataFrame:
    """``doc_id``, the ids of both sides, and for each group the number of ids up to its end on each side.

    One row for each row. A null or empty text has no ids, nor has one that a side spells
    otherwise (a text with the mark itself). Repeated rows are aligned each by itself.
    """
    files = files or vocabularies()
    schema = "doc_id long, a_ids array<long>, b_ids array<long>, a_ends array<long>, b_ends array<long>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(*files)
        for batch in slices(batches, "text", SLICE_BYTES):
            x = own.align(batch.column("text").to_pylist())
            cuts = x.groups()
            ends = [np.flatnonzero(last) + 1 for last in (x.last_a, x.last_b)]
            local = [e - np.repeat(first[:-1], np.diff(cuts)) for e, first in zip(ends, (x.first_a, x.first_b), strict=True)]
            columns = [_lists(x.a, x.first_a), _lists(x.b, x.first_b), *(_lists(e, cuts) for e in local)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns], names=["doc_id", "a_ids", "b_ids", "a_ends", "b_ends"]
            )

    return texts(docs).mapInArrow(run, schema)


def _aligned_documents(docs: DataFrame, files: tuple[str, bytes]) -> DataFrame:
    """A row's own number, its counts and digest, and its distinct links with how often it has each."""
    schema = (
        "row long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, pairs array<long>, times array<int>"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, number = aligner(*files), TaskContext.get().partitionId() << 36
        for batch in slices(batches, "text", SLICE_BYTES):
            x = own.align(batch.column("text").to_pylist())
            pairs, doc = own.links(x)
            span = len(own.a.spelling.tokens) * own.width
            distinct, times = np.unique(doc * span + pairs, return_counts=True)
            ends = np.searchsorted(distinct, np.arange(batch.num_rows + 1) * span)
            digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in own.texts_of(x)]
            columns = [
                pa.array(np.arange(number, number + batch.num_rows)),
                batch.column("doc_id"),
                pa.array(np.diff(x.first_a)),
                pa.array(np.diff(x.first_b)),
                pa.array(np.diff(x.groups())),
                pa.array(digests, pa.string()),
                _lists(distinct % span, ends),
                _lists(times.astype(np.int32), ends),
            ]
            number += batch.num_rows
            yield pa.RecordBatch.from_arrays(
                columns, names=["row", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"]
            )

    return texts(docs).mapInArrow(run, schema)


def linked_pairs(links: DataFrame, width: int) -> DataFrame:
    """``pair``, ``count`` over all ``links`` (pair, times), and ``best``: no pair of the same B id has more.

    B ids are at most ``width``, which bounds what is broadcast.
    """
    counts = links.groupBy("pair").agg(F.sum("times").alias("count"))
    counts = kept_table(counts.withColumn("b", F.col("pair") % width))
    most = counts.groupBy("b").agg(F.max("count").alias("most"))
    return counts.join(F.broadcast(most), "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))


def report(docs: DataFrame, files: tuple[str, bytes] | None = None, hot_pairs: int = HOT_PAIRS) -> DataFrame:
    """One row per document: token, group and link counts, link frequencies over the corpus, digest of the groups.

    ``n_best`` counts links whose pair is the most frequent one of its B id, ``count_sum`` adds
    up the frequencies of all links. Documents without tokens have zeros and an empty digest. Repeated
    rows count each. An empty table gives an empty result.
    """
    files = files or vocabularies()
    width = aligner(*files).width
    stored = kept_table(_aligned_documents(docs, files))
    links = stored.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("link")).select(
        "row", F.col("link.pairs").alias("pair"), F.col("link.times").cast("long").alias("times")
    )
    priced = kept_table(linked_pairs(links, width))
    hot = priced.orderBy(F.desc("count"), "pair").limit(hot_pairs)
    looked_up = links.join(F.broadcast(hot), "pair", "left")
    rare = looked_up.where("count is null").select("row", "pair", "times").join(priced, "pair")
    sums = [
        F.sum("times").alias("n_links"),
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("count")).alias("count_sum"),
    ]
    columns = ("row", "times", "best", "count")
    each = looked_up.where("count is not null").select(*columns).unionByName(rare.select(*columns)).groupBy("row").agg(*sums)
    none = {n: F.coalesce(n, F.lit(0).cast("long")) for n in ("n_links", "n_best", "count_sum")}
    return (
        stored.drop("pairs", "times")
        .join(each, "row", "left")
        .withColumns(none)
        .select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    )
