"""Language-model scoring by deleted interpolation of word pairs and words.

Counts of all training words and word pairs are summed on the executors. A chunk of
documents asks for the counts of the distinct words and pairs that it holds, so
a very common pair is asked for once a chunk and no key gathers rows. The weights
that mix maximum-likelihood pair estimates with word estimates depend on how often
the context was seen, and are learned by expectation-maximisation on training
documents that were left out of the counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import ascii_words, hashed, held_out, mixed, remainder, slices, texts
from ledgerline.sources.cuts import kept_table

FOLDS, HELD_FOLD, WEIGHT_FOLD = 5, 1, 2
#: Parts of the documents: counted for the weights, held out for them, and never learnt from.
COUNTED, WEIGHING, UNSEEN = 0, 1, 2
CHUNK_CHARS = 5_000_000
BUCKET_CHARS = 4_000_000
#: Parquet's reader holds a row group of such long rows at once: as many chunks, or rows of their answers.
CHUNKS_A_GROUP, ANSWERED_CHUNKS_A_GROUP = 4, 2
WORDS_A_PASS = 200_000
KEY_BITS = np.uint64(40)
KEY_MASK = np.uint64(2**40 - 1)
START, END = np.uint64(0x5353535353535353), np.uint64(0x4545454545454545)
RATIO_STEP = 0.02
ROUNDS = 60


@dataclass
class Chunk:
    """Words and pairs of some documents, each document closed by an end and opened by a start."""

    first: np.ndarray  # place of each document's first token
    words: np.ndarray  # distinct word hashes, the start among them
    pairs: np.ndarray  # distinct pair keys under their bucket, in order
    token: np.ndarray  # index into words, for each token
    context: np.ndarray  # index into words, of what stands before
    pair: np.ndarray  # index into pairs
    by_bucket: np.ndarray  # order of words by bucket

    @classmethod
    def of(cls, batch: list[str], buckets: int) -> Chunk:
        token, first = _tokens(batch)
        pairs, pair_at = np.unique(_pair_keys(token, first, buckets), return_inverse=True)
        pair_at = pair_at.astype(np.int32)
        words, index = np.unique(np.append(token, START), return_inverse=True)
        index = index.astype(np.int32)
        context_at = np.concatenate((index[-1:], index[:-2]))
        context_at[first] = index[-1]
        order = np.argsort(word_bucket(words, buckets), kind="stable")
        return cls(first, words, pairs, index[:-1], context_at, pair_at, order)


def _tokens(batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each token, an end after each document, and the place of each document's first token."""
    parts, sizes, waiting = [], [], []
    for text in batch:
        own = ascii_words(text)
        sizes.append(len(own))
        waiting += own
        if len(waiting) >= WORDS_A_PASS:
            parts.append(hashed(waiting))
            waiting = []
    parts.append(hashed(waiting))
    h = np.concatenate(parts)
    h[(h == START) | (h == END)] += np.uint64(1)
    ends = np.cumsum(sizes, dtype=np.int64)
    return np.insert(h, ends, END), np.concatenate(([0], ends[:-1])) + np.arange(len(sizes))


def _pair_keys(token: np.ndarray, first: np.ndarray, buckets: int) -> np.ndarray:
    """Key of each token and what stands before, under the pair's bucket."""
    context = np.concatenate(([START], token[:-1]))
    context[first] = START
    key = mixed(mixed(context) * np.uint64(3) + token)
    return ((key >> KEY_BITS) % np.uint64(buckets)) << KEY_BITS | (key & KEY_MASK)


def word_bucket(words: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(words) % np.uint64(buckets)).astype(np.int64)


def packed(ids: list[int | None], whole: list[str]) -> bytes:
    """Ids and texts of a chunk as one compressed value, less than half as long: executors hold, sort and shuffle that."""
    rows = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(whole, pa.large_string())], names=["id", "text"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(rows)
    return sink.getvalue().to_pybytes()


def unpacked(value: bytes | pa.Buffer) -> tuple[list[int | None], list[str]]:
    with pa.ipc.open_stream(value) as rows:
        batch = rows.read_next_batch()
    return batch.column("id").to_pylist(), batch.column("text").to_pylist()


def chunked(docs: DataFrame) -> DataFrame:
    """Rows of about ``CHUNK_CHARS`` of text of one part: ``chunk, part, chars, packed``.

    Chunks are made where the documents are read, without a shuffle, and stored; what they
    hold is fixed from then on, whatever task runs again.
    """
    fold = remainder(FOLDS)
    part = F.when(fold == WEIGHT_FOLD, WEIGHING).when(fold == HELD_FOLD, UNSEEN).when(fold.isNull(), UNSEEN).otherwise(COUNTED)
    rows = texts(docs).withColumn("part", part.cast("int"))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n = TaskContext.get().partitionId() << 24, 0
        waiting: dict[int, tuple[list, list, list]] = {p: ([], [], [0]) for p in (COUNTED, WEIGHING, UNSEEN)}

        def emit(p: int) -> pa.RecordBatch:
            ids, whole, size = waiting[p]
            made = pa.RecordBatch.from_arrays(
                [
                    pa.array([base + n], pa.int64()),
                    pa.array([p], pa.int32()),
                    pa.array([sum(map(len, whole))], pa.int64()),
                    pa.array([packed(ids, whole)], pa.binary()),
                ],
                names=["chunk", "part", "chars", "packed"],
            )
            waiting[p] = ([], [], [0])
            return made

        for batch in slices(batches, "text"):
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "text", "part"))
            for doc_id, text, p in zip(*columns, strict=True):
                ids, whole, size = waiting[p]
                ids.append(doc_id)
                whole.append(text)
                size[0] += len(text) + 8
                if size[0] >= CHUNK_CHARS:
                    yield emit(p)
                    n += 1
        for p in waiting:
            if waiting[p][0]:
                yield emit(p)
                n += 1

    return kept_table(rows.mapInArrow(gather, "chunk long, part int, chars long, packed binary"), CHUNKS_A_GROUP)


REQUEST = "bucket int, chunk long, part int, words array<bigint>, word_n array<int>, high array<int>, low array<tinyint>, pair_n array<int>"
ANSWER = "bucket int, chunk long, part int, word_all array<bigint>, word_fit array<bigint>, pair_all array<bigint>, pair_fit array<bigint>"


def _slices(values: np.ndarray, ends: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values, kind))


def distinct_counts(batch: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words by bucket and distinct pairs in order, as a ``Chunk`` has them, each with its counts in the texts."""
    token, first = _tokens(batch)
    pairs, pair_n = np.unique(_pair_keys(token, first, buckets), return_counts=True)
    words, word_n = np.unique(np.append(token, START), return_counts=True)
    word_n[np.searchsorted(words, START)] = len(first)
    order = np.argsort(word_bucket(words, buckets), kind="stable")
    return words[order], word_n[order], pairs, pair_n


def requests(chunks: DataFrame, buckets: int) -> DataFrame:
    """A row for each chunk and bucket: the distinct words and pairs with their counts in the chunk."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, part, value in zip(*(batch.column(c) for c in ("chunk", "part", "packed")), strict=True):
                words, word_n, pairs, pair_n = distinct_counts(unpacked(value.as_buffer())[1], buckets)
                word_ends = np.searchsorted(word_bucket(words, buckets), np.arange(buckets + 1))
                pair_ends = np.searchsorted(pairs >> KEY_BITS, np.arange(buckets + 1, dtype=np.uint64))
                key = pairs & KEY_MASK
                made = pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(buckets, dtype=np.int32)),
                        pa.array(np.full(buckets, chunk.as_py(), np.int64)),
                        pa.array(np.full(buckets, part.as_py(), np.int32)),
                        _slices(words.view(np.int64), word_ends, pa.int64()),
                        _slices(word_n.astype(np.int32), word_ends, pa.int32()),
                        _slices((key >> np.uint64(8)).astype(np.uint32).view(np.int32), pair_ends, pa.int32()),
                        _slices((key & np.uint64(255)).astype(np.uint8).view(np.int8), pair_ends, pa.int8()),
                        _slices(pair_n.astype(np.int32), pair_ends, pa.int32()),
                    ],
                    names=[n.split()[0] for n in REQUEST.split(", ")],
                )
                some = (np.diff(word_ends) > 0) | (np.diff(pair_ends) > 0)
                yield made.filter(pa.array(some))

    return chunks.mapInArrow(ask, REQUEST)


def _summed(keys: np.ndarray, n: np.ndarray, part: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of each request, and the counts of each distinct key in all training text and in the counted part."""
    distinct, index = np.unique(keys, return_inverse=True)
    total = np.bincount(index, n * (part != UNSEEN), len(distinct)).astype(np.int64)
    fit = np.bincount(index, n * (part == COUNTED), len(distinct)).astype(np.int64)
    return distinct, index, np.stack([total, fit])


def answers(asked: DataFrame) -> DataFrame:
    """Each request with the corpus counts of its words and pairs, in the order asked.

    A row with chunk -1 has the bucket's distinct training words, training tokens and counted tokens.
    """

    def flat(column: pd.Series, kind: type) -> np.ndarray:
        return np.concatenate([np.asarray(v, kind) for v in column])

    def answer(rows: pd.DataFrame) -> pd.DataFrame:
        out = {"word_all": [], "word_fit": [], "pair_all": [], "pair_fit": []}
        part = rows.part.to_numpy()
        keys = flat(rows["words"], np.int64).view(np.uint64)
        sizes = rows["words"].map(len).to_numpy()
        distinct, index, counts = _summed(keys, flat(rows.word_n, np.int64), np.repeat(part, sizes))
        own = distinct != START
        totals = [int(((counts[0] > 0) & own).sum()), int(counts[0][own].sum()), int(counts[1][own].sum())]
        high = flat(rows.high, np.int32).view(np.uint32).astype(np.uint64) << np.uint64(8)
        pair_sizes = rows.high.map(len).to_numpy()
        pair_keys = high | flat(rows.low, np.int8).view(np.uint8)
        _, pair_index, pair_counts = _summed(pair_keys, flat(rows.pair_n, np.int64), np.repeat(part, pair_sizes))
        for name, at, n, table in (("word", index, sizes, counts), ("pair", pair_index, pair_sizes, pair_counts)):
            ends = np.cumsum(n)[:-1]
            out[f"{name}_all"] = np.split(table[0][at], ends)
            split = np.split(table[1][at], ends)
            out[f"{name}_fit"] = [v if p == WEIGHING else v[:0] for v, p in zip(split, part, strict=True)]
        made = pd.DataFrame({"bucket": rows.bucket.to_numpy(), "chunk": rows.chunk.to_numpy(), "part": part, **out})
        none = np.zeros(0, np.int64)
        extra = {"bucket": rows.bucket.iloc[0], "chunk": -1, "part": -1, "word_all": np.array(totals)}
        extra |= {"word_fit": none, "pair_all": none, "pair_fit": none}
        return pd.concat([made, pd.DataFrame([extra])], ignore_index=True)

    return asked.groupBy("bucket").applyInPandas(answer, ANSWER)


def context_bucket(seen: np.ndarray) -> np.ndarray:
    """Contexts seen 0, 1, 2-3, 4-7, ... times share a weight."""
    return np.frexp(seen.astype(np.float64))[1]


def _counts(c: Chunk, rows: pd.DataFrame, which: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Corpus counts of each token, its context and the pair of both."""
    rows = rows.sort_values("bucket")
    words = np.empty(len(c.words), np.int64)
    words[c.by_bucket] = np.concatenate([np.asarray(v, np.int64) for v in rows[f"word_{which}"]])
    pairs = np.concatenate([np.asarray(v, np.int64) for v in rows[f"pair_{which}"]])
    return words[c.token], words[c.context], pairs[c.pair]


def _word_estimate(n: np.ndarray, tokens: int, distinct: int) -> np.ndarray:
    return (n + 0.5) / (tokens + 0.5 * (distinct + 1))


def weights_of(histogram: pd.DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    """Weight of the pair estimate for each context bucket by expectation-maximisation.

    ``histogram`` has held-out tokens by context bucket and by the ratio of pair to word estimate
    (``step`` of ``RATIO_STEP`` decades, null where the pair is new). Only that ratio enters
    the expectation. A bucket without held-out tokens takes the weight of the next lower one.
    """
    out = np.zeros(64)
    for bucket in range(1, 64):
        own = histogram[histogram.context_bucket == bucket]
        weight, n = 0.5, own.n.to_numpy(np.float64)
        if not n.sum():
            out[bucket] = out[bucket - 1] if bucket > 1 else weight
            continue
        steps = own.step.to_numpy(np.float64)
        ratio = np.where(np.isnan(steps), 0.0, 10 ** (np.nan_to_num(steps) * RATIO_STEP))
        for _ in range(rounds):
            weight = float((n * weight * ratio / (weight * ratio + 1 - weight)).sum() / n.sum())
            weight = min(max(weight, 1e-6), 1 - 1e-6)
        out[bucket] = weight
    return out


def _histogram(left: pd.DataFrame, right: pd.DataFrame, buckets: int, tokens: int, distinct: int) -> pd.DataFrame:
    out = []
    for row in left.itertuples():
        c = Chunk.of(unpacked(row.packed)[1], buckets)
        token, context, pair = _counts(c, right, "fit")
        seen = context > 0
        ratio = pair[seen] / context[seen] / _word_estimate(token[seen], tokens, distinct)
        step = np.full(len(ratio), np.nan)
        step[ratio > 0] = np.round(np.log10(ratio[ratio > 0]) / RATIO_STEP)
        frame = pd.DataFrame({"context_bucket": context_bucket(context[seen]), "step": step, "n": 1})
        out.append(frame.groupby(["context_bucket", "step"], dropna=False, as_index=False).n.sum())
    made = pd.concat(out) if out else pd.DataFrame({"context_bucket": [], "step": [], "n": []})
    return made.astype({"context_bucket": "int32", "step": "Int32", "n": "int64"})


def _scores(
    left: pd.DataFrame, right: pd.DataFrame, buckets: int, tokens: int, distinct: int, weights: np.ndarray
) -> pd.DataFrame:
    out = []
    for row in left.itertuples():
        ids, whole_texts = unpacked(row.packed)
        c = Chunk.of(whole_texts, buckets)
        token, context, pair = _counts(c, right, "all")
        by_word = _word_estimate(token, tokens, distinct)
        weight = np.where(context > 0, weights[context_bucket(context)], 0.0)
        whole = np.log10(weight * pair / np.maximum(context, 1) + (1 - weight) * by_word)
        frame = pd.DataFrame({"doc_id": pd.array(ids, "Int64")})
        frame["n_tokens"] = np.diff(np.append(c.first, len(c.token)))
        frame["n_known"] = np.add.reduceat((token > 0).astype(np.int64), c.first)
        frame["base_score"] = np.add.reduceat(np.log10(by_word), c.first)
        frame["score"] = np.add.reduceat(whole, c.first)
        out.append(frame)
    return pd.concat(out) if out else pd.DataFrame({"doc_id": [], "n_tokens": [], "n_known": [], "base_score": [], "score": []})


def language_scores(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of each row of ``docs``.

    Words are what ASCII white space parts, A-Z lower-cased; each document ends with one more
    token. ``base_score`` is the log10 probability by words alone, ``score`` by the mixture. A null or
    empty text is its end alone. Repeated rows count and score each time. A row with a null id is
    in no fold: it is scored, not learnt from and not called held out. Words are told apart
    by 64 bits; pairs by 40 bits and their bucket, of which there are as many as the text needs.
    """
    chunks = chunked(docs)
    buckets = max(1, -(-(chunks.agg(F.sum("chars")).first()[0] or 0) // BUCKET_CHARS))
    answered = kept_table(answers(requests(chunks, buckets)), ANSWERED_CHUNKS_A_GROUP * buckets)
    totals = answered.where("chunk = -1").select(F.explode(F.arrays_zip(F.array(*map(F.lit, range(3))), "word_all")).alias("t"))
    rows = totals.groupBy(F.col("t")["0"].alias("k")).agg(F.sum(F.col("t")["word_all"]).alias("n")).collect()
    distinct, tokens, counted = (dict((r.k, r.n) for r in rows).get(k, 0) for k in range(3))

    def joined(part_of: DataFrame, rows_of: DataFrame, f, schema: str) -> DataFrame:
        return part_of.groupBy("chunk").cogroup(rows_of.groupBy("chunk")).applyInPandas(f, schema)

    def counting(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _histogram(left, right, buckets, counted, distinct)

    histogram = joined(
        chunks.where(F.col("part") == WEIGHING),
        answered.where(F.col("part") == WEIGHING),
        counting,
        "context_bucket int, step int, n long",
    )
    weights = weights_of(histogram.groupBy("context_bucket", "step").agg(F.sum("n").alias("n")).toPandas())

    def scoring(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return _scores(left, right, buckets, tokens, distinct, weights)

    result = joined(
        chunks,
        answered.where("chunk >= 0").select("bucket", "chunk", "word_all", "pair_all"),
        scoring,
        "doc_id long, n_tokens long, n_known long, base_score double, score double",
    )
    return result.select(
        "doc_id", held_out(FOLDS, HELD_FOLD), "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score"
    )
