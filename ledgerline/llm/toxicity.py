"""Toxic spans by a linear-chain conditional random field over the words of each line.

Labels exist for documents only. Words and word beginnings whose document
frequency among toxic training documents stands out become the indicators, and
a token counts as labelled toxic where an indicator occurs in a document labelled toxic. The
field learns from those labelled tokens which occurrences to tag. Its
forward-backward marginals give the offsets, and their sums over a document,
calibrated on the document labels, its score.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import held_out, labelled_sample, map_texts, texts

FOLDS, HELD_FOLD = 3, 1
THRESHOLD = 0.7
SAMPLE_ROWS = 20_000
LEXICON_ROWS = 500
LEAST_DOCS, LEAST_G2, LEAST_LIFT = 4, 25.0, 3.0
TRAIN_LINES, LINE_WORDS = 4_000, 64
MARGINAL = 0.5
BEGINNINGS = range(5, 10)
MEMO_WORDS = 200_000
WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def units_of(word: str) -> list[str]:
    """What may indicate: the word itself, and its beginnings marked by ``*``."""
    return [word, *(f"{word[:n]}*" for n in BEGINNINGS if n <= len(word))]


class Numbers(dict):
    """Indicator number of a word, 0 for any other; remembers a bounded number of words."""

    def __init__(self, index: dict[str, int]):
        super().__init__()
        self.index = index

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        self[word] = found = next((self.index[u] for u in units_of(word) if u in self.index), 0)
        return found

    def __reduce__(self):
        return Numbers, (self.index,)


@dataclass(frozen=True)
class Field:
    """Two states, 0 and toxic 1. Emissions are log-odds of state 1 by word, previous and next word."""

    index: Numbers  # of a word: 1.. by its indicator, any other word 0
    word: np.ndarray
    before: np.ndarray
    after: np.ndarray
    step: np.ndarray  # 2 x 2 transition scores
    start: np.ndarray
    calibration: np.ndarray  # weights of the document features

    def emissions(self, ids: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Scores of state 1, rows padded with -1 to one width."""
        hit = (ids > 0).astype(np.int64)
        before = np.pad(hit, ((0, 0), (1, 0)))[:, :-1]
        after = np.pad(hit, ((0, 0), (0, 1)))[:, 1:]
        return self.word[np.maximum(ids, 0)] + self.before[before] + self.after[after]


def forward_backward(score: np.ndarray, lengths: np.ndarray, step: np.ndarray, start: np.ndarray):
    """Marginals of state 1, summed pair marginals and log-partition of padded sequences."""
    n, width = score.shape
    e = np.zeros((width, n, 2))
    e[:, :, 1] = score.T
    forward, backward = np.empty((width, n, 2)), np.zeros((width, n, 2))
    forward[0] = e[0] + start
    for t in range(1, width):
        forward[t] = np.logaddexp(forward[t - 1][:, :1] + step[0], forward[t - 1][:, 1:] + step[1]) + e[t]
    for t in range(width - 2, -1, -1):
        ahead = backward[t + 1] + e[t + 1]
        value = np.logaddexp(ahead[:, :1] + step[:, 0], ahead[:, 1:] + step[:, 1])
        backward[t] = np.where((t + 1 < lengths)[:, None], value, 0.0)
    last = forward[lengths - 1, np.arange(n)]
    log_z = np.logaddexp(last[:, 0], last[:, 1])
    inside = np.arange(width)[:, None] < lengths
    marginal = np.where(inside, np.exp(np.minimum(forward[:, :, 1] + backward[:, :, 1] - log_z, 0)), 0.0)
    pairs = np.zeros((2, 2))
    ahead = (e + backward)[1:]
    for a in range(2):
        for b in range(2):
            p = np.exp(forward[:-1, :, a] + step[a, b] + ahead[:, :, b] - log_z)
            pairs[a, b] = p[inside[1:]].sum()
    return marginal.T, pairs, log_z


def padded(sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(s) for s in sequences])
    ids = np.full((len(sequences), lengths.max()), -1, np.int64)
    ids[np.arange(ids.shape[1]) < lengths[:, None]] = np.concatenate(sequences)
    return ids, lengths


def train_field(index: Numbers, lines: list[tuple[np.ndarray, bool]], rounds: int = 80, l2: float = 0.05) -> Field:
    """Maximum likelihood by Adam; a line's tokens are labelled toxic at indicators if its document is."""
    k = len(index.index) + 1
    w = {"word": np.zeros(k), "before": np.zeros(2), "after": np.zeros(2), "step": np.zeros((2, 2)), "start": np.zeros(2)}
    w["word"][0] = -3.0
    field = lambda: Field(index, **w, calibration=np.zeros(4))
    if not lines:
        return field()
    ids, lengths = padded([s for s, _ in lines])
    inside = ids >= 0
    gold = (ids > 0) & np.array([toxic for _, toxic in lines])[:, None]
    hit = (ids > 0).astype(np.int64)
    near = {"before": np.pad(hit, ((0, 0), (1, 0)))[:, :-1], "after": np.pad(hit, ((0, 0), (0, 1)))[:, 1:]}
    pair_of = (2 * gold[:, :-1] + gold[:, 1:])[inside[:, 1:]]
    gold_pairs = np.bincount(pair_of, minlength=4).reshape(2, 2)
    moments = {n: (np.zeros_like(v), np.zeros_like(v)) for n, v in w.items()}
    for round_ in range(1, rounds + 1):
        marginal, pairs, _ = forward_backward(field().emissions(ids, lengths), lengths, w["step"], w["start"])
        rest = np.where(inside, gold - marginal, 0.0)
        slope = {
            "word": np.bincount(np.maximum(ids, 0).ravel(), rest.ravel(), k),
            **{n: np.bincount(at.ravel(), rest.ravel(), 2) for n, at in near.items()},
            "step": gold_pairs - pairs,
            "start": np.array([-rest[:, 0].sum(), rest[:, 0].sum()]),
        }
        for n, v in w.items():
            g = slope[n] - l2 * v
            first, second = moments[n]
            moments[n] = first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
            w[n] = v + 0.15 * (first / (1 - 0.9**round_)) / (np.sqrt(second / (1 - 0.99**round_)) + 1e-8)
    return field()


def tagged(field: Field, batch: list[str]) -> tuple[np.ndarray, list[list[tuple[int, int]]]]:
    """Features and toxic spans of each text.

    A line without an indicator has the same small marginals at every word and adds
    nothing to the features; only the others go through forward-backward.
    """
    owners, sequences, places = [], [], []
    tokens = np.zeros(len(batch))
    for i, text in enumerate(batch):
        words = words_of(text)
        tokens[i] = len(words)
        if not any(map(field.index.__getitem__, words)):
            continue
        at = 0
        for line in text.split("\n"):
            # Lower-casing can change lengths, so offsets come from the line as it is.
            found = [(m.group().lower(), at + m.start(), at + m.end()) for m in WORD.finditer(line)]
            at += len(line) + 1
            ids = np.array([field.index[w] for w, _, _ in found], np.int64)
            if ids.any():
                owners.append(i)
                sequences.append(ids)
                places.append([(a, b) for _, a, b in found])
    x = np.zeros((len(batch), 4))
    x[:, 0] = 1
    spans: list[list[tuple[int, int]]] = [[] for _ in batch]
    order = sorted(range(len(sequences)), key=lambda j: len(sequences[j]))
    while order:
        # Lines of like length together; the padded cells stay below a bound, but for a single line.
        part, cells = [], 0
        while order and (not part or cells + len(sequences[order[-1]]) <= 200_000):
            part.append(order.pop())
            cells += len(sequences[part[0]])
        ids, lengths = padded([sequences[j] for j in part])
        marginal, _, _ = forward_backward(field.emissions(ids, lengths), lengths, field.step, field.start)
        for j, row, length in zip(part, marginal, lengths, strict=True):
            i = owners[j]
            x[i, 1] = max(x[i, 1], row[:length].max())
            x[i, 2] += row[:length].sum()
            run: list[tuple[int, int]] = []
            for p, place in zip([*row[:length], 0.0], [*places[j], (0, 0)], strict=True):
                if p >= MARGINAL:
                    run.append(place)
                elif run:
                    spans[i].append((run[0][0], run[-1][1]))
                    run = []
    x[:, 3] = 100 * x[:, 2] / np.maximum(tokens, 1)
    x[:, 2:] = np.log1p(x[:, 2:])
    return x, [sorted(s) for s in spans]


def calibrated(x: np.ndarray, y: np.ndarray, l2: float = 0.1) -> np.ndarray:
    """Logistic regression by Newton's method."""
    w = np.zeros(x.shape[1])
    if not len(y):
        return w
    for _ in range(30):
        p = 1 / (1 + np.exp(-x @ w))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + l2 * np.eye(len(w))
        w = w + np.linalg.solve(hessian, x.T @ (y - p) - l2 * w)
    return w


def standing_out(seen: DataFrame, rate: float, limit: int) -> DataFrame:
    """Words of ``seen`` (label, word) far more often toxic than ``rate``, by G2; at most ``limit``."""
    counts = seen.groupBy("word").agg(F.sum("label").alias("a"), F.count("*").alias("n"))
    lift = F.col("a") / F.col("n") >= min(LEAST_LIFT * rate, (1 + rate) / 2)
    a, b = F.col("a"), F.col("n") - F.col("a")
    rest = F.when(b > 0, b * F.log(b / (F.col("n") * (1 - rate)))).otherwise(0.0)
    scored = counts.where((a >= LEAST_DOCS) & lift).withColumn("g2", 2 * (a * F.log(a / (F.col("n") * rate)) + rest))
    return scored.where(F.col("g2") >= LEAST_G2).orderBy(F.desc("g2"), "word").limit(limit)


def lexicon(rows: DataFrame, limit: int = LEXICON_ROWS) -> list[str]:
    """At most ``limit`` words or word beginnings whose documents are toxic far more often than others.

    ``rows`` has ``doc_id``, ``label`` and ``text``. Candidates are found by documents and
    confirmed by distinct contexts (the words around), so that one mislabelled text that
    occurs in many copies names no indicator. Counted on the executors.
    """
    totals = rows.agg(F.sum("label").alias("a"), F.count("*").alias("n")).first()
    if not totals.n or not totals.a or totals.a == totals.n:
        return []
    rate = totals.a / totals.n
    units = map_texts(
        rows,
        lambda batch: {"units": [sorted({u for w in set(words_of(t)) for u in units_of(w)}) for t in batch]},
        "units array<string>",
    )
    by_docs = standing_out(units.select("label", F.explode("units").alias("word")), rate, limit)
    chosen: list[str] = []
    for unit in sorted(by_docs.collect(), key=lambda r: (-r.g2, -len(r.word), r.word)):
        stem = unit.word.rstrip("*")
        if not any(stem.startswith(c.rstrip("*")) or c.startswith(stem) for c in chosen):
            chosen.append(unit.word)
    candidates = Numbers({u: i + 1 for i, u in enumerate(chosen)})

    def around(batch: list[str]) -> dict[str, list]:
        out = []
        for text in batch:
            words = ["", *words_of(text), ""]
            near = zip(words[1:-1], words, words[2:], strict=False)
            out.append([[chosen[k - 1], *t] for t in near if (k := candidates[t[0]])])
        return {"seen": out}

    seen = map_texts(rows, around, "seen array<array<string>>").select("label", F.explode("seen").alias("seen"))
    distinct = seen.groupBy("seen").agg(F.max("label").alias("label"))
    confirmed = standing_out(distinct.select("label", F.col("seen")[0].alias("word")), rate, limit)
    return [r.word for r in confirmed.collect()]


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Field:
    """Learn from at most ``sample_rows`` labelled documents outside the held-out fold.

    The driver gets at most ``LEXICON_ROWS`` words, ``TRAIN_LINES`` lines of word numbers, cut to
    ``LINE_WORDS`` words for training only, and four numbers for each sampled document.
    """
    sample = F.broadcast(labelled_sample(labels, "toxic", FOLDS, HELD_FOLD, sample_rows))
    rows = texts(docs).join(sample, "doc_id").select("doc_id", "label", "text")
    index = Numbers({u: i + 1 for i, u in enumerate(lexicon(rows))})

    def numbered(batch: list[str]) -> dict[str, list]:
        out = []
        for text in batch:
            lines = []
            for line in text.split("\n"):
                ids = [index[w] for w in words_of(line)]
                at = next((i for i, v in enumerate(ids) if v), None)
                if at is not None:
                    first = max(0, at - LINE_WORDS // 2)
                    lines.append(ids[first : first + LINE_WORDS])
            out.append(lines)
        return {"lines": out}

    lines = (
        map_texts(rows, numbered, "lines array<array<int>>")
        .select("doc_id", "label", F.posexplode("lines").alias("line_no", "ids"))
        .orderBy(F.xxhash64("doc_id", "line_no"), "doc_id", "line_no", "label")
        .limit(TRAIN_LINES)
        .toPandas()
    )
    field = train_field(index, [(np.array(r.ids, np.int64), r.label == 1) for r in lines.itertuples()])
    x = map_texts(rows, lambda batch: {"x": list(tagged(field, batch)[0])}, "x array<double>")
    once = x.groupBy("doc_id").agg(F.min(F.struct("label", "x")).alias("r")).select("doc_id", "r.*").toPandas()
    once = once.sort_values("doc_id")
    features = np.array(once["x"].tolist(), np.float64).reshape(len(once), 4)
    weights = calibrated(features, once["label"].to_numpy(np.float64))
    return Field(field.index, field.word, field.before, field.after, field.step, field.start, weights)


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: score, decision and the toxic spans in code points, end exclusive.

    Whole texts and nothing but the text. Null and empty texts have no span and get the
    score of a document without indicators; repeated rows score alike; without
    labels, or with those of one kind, every score is one half.
    """
    field = fit(docs, labels)

    def per_batch(batch: list[str]) -> dict[str, list | np.ndarray | pa.Array]:
        x, spans = tagged(field, batch)
        return {
            "score": 1 / (1 + np.exp(-x @ field.calibration)),
            "spans": [",".join(f"{a}:{b}" for a, b in s) for s in spans],
        }

    rows = map_texts(texts(docs), per_batch, "score double, spans string")
    return rows.select(
        "doc_id",
        held_out(FOLDS, HELD_FOLD),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "spans",
    )
