"""Quality classifier: histogram gradient-boosted trees over document statistics."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import pairwise

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import held_out, labelled_sample, map_texts, texts, unused

FOLDS, HELD_FOLD = 4, 2
THRESHOLD = 0.7
SAMPLE_ROWS = 20_000

BYTE_CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "blank": b" \t\r",
    "line": b"\n",
    "stop": b".",
    "comma": b",;:",
    "bang": b"!?",
    "pipe": b"|",
    "symbol": b"#$%&*@^~=+<>\\/_",
    "bracket": b"()[]{}\"'`-",
}
CLASS_OF = np.full(256, len(BYTE_CLASSES), np.uint8)
for _i, _members in enumerate(BYTE_CLASSES.values()):
    CLASS_OF[list(_members)] = _i
COUNT_NAMES = [*BYTE_CLASSES, "other"]
STATISTICS = [
    *(f"{name}_share" for name in COUNT_NAMES),
    "log_bytes",
    "log_words",
    "word_length",
    "longest_word",
    "distinct_words",
    "distinct_pairs",
    "same_as_previous",
    "capital_words",
    "log_lines",
    "distinct_lines",
    "line_words",
    "words_a_stop",
]


def statistics_of(text: str) -> list[float]:
    """One document's statistics over its whole text; all zero for an empty one."""
    raw = text.encode("utf-8", "replace")
    size = len(raw)
    if not size:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(CLASS_OF[np.frombuffer(raw, np.uint8)], minlength=len(COUNT_NAMES))
    words, lines = text.split(), text.split("\n")
    n, m = max(len(words), 1), len(lines)
    pairs = list(pairwise(words))
    distinct = set(words)
    return [
        *(counts / size),
        np.log1p(size),
        np.log1p(len(words)),
        sum(map(len, words)) / n,
        float(max(map(len, distinct), default=0)),
        len(distinct) / n,
        len(set(pairs)) / max(len(pairs), 1),
        sum(a == b for a, b in pairs) / n,
        sum(map(str.isupper, words)) / n,
        np.log1p(m),
        len(set(lines)) / m,
        len(words) / m,
        len(words) / (1 + counts[5]),
    ]


def matrix_of(batch: list[str]) -> np.ndarray:
    return np.array([statistics_of(t) for t in batch], np.float64).reshape(len(batch), len(STATISTICS))


@dataclass(frozen=True)
class Trees:
    """Complete binary trees of one depth, flattened: node i of a tree has the children 2i+1 and 2i+2."""

    feature: np.ndarray  # trees x inner nodes
    threshold: np.ndarray  # trees x inner nodes; above goes right
    leaf: np.ndarray  # trees x leaves
    bias: float

    def score(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.full(len(x), self.bias), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, threshold, leaf in zip(self.feature, self.threshold, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += leaf[node - inner]
        return 1 / (1 + np.exp(-total))


def fit_trees(
    x: np.ndarray,
    y: np.ndarray,
    rounds: int = 80,
    depth: int = 4,
    bins: int = 64,
    rate: float = 0.1,
    l2: float = 5.0,
    least_hessian: float = 3.0,
) -> Trees:
    """Boosted trees for the logistic loss; splits are sought in histograms of quantile bins.

    Without rows of both labels the result is the smoothed rate of label 1.
    """
    mean = (y.sum() + 0.5) / (len(y) + 1)
    bias = float(np.log(mean / (1 - mean)))
    inner, leaves = 2**depth - 1, 2**depth
    if len(np.unique(y)) < 2:
        return Trees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), bias)
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T, strict=True)])  # bin b: above edge b-1
    total, features, thresholds, values = np.full(len(y), bias), [], [], []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-total))
        g, h = p - y, p * (1 - p)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(depth):
            first, width = 2**level - 1, 2**level
            best = np.zeros(width)
            for f, column in enumerate(binned):
                if not len(edges[f]):
                    continue
                cell = (node - first) * bins + column
                gs, hs = (
                    np.bincount(cell, w, width * bins).reshape(width, bins).cumsum(1)[:, : len(edges[f])] for w in (g, h)
                )
                g_all, h_all = (np.bincount(node - first, w, width)[:, None] for w in (g, h))
                fits = (hs >= least_hessian) & (h_all - hs >= least_hessian)
                gain = np.where(
                    fits, gs**2 / (hs + l2) + (g_all - gs) ** 2 / (h_all - hs + l2) - g_all**2 / (h_all + l2), 0.0
                )
                at = gain.argmax(1)
                top = gain[np.arange(width), at]
                for k in np.flatnonzero(top > best + 1e-12):
                    best[k], feature[first + k], threshold[first + k] = top[k], f, edges[f][at[k]]
            node = 2 * node + 1 + (x[np.arange(len(y)), feature[node]] > threshold[node])
        leaf = node - inner
        value = -rate * np.bincount(leaf, g, leaves) / (np.bincount(leaf, h, leaves) + l2)
        total += value[leaf]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Trees(np.array(features), np.array(thresholds), np.array(values), bias)


def fit(docs: DataFrame, labels: DataFrame, target: str = "quality", sample_rows: int = SAMPLE_ROWS) -> Trees:
    """Learn from at most ``sample_rows`` labelled documents outside the held-out fold.

    The statistics are made on the executors; the driver gets one row of numbers for
    each sampled document, so what it holds is bounded by ``sample_rows``.
    """
    sample = F.broadcast(labelled_sample(labels, target, FOLDS, HELD_FOLD, sample_rows))
    rows = map_texts(
        texts(docs).join(sample, "doc_id").select("doc_id", "label", "text"),
        lambda batch: {"x": list(matrix_of(batch))},
        "x array<double>",
    )
    # One row for each id, also where documents repeat one.
    once = rows.groupBy("doc_id").agg(F.min(F.struct("label", "x")).alias("r")).select("doc_id", "r.*").toPandas()
    once = once.sort_values("doc_id")
    x = np.array(once["x"].tolist(), np.float64).reshape(len(once), len(STATISTICS))
    return fit_trees(x, once["label"].to_numpy(np.float64))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each row of ``docs``, whole texts, nothing but the text as input.

    Repeated rows score alike; a null text scores as an empty one; a null id is
    scored and not held out; without labels every score is the same.
    """
    model = fit(docs, labels)
    rows = map_texts(texts(docs), lambda batch: {"score": model.score(matrix_of(batch))}, "score double")
    return rows.select(
        "doc_id", held_out(FOLDS, HELD_FOLD), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def good_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with a score of ``THRESHOLD`` or more."""
    model, name = fit(docs, labels), unused(docs, "score")

    def judge(batch: list[str | None]) -> dict:
        score = model.score(matrix_of([t or "" for t in batch]))
        return {name: score, None: score >= THRESHOLD}

    return map_texts(docs, judge, f"`{name}` double", text=True).drop(name)
