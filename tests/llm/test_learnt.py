"""Quality, toxicity and language model: held-out results, fixed cases, odd rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest

from ledgerline.llm import ngrams, quality, toxicity
from ledgerline.llm.common import table
from tests.llm.rows import ODD, none, odd

SF = "/root/testdata/sf0.01"


def fold(doc_id, folds):
    return None if doc_id is None else zlib.crc32(str(doc_id).encode()) % folds


def auc(score, label):
    rank = pd.Series(score).rank()
    pos = np.asarray(label) == 1
    return (rank[pos].sum() - pos.sum() * (pos.sum() + 1) / 2) / (pos.sum() * (~pos).sum())


@pytest.mark.parametrize("operator, target, folds, out", [(quality.quality_scores, "quality", 4, 2), (toxicity.toxicity_scores, "toxic", 3, 1)])
def test_held_out_documents_are_told_apart(spark, operator, target, folds, out):
    labels = table(spark, SF, "labels")
    scores = operator(table(spark, SF, "documents"), labels).toPandas()
    assert len(scores) == 1000 and scores.score.between(0, 1).all()
    assert (scores.predicted == (scores.score >= 0.7)).all()
    assert scores.held_out.tolist() == [fold(i, folds) == out for i in scores.doc_id]
    both = scores.merge(labels.toPandas(), on="doc_id")
    test = both[both.held_out]
    assert auc(test.score, test[target]) > 0.85
    assert (test.predicted == test[target]).mean() > 0.9


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs = table(spark, SF, "documents").limit(300)
    labels = table(spark, SF, "labels").toPandas()
    turned = labels.assign(quality=[1 - q if fold(i, 4) == 2 else q for i, q in zip(labels.doc_id, labels.quality, strict=True)])
    a, b = (quality.quality_scores(docs, spark.createDataFrame(x)).orderBy("doc_id").toPandas() for x in (labels, turned))
    assert a.equals(b)


@pytest.mark.parametrize("operator", [quality.quality_scores, toxicity.toxicity_scores])
def test_odd_rows_are_scored(spark, operator):
    labels = table(spark, SF, "labels")
    rows = operator(odd(spark), labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out is False for r in rows if r.doc_id is None)
    empty = {r.score for r in rows if r.doc_id in (3, 4)}
    assert len(empty) == 1
    assert operator(none(spark), labels).count() == 0
    alone = operator(odd(spark), none(spark, "doc_id long, quality int, toxic int")).collect()
    assert len(alone) == len(ODD) and len({r.score for r in alone}) == 1


def test_flattened_trees_equal_walked_ones():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 4))
    y = (x[:, 0] + x[:, 1] ** 2 > 1).astype(float)
    trees = quality.fit_trees(x, y, rounds=10)
    for row, got in zip(x[:50], trees.score(x[:50]), strict=True):
        total = trees.bias
        for f, t, leaf in zip(trees.feature, trees.threshold, trees.leaf, strict=True):
            node = 0
            while node < len(f):
                node = 2 * node + (2 if row[f[node]] > t[node] else 1)
            total += leaf[node - len(f)]
        assert got == pytest.approx(1 / (1 + math.exp(-total)))
    assert ((trees.score(x) > 0.5) == y).mean() > 0.9


def test_forward_backward_equals_all_paths():
    rng = np.random.default_rng(2)
    step, start = rng.normal(size=(2, 2)), rng.normal(size=2)
    score, lengths = rng.normal(size=(3, 5)), np.array([5, 3, 1])
    marginal, pairs, log_z = toxicity.forward_backward(score, lengths, step, start)
    pair_sum = np.zeros((2, 2))
    for row, n in enumerate(lengths):
        weight = {}
        for code in range(2**n):
            path = [code >> t & 1 for t in range(n)]
            s = start[path[0]] + sum(score[row, t] for t in range(n) if path[t])
            weight[tuple(path)] = math.exp(s + sum(step[a, b] for a, b in zip(path, path[1:], strict=False)))
        z = sum(weight.values())
        assert log_z[row] == pytest.approx(math.log(z))
        for t in range(5):
            want = sum(w for p, w in weight.items() if t < n and p[t]) / z
            assert marginal[row, t] == pytest.approx(want)
        for p, w in weight.items():
            for a, b in zip(p, p[1:], strict=False):
                pair_sum[a, b] += w / z
    assert pairs == pytest.approx(pair_sum)


def test_toxic_offsets_name_the_words(spark):
    labels = table(spark, SF, "labels")
    docs = table(spark, SF, "documents")
    text = {r.doc_id: r.text for r in docs.collect()}
    found = [(r.doc_id, *map(int, s.split(":"))) for r in toxicity.toxicity_scores(docs, labels).collect() for s in r.spans.split(",") if s]
    assert found
    words = Counter(text[i][a:z].lower() for i, a, z in found)
    assert any(w in words for w in ("idiot", "moron", "stupid", "clown", "loser"))
    assert all(w == w.strip() and w for w in words)


def model_of(rows):
    """Counts by hand: words, pairs under their context, of the counted part and of all training rows."""
    out = {}
    for name, wanted in (("fit", (0, 3, 4)), ("all", (0, 2, 3, 4))):
        words, contexts, pairs = Counter(), Counter(), Counter()
        for i, t in rows:
            if fold(i, 5) in wanted:
                tokens = [*(t or "").encode().lower().split(), None]
                words.update(tokens)
                before = ["start", *tokens[:-1]]
                contexts.update(before)
                pairs.update(zip(before, tokens, strict=True))
        out[name] = words, contexts, pairs
    return out


def test_scores_equal_brute_force(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    counts = model_of(rows)
    words, contexts, pairs = counts["all"]
    n, v = sum(words.values()), len(words)
    # Weights by plain expectation-maximisation over the tokens held out for them.
    fit_words, fit_contexts, fit_pairs = counts["fit"]
    fit_n = sum(fit_words.values())
    seen = {}
    for i, t in rows:
        if fold(i, 5) == 2:
            tokens = [*t.encode().lower().split(), None]
            for a, b in zip(["start", *tokens[:-1]], tokens, strict=True):
                if fit_contexts[a]:
                    ratio = fit_pairs[a, b] / fit_contexts[a] / ((fit_words[b] + 0.5) / (fit_n + 0.5 * (v + 1)))
                    seen.setdefault(fit_contexts[a].bit_length(), []).append(ratio)
    weight = {}
    for bucket in range(1, 64):
        w, r = 0.5, np.array(seen.get(bucket, []))
        for _ in range(60 if len(r) else 0):
            w = min(max((w * r / (w * r + 1 - w)).mean(), 1e-6), 1 - 1e-6)
        weight[bucket] = w if len(r) or bucket == 1 else weight[bucket - 1]
    got = {r.doc_id: r for r in ngrams.language_scores(docs).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        tokens = [*t.encode().lower().split(), None]
        by_word = [(words[b] + 0.5) / (n + 0.5 * (v + 1)) for b in tokens]
        assert (got[i].n_tokens, got[i].train_tokens) == (len(tokens), n)
        assert got[i].n_known == sum(words[b] > 0 for b in tokens)
        assert got[i].held_out == (fold(i, 5) == 1)
        assert got[i].base_score == pytest.approx(sum(map(math.log10, by_word)), rel=1e-9)
        score = 0.0
        for a, b, p in zip(["start", *tokens[:-1]], tokens, by_word, strict=True):
            w = weight[contexts[a].bit_length()] if contexts[a] else 0.0
            score += math.log10((w * pairs[a, b] / contexts[a] if contexts[a] else 0.0) + (1 - w) * p)
        assert got[i].score == pytest.approx(score, rel=2e-3)


def test_held_out_texts_are_likelier_than_by_words_alone(spark):
    rows = ngrams.language_scores(table(spark, SF, "documents")).where("held_out").agg({"score": "sum", "base_score": "sum"}).first()
    assert rows["sum(score)"] > rows["sum(base_score)"]


def test_odd_rows_are_scored_by_the_language_model(spark):
    rows = ngrams.language_scores(odd(spark)).collect()
    assert len(rows) == len(ODD)
    assert {r.n_tokens for r in rows if r.doc_id in (3, 4, 8)} == {1}
    assert all(r.held_out is False for r in rows if r.doc_id is None)
    assert all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in rows)
    assert ngrams.language_scores(none(spark)).count() == 0


def worded(spark, n=400):
    """Texts of common and rare words; null and repeated ids, null and empty texts among them."""
    rng = np.random.default_rng(6)
    rows = [(i, " ".join(f"w{k}" for k in rng.zipf(1.3, 200) % 5000)) for i in range(n)]
    rows += [(None, rows[0][1]), rows[1], (rows[2][0], rows[3][1]), (n, None), (n + 1, "")]
    return spark.createDataFrame(rows, "doc_id long, text string").coalesce(2), rows


def small_chunks(monkeypatch):
    monkeypatch.setattr(ngrams, "CHUNK_CHARS", 5_000)
    monkeypatch.setattr(ngrams, "BUCKET_CHARS", 20_000)


def test_stored_chunks_are_short_and_few_to_a_row_group(spark, monkeypatch):
    """A reader holds a row group and an Arrow batch of them, so neither may be the texts of a whole partition."""
    docs, rows = worded(spark)
    small_chunks(monkeypatch)
    chunks = ngrams.chunked(docs)
    groups = [m.row_group(i).num_rows for m in map(pq.read_metadata, chunks.inputFiles()) for i in range(m.num_row_groups)]
    assert sum(groups) > 30 and max(groups) <= 4
    stored = sum(len(v) if isinstance(v, bytes | bytearray) else sum(len(str(x)) for x in v) for r in chunks.collect() for v in r if not isinstance(v, int))
    assert stored < 0.6 * sum(len(t or "") for _, t in rows)


def test_chunks_hold_every_document(spark, monkeypatch):
    docs, rows = worded(spark)
    small_chunks(monkeypatch)
    held = Counter()
    for r in ngrams.chunked(docs).collect():
        ids, texts = ngrams.unpacked(bytes(r.packed))
        assert r.chars == sum(map(len, texts))
        held.update(zip(ids, texts, strict=True))
    assert held == Counter((i, t or "") for i, t in rows)


def test_small_chunks_and_buckets_give_the_same_scores(spark, monkeypatch):
    docs, rows = worded(spark)
    columns = ["doc_id", "n_tokens", "base_score", "score", "n_known", "train_tokens", "held_out"]
    whole = ngrams.language_scores(docs).select(columns).orderBy(columns).toPandas()
    small_chunks(monkeypatch)
    parts = ngrams.language_scores(docs).select(columns).orderBy(columns).toPandas()
    assert len(whole) == len(rows)
    pd.testing.assert_frame_equal(whole, parts, rtol=1e-9)
