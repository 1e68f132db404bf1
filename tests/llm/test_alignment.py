"""Cross-tokenizer alignment against a version that walks both token lists."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm import alignment
from tests.llm.rows import none, odd, table

ODD_TEXTS = [
    "  two  spaces \n\n and\tmore ", "<|endoftext|> <s> </s> <unk> <0x41> [INST]", "mark ▁ here", "don't we'll I'VE 's", "日本語のテキスト と words",
    "a\u00a0b\u2003c", "x" * 3000, "ab " * 2000, "\x00\x01 é\u0301 🎉🎉", " ", "\n", "word", "1234567 3.14", "ﬁ①² K",
]


class Plain:
    """Both libraries on whole texts, cuts by set intersection."""

    def __init__(self):
        self.a = Tokenizer.from_file(alignment.BYTE_VOCABULARY)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_MODEL)
        self.names = {i: t for t, i in self.a.get_vocab().items()}
        self.letters = alignment.byte_letters()

    def of_a(self, i):
        return self.names[i].encode() if i == 50256 else bytes(self.letters[c] for c in self.names[i])

    def of_b(self, i):
        piece = self.b.id_to_piece(i)
        byte = re.fullmatch("<0x(..)>", piece)
        return bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()

    def align(self, text):
        a = self.a.encode(f" {text}", add_special_tokens=False).ids if text else []
        b = self.b.encode(text) if text else []
        raw = f" {text}".encode()
        if b"".join(map(self.of_a, a)) != raw or b"".join(map(self.of_b, b)) != raw:
            return [], []
        ends = []
        for ids, spelt in ((a, self.of_a), (b, self.of_b)):
            at, places = 0, {}
            for n, i in enumerate(ids):
                at += len(spelt(i))
                places[at] = n + 1
            ends.append(places)
        groups, x, y = [], 0, 0
        for cut in sorted(set(ends[0]) & set(ends[1])):
            groups.append((a[x : ends[0][cut]], b[y : ends[1][cut]]))
            x, y = ends[0][cut], ends[1][cut]
        return groups, [(g[0][-1], g[1][-1]) for g in groups]

    def report(self, texts):
        aligned = [self.align(t or "") for t in texts]
        counts = Counter(link for _, links in aligned for link in links)
        best = defaultdict(int)
        for (_, b), n in counts.items():
            best[b] = max(best[b], n)
        out = []
        for groups, links in aligned:
            told = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
            out.append((
                sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
                sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links),
                hashlib.sha256(told.encode()).hexdigest() if groups else "",
            ))
        return out


@pytest.fixture(scope="module")
def plain():
    return Plain()


def rows(frame):
    return sorted(tuple(r) for r in frame.collect())


def expected(plain, given):
    return sorted((doc, *told) for (doc, _), told in zip(given, plain.report([t for _, t in given]), strict=True))


def test_odd_texts_with_repeats(spark, plain):
    given = [(i // 2, t) for i, t in enumerate([*ODD_TEXTS, *ODD_TEXTS, "", None])]
    docs = spark.createDataFrame(given, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("row", "pairs", "times", "pair", "count", "best")})
    whole = rows(alignment.report(docs))
    assert whole == expected(plain, given)
    for hot in (0, 7):
        assert rows(alignment.report(docs, hot_pairs=hot)) == whole


def test_given_documents(spark, plain):
    docs = table(spark, "documents")
    given = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert rows(alignment.report(docs)) == expected(plain, given)


def test_odd_rows_and_empty_tables(spark):
    docs = odd(spark)
    out = alignment.report(docs).collect()
    assert len(out) == docs.count()
    assert all((r.n_a, r.groups_sha256) == (0, "") for r in out if r.doc_id in (3, 4))
    assert alignment.report(none(spark)).collect() == [] and alignment.alignments(none(spark)).collect() == []


def test_groups_of_the_operator(spark, plain):
    docs = spark.createDataFrame(list(enumerate(ODD_TEXTS)), "doc_id long, text string")
    for r in alignment.alignments(docs).collect():
        groups, x, y = [], 0, 0
        for i, j in zip(r.a_ends, r.b_ends, strict=True):
            groups.append((r.a_ids[x:i], r.b_ids[y:j]))
            x, y = i, j
        assert groups == plain.align(ODD_TEXTS[r.doc_id])[0]


@pytest.mark.parametrize("seed", range(60))
def test_cuts_are_the_common_ends(seed):
    rng = random.Random(seed)
    n = rng.choice([2, 5, 40, 3000])
    dense_a, dense_b = rng.random(), rng.random()
    a = np.array([*[x for x in range(1, n) if rng.random() < dense_a], n])
    b = np.array([*[x for x in range(1, n) if rng.random() < dense_b], n])
    found = alignment.shared_cuts(a, b, np.array([0]), np.array([len(a) - 1]))
    assert sorted(a[found].tolist()) == sorted(set(a.tolist()) & set(b.tolist()) - {n})
