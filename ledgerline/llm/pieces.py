"""SentencePiece encoding and decoding.

An Aho-Corasick automaton over all pieces reads a text once; at each position its
output links name every piece that ends there, and each relaxes the best score up to
that position (Viterbi). Pieces hold word marks, one or many, only at their start, so the
best path is the chain of the best paths of the words, each with all marks before it, and
a word's path can be remembered. Models are read, never trained.
"""

from __future__ import annotations

import re
import string
from dataclasses import dataclass
from functools import cached_property
from itertools import pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import map_texts, texts

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
MEMO_CHUNKS = 250_000
UNKNOWN_PENALTY = 10.0
NEVER = float("-inf")
BYTE = re.compile(r"<0x([0-9A-F]{2})>$")


@dataclass(frozen=True)
class Model:
    """Pieces by id with their scores; ids of bytes; whether a text starts with a mark."""

    pieces: tuple[str, ...]
    scores: tuple[float, ...]
    unknown: int
    controls: frozenset[int]
    dummy_prefix: bool = True

    @cached_property
    def byte_ids(self) -> dict[int, int]:
        return {int(m[1], 16): i for i, p in enumerate(self.pieces) if (m := BYTE.match(p))}

    @cached_property
    def splits(self) -> bool:
        """No piece has a mark after another character, so words with their runs of marks are independent."""
        return not any(MARK in p.lstrip(MARK) for i, p in enumerate(self.pieces) if i not in self.reserved)

    @cached_property
    def reserved(self) -> frozenset[int]:
        """Ids whose pieces are names, not text."""
        return frozenset({*self.controls, self.unknown, *self.byte_ids.values()})

    @cached_property
    def chunks(self) -> re.Pattern:
        """Runs that no piece crosses the end of, each with all marks before it, which one piece may span.

        A text may be cut between a letter or digit and a character that stands beside
        none in any piece; near other signs it is cut at marks only.
        """
        used = [p.lstrip(MARK) for i, p in enumerate(self.pieces) if i not in self.reserved]
        signs = {c for p in used for c in p if not c.isalnum()} | set(string.punctuation + string.whitespace)
        beside = {c for p in used for a, b in pairwise(p) for c, d in ((a, b), (b, a)) if d.isalnum()}
        apart, joined = (re.escape("".join(sorted(x - {MARK}))) for x in (signs - beside, signs & beside))
        near = f"(?![{joined}])" if joined else ""
        return re.compile(rf"{MARK}*+[^{MARK}{apart}{joined}]++{near}|{MARK}*+[{apart}]++{near}|{MARK}*+[^{MARK}]+|{MARK}++")

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        built = ahocorasick.Automaton()
        for i, piece in enumerate(self.pieces):
            if i not in self.reserved and piece:
                built.add_word(piece, (i, len(piece), self.scores[i]))
        built.make_automaton()
        return built

    @cached_property
    def lengths(self) -> list[int]:
        """In characters; an unknown piece stands for one."""
        return [1 if i == self.unknown else len(p) for i, p in enumerate(self.pieces)]

    @cached_property
    def alphabet(self) -> frozenset[str]:
        return frozenset(p for p in self.pieces if len(p) == 1)

    @cached_property
    def unknown_score(self) -> float:
        return min(self.scores, default=0.0) - UNKNOWN_PENALTY

    def __getstate__(self):
        """Travel without what is derived; each worker builds its automaton once."""
        return {k: getattr(self, k) for k in ("pieces", "scores", "unknown", "controls", "dummy_prefix")}

    def __setstate__(self, state):
        self.__dict__.update(state)

    def best_path(self, word: str) -> list[int]:
        """Piece ids of the path with the largest sum of scores; among equals the one with the longer last piece.

        A character in no piece costs more than any piece and becomes its UTF-8 bytes.
        """
        n = len(word)
        best, back = [0.0] + [NEVER] * n, [0] * (n + 1)
        lengths, gaps = self.lengths, not self.alphabet.issuperset(word)
        for end, (piece, length, score) in self.automaton.iter(word):
            end += 1
            if gaps and best[end - length] == NEVER:
                self.bridge(best, back, end - length)
            reached = best[end - length] + score
            if reached > best[end]:
                best[end] = reached
                back[end] = piece
        if gaps and best[n] == NEVER:
            self.bridge(best, back, n)
        path: list[int] = []
        while n:
            piece = back[n]
            if piece == self.unknown and self.byte_ids:
                path.extend(self.byte_ids[b] for b in reversed(word[n - 1].encode("utf-8", "replace")))
            else:
                path.append(piece)
            n -= lengths[piece]
        path.reverse()
        return path

    def bridge(self, best: list[float], back: list[int], to: int) -> None:
        """Reach ``to`` by unknown characters from the last position that a path reached."""
        at = to
        while best[at] == NEVER:
            at -= 1
        for i in range(at, to):
            best[i + 1], back[i + 1] = best[i] + self.unknown_score, self.unknown


class Paths(dict):
    """Best path of a chunk as 32-bit ids; remembers those of a bounded number of chunks."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, chunk: str) -> bytes:
        path = np.array(self.model.best_path(chunk), np.int32).tobytes()
        if len(chunk) < 64:
            if len(self) >= MEMO_CHUNKS:
                self.clear()
            self[chunk] = path
        return path


class Encoder:
    def __init__(self, model: Model):
        self.model = model
        self.paths = Paths(model)

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        marked = (MARK if self.model.dummy_prefix else "") + text.replace(" ", MARK)
        chunks = self.model.chunks.findall(marked) if self.model.splits else [marked]
        return b"".join(map(self.paths.__getitem__, chunks))

    def ids(self, text: str) -> list[int]:
        return np.frombuffer(self.encode(text), np.int32).tolist()


class Decoder:
    def __init__(self, model: Model):
        self.model = model
        self.byte_of = {i: b for b, i in model.byte_ids.items()}
        # A byte below 128 is a character by itself; the others wait for their neighbours.
        self.surface = [
            "" if i in model.controls else chr(self.byte_of[i]) if self.byte_of.get(i, 128) < 128 else p.replace(MARK, " ")
            for i, p in enumerate(model.pieces)
        ]
        self.high = frozenset(i for i, b in self.byte_of.items() if b >= 128)

    def decode(self, ids: list[int]) -> str:
        if self.high.isdisjoint(ids):
            text = "".join(map(self.surface.__getitem__, ids))
        else:
            raw = b"".join(
                bytes([self.byte_of[i]]) if i in self.high else self.surface[i].encode("utf-8", "replace") for i in ids
            )
            text = raw.decode("utf-8", "replace")
        return text[1:] if self.model.dummy_prefix and text[:1] == " " else text


def read_model(path: str = MODEL) -> Model:
    """Read a public model's pieces on the driver; executors get them with the task, so they need no file."""
    import sentencepiece

    reader = sentencepiece.SentencePieceProcessor(model_file=path)
    n = reader.get_piece_size()
    pieces = tuple(reader.id_to_piece(i) for i in range(n))
    controls = frozenset(i for i in range(n) if reader.is_control(i) or reader.is_unused(i))
    dummy = reader.encode_as_pieces("a")[0].startswith(MARK)
    return Model(pieces, tuple(map(reader.get_score, range(n))), reader.unk_id(), controls, dummy)


_ENCODERS: dict[int, tuple[Model, Encoder, Decoder]] = {}


def coders(model: Model) -> tuple[Encoder, Decoder]:
    """This worker's encoder and decoder for ``model``; they outlive a task, with their memory of words."""
    key = hash((model.pieces, model.scores))
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = (model, Encoder(model), Decoder(model))
    return _ENCODERS[key][1:]


def encoded(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id``, the piece ids of the whole text, their number, and whether decoding gives the text back.

    One row for each row. A null or empty text has no pieces. A text that holds the
    mark itself, or bytes cut out of a character, does not come back and says so.
    """
    model = model or read_model()

    def per_batch(batch: list[str]) -> dict[str, list | np.ndarray | pa.Array]:
        encoder, decoder = coders(model)
        packed = [encoder.encode(t) for t in batch]
        ends = np.cumsum([0, *(len(x) // 4 for x in packed)]).astype(np.int32)
        values = np.frombuffer(b"".join(packed), np.int32)
        spelt = (decoder.decode(values[a:b].tolist()) for a, b in pairwise(ends))
        return {
            "n_pieces": np.diff(ends).astype(np.int64),
            "round_trip": [a == b for a, b in zip(spelt, batch, strict=True)],
            "piece_ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(values)),
        }

    return map_texts(texts(docs), per_batch, "n_pieces long, round_trip boolean, piece_ids array<int>")


def decoded(rows: DataFrame, model: Model | None = None) -> DataFrame:
    """``doc_id`` and the ``text`` that ``piece_ids`` spell; null or empty ids give an empty text.

    An id outside the vocabulary fails the run, since there is no text for it.
    """
    model = model or read_model()
    ids = F.array_join(F.coalesce(F.col("piece_ids").cast("array<int>"), F.array().cast("array<int>")), " ")

    def per_batch(batch: list[str]) -> dict[str, list | np.ndarray | pa.Array]:
        decoder = coders(model)[1]
        return {"decoded": [decoder.decode([int(i) for i in t.split()]) for t in batch]}

    plain = rows.select(F.col("doc_id").cast("long").alias("doc_id"), ids.alias("text"))
    return map_texts(plain, per_batch, "decoded string").withColumnRenamed("decoded", "text")
