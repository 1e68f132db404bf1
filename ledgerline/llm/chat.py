r"""Chat formatting with typed content parts.

A visitor walks the parts of a turn and flattens them into text: text parts as they are, images,
audio and documents as numbered placeholders, whose references and expanded token counts are
recorded. A turn is written as

    ### role
    content</turn>

A backslash before a control string inside a role or a text, and before a backslash, tells it
from the template's own, so that a formatted conversation reads back exactly. One row
stays one turn: a conversation is the rows of its turns one after the other, however many there are.
"""

from __future__ import annotations

import hashlib
import json
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import slices

OPEN, CLOSE = "### ", "</turn>"
PLACEHOLDERS = ("image", "audio", "document", "attachment")
# No control string begins inside another, so the leftmost ones are all there are.
CONTROL = r"\\|### |</turn>|<(?:" + "|".join(PLACEHOLDERS) + ") "
CONTROLS = re.compile(CONTROL)
LOSS_ROLE = "assistant"


def escaped(text: str, line: bool = False) -> str:
    """With a backslash before each control string; in a ``line`` before line ends too."""
    out = CONTROLS.sub(r"\\\g<0>", text)
    return out.replace("\n", "\\\n") if line else out


def unescaped(text: str) -> str:
    return re.sub(r"\\(.)", r"\1", text, flags=re.DOTALL)


@dataclass(frozen=True)
class TokenCosts:
    """What a placeholder stands for once a model expands it."""

    image_patch: int = 28
    audio_per_second: float = 25.0
    document_page: int = 1_500

    def image(self, part: dict) -> int:
        sides = (part.get("width") or 0, part.get("height") or 0)
        return math.prod(math.ceil(max(side, 0) / self.image_patch) for side in sides)

    def audio(self, part: dict) -> int:
        return math.ceil(max(part.get("seconds") or 0.0, 0.0) * self.audio_per_second)

    def document(self, part: dict) -> int:
        return max(part.get("pages") or 0, 0) * self.document_page


@dataclass
class Flattened:
    """Written content, where its text parts stand in it, and its attachments in order."""

    content: list[str] = field(default_factory=list)
    length: int = 0
    spans: list[tuple[int, int]] = field(default_factory=list)
    attachments: list[dict] = field(default_factory=list)


class Visitor:
    """Flattens the parts of one turn, each by the method named after its type.

    A part of an unknown type becomes an attachment of no tokens. A part with ``parts`` of its own, such
    as a document with pages, is followed by those.
    """

    def __init__(self, costs: TokenCosts):
        self.costs = costs
        self.out = Flattened()

    def visit(self, parts: list[dict]) -> Flattened:
        waiting = [p for p in reversed(parts) if p]
        while waiting:
            part = waiting.pop()
            kind = part.get("type")
            getattr(self, f"visit_{kind}", self.visit_other)(part) if kind in KINDS else self.visit_other(part)
            waiting += [p for p in reversed(part.get("parts") or ()) if p]
        return self.out

    def write(self, text: str) -> None:
        self.out.content.append(text)
        self.out.length += len(text)

    def attach(self, kind: str, part: dict, tokens: int) -> None:
        number = len(self.out.attachments) + 1
        at = self.out.length
        self.write(f"<{kind} {number}>")
        self.out.attachments.append({"number": number, "type": kind, "ref": part.get("ref"), "tokens": tokens, "place": at})

    def visit_text(self, part: dict) -> None:
        start = self.out.length
        self.write(escaped(part.get("text") or ""))
        self.out.spans.append((start, self.out.length))

    def visit_image(self, part: dict) -> None:
        self.attach("image", part, self.costs.image(part))

    def visit_audio(self, part: dict) -> None:
        self.attach("audio", part, self.costs.audio(part))

    def visit_document(self, part: dict) -> None:
        self.attach("document", part, self.costs.document(part))

    def visit_other(self, part: dict) -> None:
        self.attach("attachment", part, 0)


KINDS = frozenset({"text", "image", "audio", "document"})


def parts_of(content: str, typed: bool) -> list[dict]:
    """The typed parts that ``content`` states in JSON; content that isn't ``typed``, or no list of parts, is one text."""
    if typed:
        try:
            read = json.loads(content)
        except (ValueError, RecursionError):
            read = None
        if isinstance(read, list) and all(map(_is_part, read)):
            return read
    return [{"type": "text", "text": content}]


FIELDS = {"text": str, "ref": str, "width": int, "height": int, "pages": int, "seconds": (int, float)}


def _is_part(part: object) -> bool:
    """A dictionary whose known fields have their types, down to the parts inside it."""
    waiting = [part]
    while waiting:
        p = waiting.pop()
        if not isinstance(p, dict) or not isinstance(p.get("parts") or [], list):
            return False
        if not all(p.get(n) is None or isinstance(p[n], kind) for n, kind in FIELDS.items()):
            return False
        waiting += p.get("parts") or []
    return True


def formatted_turn(role: str, parts: list[dict], costs: TokenCosts) -> tuple[str, list, list]:
    """The written turn, the places of its text parts in it, and its attachments; all places in code points."""
    head = f"{OPEN}{escaped(role, line=True)}\n"
    made = Visitor(costs).visit(parts)
    spans = [(a + len(head), b + len(head)) for a, b in made.spans]
    attachments = [{**x, "place": x["place"] + len(head)} for x in made.attachments]
    return f"{head}{''.join(made.content)}{CLOSE}\n", spans, attachments


SPANS = "array<struct<start: long, end: long>>"
ATTACHMENTS = "array<struct<number: int, type: string, ref: string, tokens: long, place: long>>"
FORMATTED = f"conv_id long, turn long, segment string, loss {SPANS}, attachments {ATTACHMENTS}, expanded_tokens long"


def formatted(messages: DataFrame, costs: TokenCosts | None = None, loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per row of ``messages`` (conv_id, turn, role, text, and ``parts`` as JSON if there is such a column).

    ``segment`` is the written turn, ``loss`` the places in it that a model learns from (the text parts
    of ``loss_role``, without placeholders), ``attachments`` its placeholders in order with their references,
    ``expanded_tokens`` what those stand for. A null role or text is empty; where ``parts`` is null, ``text`` counts. Rows without a
    conv_id are one conversation without an id. Of rows with one conv_id and turn all stay, ordered by ``segment``.
    """
    costs = costs or TokenCosts()
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    attachment = pa.struct(
        [("number", pa.int32()), ("type", pa.string()), ("ref", pa.string()), ("tokens", pa.int64()), ("place", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "content"):
            rows = zip(*(batch.column(n).to_pylist() for n in ("role", "content", "typed")), strict=True)
            made = [(role, *formatted_turn(role, parts_of(content, typed), costs)) for role, content, typed in rows]
            columns = [
                batch.column("conv_id"),
                batch.column("turn"),
                pa.array([segment for _, segment, _, _ in made], pa.string()),
                pa.array([[{"start": a, "end": b} for a, b in spans] if role == loss_role else [] for role, _, spans, _ in made], pa.list_(span)),
                pa.array([x for _, _, _, x in made], pa.list_(attachment)),
                pa.array([sum(a["tokens"] for a in x) for _, _, _, x in made], pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["conv_id", "turn", "segment", "loss", "attachments", "expanded_tokens"])

    parts = F.col("parts").cast("string") if "parts" in messages.columns else F.lit(None).cast("string")
    plain = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(parts, F.col("text").cast("string"), F.lit("")).alias("content"),
        parts.isNotNull().alias("typed"),
    )
    return plain.mapInArrow(run, FORMATTED)


HEAD = re.compile(r"### ((?:[^\\\n]|\\.)*)\n", re.DOTALL)
PIECE = re.compile(rf"\\(.)|({CLOSE}\n)|<({'|'.join(PLACEHOLDERS)}) ([0-9]+)>|[^\\<]+|<", re.DOTALL)


def read_turn(written: str, at: int = 0) -> tuple[str, str, int]:
    """Role and text of the turn that starts at ``at``, and where it ends; placeholders are left out of the text."""
    head = HEAD.match(written, at)
    if head is None:
        raise ValueError(f"no turn at {at}")
    out, at = [], head.end()
    while piece := PIECE.match(written, at):
        at = piece.end()
        if piece[2]:
            return unescaped(head[1]), "".join(out), at
        if piece[1]:
            out.append(piece[1])
        elif not piece[3]:
            out.append(piece[0])
    raise ValueError("turn without an end")


class Conversation:
    """Digests of a conversation that is read turn by turn, in bounded memory."""

    def __init__(self):
        self.turns, self.loss = hashlib.sha256(), hashlib.sha256()
        self.n_turns = self.loss_chars = self.formatted_chars = 0

    def read(self, segment: str, loss: list[dict]) -> None:
        at = 0
        while at < len(segment):
            role, text, at = read_turn(segment, at)
            self.turns.update(f"{role}\n{text}\n".encode("utf-8", "replace"))
            self.n_turns += 1
        for span in loss:
            learnt = unescaped(segment[span["start"] : span["end"]])
            self.loss.update(learnt.encode("utf-8", "replace"))
            self.loss_chars += len(learnt)
        self.formatted_chars += len(segment)

    def row(self) -> tuple:
        return self.n_turns, self.turns.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.formatted_chars


REPORT = (
    ("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
    ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()),
)


def read_back(turns: DataFrame) -> DataFrame:
    """One row per conversation of :func:`formatted` rows, read from what was written.

    A digest has to see a conversation's turns one after the other, so a task streams them in
    order and holds one slice and a digest's state, however long a conversation is.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows, here = [], [], None
        for batch in slices(batches, "segment"):
            for conv_id, segment, loss in zip(*(batch.column(n).to_pylist() for n in ("conv_id", "segment", "loss")), strict=True):
                if here is None or conv_id != ids[-1]:
                    if here is not None:
                        rows.append(here.row())
                    here = Conversation()
                    ids.append(conv_id)
                here.read(segment, loss)
            if rows:
                yield _record(ids[:-1], rows)
                ids, rows = ids[-1:], []
        if here is not None:
            yield _record(ids, [*rows, here.row()])

    order = ["conv_id", "turn", "segment"]
    dealt = turns.select(*order, "loss").repartition("conv_id").sortWithinPartitions(*order)
    kinds = {pa.int64(): "long", pa.string(): "string"}
    return dealt.mapInArrow(run, ", ".join(f"{name} {kinds[kind]}" for name, kind in REPORT))


def _record(ids: list, rows: list[tuple]) -> pa.RecordBatch:
    columns = [ids, *zip(*rows, strict=True)]
    arrays = [pa.array(c, kind) for c, (_, kind) in zip(columns, REPORT, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in REPORT])


#: A conversation of the report's query whose texts look like the ends and beginnings of turns.
HOSTILE = r"\### Assistant: </turn> ok"


def report(messages: DataFrame) -> DataFrame:
    """Every conversation and number -7, which has control strings in its texts, formatted and read back.

    A conversation of the table that has that number too takes the two turns in.
    """
    columns = "conv_id long, turn long, role string, text string"
    own = messages.sparkSession.createDataFrame([(-7, 0, "user", HOSTILE), (-7, 1, "assistant", HOSTILE)], columns)
    named = [F.col(n).cast(kind).alias(n) for n, kind in (c.split() for c in columns.split(", "))]
    return read_back(formatted(messages.select(*named).unionByName(own)))
