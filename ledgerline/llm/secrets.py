"""Secret scan with multipart credential linking.

Three base kinds are secrets by themselves. Weaker parts (an account name, a bare
random-looking string, an endpoint) are so common that one alone says nothing; they
are reported only where the parts that make a credential complete stand near.
Nearness is an interval join on positions. Parts are first summed up to the
smallest and largest position for each stretch of ``REACH`` code points, so a part
meets at most three summary rows and no pairs are made.
"""

from __future__ import annotations

import hashlib
import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import broadcast_if_small, map_texts, row_key, texts, unused
from ledgerline.sources.cuts import cut, kept_table

REACH = 400
LEAST_ASSIGNED, LEAST_ACCESS, LEAST_HEX = 6, 20, 24

#: ASCII case folding only: no long s, no Kelvin sign.
ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{%d,}" % LEAST_HEX)
KINDS = ("assign", "access", "hex", "account", "key", "endpoint")
ROLE = {"assign": "key", "access": "account", "hex": "key", "account": "account", "key": "key", "endpoint": "endpoint"}
#: What must stand near a weak part before it is reported.
NEEDS = {"account": ("key",), "key": ("account",), "endpoint": ("account", "key")}

ACCOUNT = re.compile(
    r"(?ai:user(?:_?name)?|login|account(?:_?id)?|client_?id|access_?key_?id)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9][\w.@-]{2,})", re.A
)
#: A whole run of any length; it may be the value of ``NAME=VALUE``.
KEY = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{32,}+={0,2}+(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(
    r"(?ai:https?|ftp|ssh|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)://[A-Za-z0-9.-]+(?::\d+)?"
    r"|(?ai:host(?:_?name)?|endpoint|server)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::\d+)?",
    re.A,
)
LEAST_ENTROPY = 4.0
#: Some word of each list is in any text that its pattern matches.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "api_key", "apikey")
ACCOUNT_WORDS = ("user", "login", "account", "clientid", "client_id", "accesskey", "access_key")
ENDPOINT_WORDS = ("://", "host", "endpoint", "server")


def entropy(value: str) -> float:
    """Bits a character."""
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in (value.count(c) for c in set(value)))


def random_looking(value: str) -> bool:
    return (
        any(map(str.isdigit, value))
        and any(map(str.isupper, value))
        and any(map(str.islower, value))
        and entropy(value) >= LEAST_ENTROPY
    )


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base kinds in order. Leftmost matches, each kind by itself, too short ones dropped."""
    found, low = [], text.lower()
    if any(word in low for word in ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    # A run is taken whole either way, so asking for the length at once drops the same matches.
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def weak_spans(text: str) -> list[tuple[int, int, int]]:
    """Parts that count only in company."""
    found, low = [], text.lower()
    if any(word in low for word in ACCOUNT_WORDS):
        found += [(m.start(1), 3, m.end(1)) for m in ACCOUNT.finditer(text)]
    found += [(m.start(), 4, m.end()) for m in KEY.finditer(text) if random_looking(m[0])]
    if any(word in low for word in ENDPOINT_WORDS):
        found += [(m.start(), 5, m.end()) for m in ENDPOINT.finditer(text)]
    return sorted(found)


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


SPAN = "array<struct<start:long, kind:int, end:long>>"


def scanned(docs: DataFrame) -> DataFrame:
    """Base and weak parts of each row, by pattern, over whole texts; ``key`` names the row by its content."""

    def per_batch(batch: list[str]) -> dict[str, list | np.ndarray | pa.Array]:
        base = [base_spans(t) for t in batch]
        weak = [weak_spans(t) for t in batch]
        rows = lambda spans: [[{"start": a, "kind": k, "end": b} for a, k, b in s] for s in spans]
        return {
            **{f"n_{KINDS[k]}": [sum(s[1] == k for s in spans) for spans in base] for k in range(3)},
            "base_sha256": [hashlib.sha256(written(s).encode()).hexdigest() for s in base],
            "base": rows(base),
            "weak": rows(weak),
        }

    schema = f"n_assign long, n_access long, n_hex long, base_sha256 string, base {SPAN}, weak {SPAN}"
    return map_texts(texts(docs).withColumn("key", row_key()), per_batch, schema)


def linked(parts: DataFrame) -> DataFrame:
    """The weak rows of ``parts`` (key, start, kind, end) whose complementary roles all occur within ``REACH``.

    The distance of two parts is that between the end of one and the start of the
    other, 0 if they overlap. Any two parts of one role may serve, base kinds too.
    """
    kind, first, last = F.col("kind"), F.floor(F.col("start") / REACH), F.floor(F.col("end") / REACH)
    role = F.element_at(F.array(*map(F.lit, (ROLE[k] for k in KINDS))), kind + 1)
    placed = parts.withColumn("role", role)
    covered = placed.withColumn("stretch", F.explode(F.sequence(first, last)))
    summary = covered.groupBy("key", "stretch", "role").agg(F.min("start").alias("lo"), F.max("end").alias("hi"))
    weak = placed.where(kind >= 3).dropDuplicates(["key", "start", "kind", "end"])
    looked = weak.withColumn("stretch", F.explode(F.sequence(first - 1, last + 1)))
    near = (
        looked.alias("w")
        .join(summary.alias("s"), ["key", "stretch"])
        .where(
            (F.col("w.role") != F.col("s.role"))
            & (F.col("s.lo") <= F.col("w.end") + REACH)
            & (F.col("s.hi") >= F.col("w.start") - REACH)
        )
    )
    seen = near.groupBy("key", "start", "kind", "end").agg(F.collect_set("s.role").alias("roles"))
    wanted = F.create_map(*(F.lit(x) for k in NEEDS for x in (KINDS.index(k), ",".join(NEEDS[k]))))
    needs = F.split(wanted[F.col("kind")], ",")
    return seen.where(F.size(F.array_intersect(needs, F.col("roles"))) == F.size(needs)).drop("roles")


def _with_spans(docs: DataFrame) -> DataFrame:
    """``scanned`` rows with all reported spans in ``every``."""
    rows = kept_table(scanned(docs))
    some = rows.where(F.size("weak") > 0).dropDuplicates(["key"])
    parts = some.select("key", F.inline(F.concat("base", "weak")))
    found = linked(parts).groupBy("key").agg(F.collect_list(F.struct("start", "kind", "end")).alias("more"))
    every = F.array_sort(F.concat("base", F.coalesce(F.col("more"), F.array().cast(SPAN))))
    return rows.join(found, "key", "left").withColumn("every", every)


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: counts and digest of the base kinds, and all spans.

    A null text is empty and has no spans; null ids and repeated rows are kept, each
    with its own text's spans. Offsets count code points, ends are exclusive.
    """
    names = F.array(*map(F.lit, KINDS))
    text = F.transform(
        "every",
        lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
    )
    return _with_spans(docs).select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", F.array_join(text, ",").alias("spans")
    )


MASK = "[secret]"


def masked(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with every reported span replaced by ``MASK``; overlapping ones by one.

    ``n_chars``, if there, follows the text. Rows without spans stay as they are, null texts too.
    """
    spans = _with_spans(docs).where(F.size("every") > 0).dropDuplicates(["key"])
    key, every = unused(docs, "key"), unused(docs, "every")
    found = cut(spans.select(F.col("key").alias(key), F.col("every").alias(every)))
    keys = broadcast_if_small(found.select(key))
    rest = docs.join(keys, row_key() == F.col(key), "left_anti")
    # Only rows with spans meet them; how long lists of spans are is not known, so those are not broadcast.
    hit = docs.join(keys, row_key() == F.col(key), "left_semi").join(found, row_key() == F.col(key))
    # Text is rebuilt from the pieces between spans; what a span shares with the one before it is skipped.
    start = {"at": F.lit(0).cast("long"), "out": F.lit("")}
    state = F.struct(*(v.alias(n) for n, v in start.items()))

    def step(s, span):
        kept = F.substring(F.col("text"), (s["at"] + 1).cast("int"), F.greatest(span["start"] - s["at"], F.lit(0)).cast("int"))
        mark = F.when((span["start"] >= s["at"]) & (span["end"] > s["at"]), F.lit(MASK)).otherwise("")
        return F.struct(F.greatest(s["at"], span["end"]).alias("at"), F.concat(s["out"], kept, mark).alias("out"))

    whole = F.aggregate(
        every, state, step, lambda s: F.concat(s["out"], F.substring(F.col("text"), (s["at"] + 1).cast("int"), F.length("text")))
    )
    changed = hit.withColumn("text", whole)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rest.unionByName(changed.select(*docs.columns))

