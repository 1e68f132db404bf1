"""Column helpers that the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

WORD_MIX = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``text`` alone; other columns, whatever their names, can't clash. A null text is empty."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )


def unused(docs: DataFrame, name: str) -> str:
    """``name`` with as many ``_`` before it as it takes to differ from the names of all columns of ``docs``."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def remainder(folds: int) -> Column:
    """crc32 of the decimal id modulo ``folds``; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string")) % folds


def held_out(folds: int, fold: int) -> Column:
    """Rows that nothing is learnt from. A null id is in no fold and has no label, so it is not held out."""
    return F.coalesce(remainder(folds) == fold, F.lit(False)).alias("held_out")


def row_key() -> Column:
    """Names a row by its content, so that re-run tasks and repeated rows give the same name."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return F.md5(F.concat_ws("\u0000", F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("-")), text))


BROADCAST_ROWS = 1_000_000


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Broadcast ``df``, short rows that were already cut, if they are counted to be few; else Spark shuffles, with the same result."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


SLICE_BYTES = 2_000_000


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of ``column``: what a worker holds follows bytes, not rows.

    A longer value is a batch by itself. Empty batches go.
    """
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(at, stop - at)
            at = stop
        del batch
        pa.default_memory_pool().release_unused()


def map_texts(
    df: DataFrame, per_batch: Callable[[list[str]], dict[str, list | np.ndarray | pa.Array]], schema: str, text: bool = False
) -> DataFrame:
    """Append columns computed from ``text``, a batch of rows at a time; ``text`` itself goes unless asked for.

    ``per_batch`` gets the batch's texts and returns the columns that ``schema`` names. Under
    the name ``None`` it may also return which rows stay.
    """
    kept = [f for f in df.schema.fields if text or f.name != "text"]
    out = df.sparkSession.createDataFrame([], schema).schema
    full = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in [*kept, *out])
    passed, own = [f.name for f in kept], {f.name: f.type for f in to_arrow_schema(out)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            made = per_batch(batch.column("text").to_pylist())
            columns = [batch.column(n) for n in passed]
            columns += [made[n] if isinstance(made[n], pa.Array) else pa.array(made[n], kind) for n, kind in own.items()]
            result = pa.RecordBatch.from_arrays(columns, names=[*passed, *own])
            yield result.filter(pa.array(made[None], pa.bool_())) if None in made else result

    return df.mapInArrow(run, full)


BITMAP_BITS = 23


def bitmap(hashes: DataFrame, column: str) -> np.ndarray:
    """A Bloom filter with two places for each value of ``column``: one megabyte, however many rows there are.

    It passes every row that has a partner and, the more values there are, more that
    have none; a join then decides. Built on the executors, 64 bits a row.
    """
    h, mask = F.col(column), 2**BITMAP_BITS - 1
    both = F.array(h.bitwiseAND(mask), F.shiftrightunsigned(h, BITMAP_BITS).bitwiseAND(mask))
    bits = hashes.select(F.explode(both).alias("slot")).selectExpr("shiftright(slot, 6) at", "shiftleft(1L, int(slot & 63)) bit")
    words = bits.groupBy("at").agg(F.bit_or("bit").alias("bits")).toPandas()
    out = np.zeros(2 ** (BITMAP_BITS - 6), np.int64)
    out[words["at"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64)
    return out.view(np.uint64)


def in_bitmap(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    mask, found = np.uint64(2**BITMAP_BITS - 1), True
    for place in (hashes & mask, (hashes >> np.uint64(BITMAP_BITS)) & mask):
        found &= (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) > 0
    return found


def ascii_words(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z: exactly what bytes do."""
    return text.encode("utf-8", "replace").lower().split()


def hashed(words: list) -> np.ndarray:
    """64-bit hash of each word, the same on every worker."""
    if not words:
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(np.array(words, dtype=object), categorize=True)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def labelled_sample(labels: DataFrame, target: str, folds: int, fold: int, rows: int) -> DataFrame:
    """At most ``rows`` labelled ids outside the held-out fold, picked by a hash of the id.

    Repeated labels of one id count once, as the larger; null or other values are no labels.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(target).cast("int").alias("label"))
    known = known.where(F.col("label").isin(0, 1) & (remainder(folds) != fold))
    once = known.groupBy("doc_id").agg(F.max("label").alias("label"))
    return once.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
