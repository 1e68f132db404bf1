"""Nearest neighbours by multi-index hashing of learned rotated binary codes.

A rotation learned on a sample turns each vector into a code of bits whose Hamming
distance follows the angle. Rows are dealt into blocks; in each block every
substring of the codes has an index of its own. If two codes differ in at most
``r`` bits, then in one of ``m`` substrings they differ in at most ``r // m``
(pigeonhole), so probing the substrings within that many flips finds every code
within the radius. Those are ranked by their inner products on the vectors
themselves. A query widens its radius until the codes beyond it can hardly hold a
vector as near as its best ones so far.

Inner products of vectors of different lengths become angles by one more
component that brings all of them to the largest length; a query has 0 there.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

NEIGHBOURS = 20
QUERY_EVERY = 20
SAMPLE_ROWS = 5_000
SUBSTRINGS, SUBSTRING_BITS = 16, 8
BITS = SUBSTRINGS * SUBSTRING_BITS
ROTATION_ROUNDS = 30
BLOCK_ROWS = 8_192
QUERY_BLOCK = 2_048
#: Share of pairs of a similarity whose codes may lie beyond the radius that it is searched with.
MISSED = 0.03


def whole(vectors: DataFrame) -> DataFrame:
    """``vec_id`` and ``v`` of the rows that take part: no null, no null or non-finite component, not all zero.

    Repeated ids count once, by the smallest vector.
    """
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
    finite: Column = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists("v", lambda x: x != 0)
    kept = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & some)
    return kept.groupBy("vec_id").agg(F.min("v").alias("v"))


@dataclass(frozen=True)
class Coder:
    """``rotation`` and ``centre`` of the codes; ``radius[s]``: Hamming radius for the cosine ``s / 100 - 1``."""

    width: int
    length: float
    centre: np.ndarray
    rotation: np.ndarray
    radius: np.ndarray

    def rows(self, v: np.ndarray, query: bool) -> np.ndarray:
        """Unit vectors with the added component; a query, whose length changes no order, has 0 there."""
        norm = np.linalg.norm(v, axis=1)
        if query:
            return np.column_stack([v / norm[:, None], np.zeros(len(v))])
        rest = np.sqrt(np.maximum(self.length**2 - norm**2, 0))
        return np.column_stack([v, rest]) / self.length

    def codes(self, v: np.ndarray, query: bool) -> np.ndarray:
        bits = (self.rows(v, query) - self.centre) @ self.rotation > 0
        return np.packbits(bits, axis=1)

    def reach(self, cosine: np.ndarray) -> np.ndarray:
        return self.radius[np.clip(np.floor((cosine + 1) * 100).astype(int), 0, 200)]


def fit(vectors: DataFrame, width: int, length: float, sample_rows: int = SAMPLE_ROWS) -> Coder:
    """Iterative quantisation on at most ``sample_rows`` vectors picked by a hash of the id.

    Principal directions, then rotations that bring the sample nearer to the
    corners of a cube. Fewer components than bits are filled up with further
    rotations. The radii come from the share of unequal bits that pairs of the sample have at
    each similarity.
    """
    picked = vectors.where(F.size("v") == width).orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows)
    v = np.array(picked.toPandas()["v"].tolist(), np.float64).reshape(-1, width)
    blank = Coder(width, length, np.zeros(width + 1), np.zeros((width + 1, BITS)), np.full(201, BITS))
    x = blank.rows(v, query=False)
    centre = x.mean(axis=0)
    # Both sides are cut at the same planes; the added component is left out of the centre, as queries have none.
    centre[-1] = 0.0
    rng = np.random.default_rng(7)
    parts, left = [], BITS
    basis = np.linalg.eigh((x - centre).T @ (x - centre))[1][:, ::-1]
    while left:
        k = min(left, width + 1)
        turn = np.linalg.qr(rng.standard_normal((k, k)))[0]
        low = (x - centre) @ basis[:, :k]
        for _ in range(ROTATION_ROUNDS):
            u, _, wt = np.linalg.svd(np.where(low @ turn > 0, 1.0, -1.0).T @ low)
            turn = (u @ wt).T
        parts.append(basis[:, :k] @ turn)
        left -= k
    coder = Coder(width, length, centre, np.column_stack(parts), blank.radius)
    return Coder(width, length, centre, coder.rotation, _radii(coder, v))


def _radii(coder: Coder, v: np.ndarray) -> np.ndarray:
    """For each cosine the distance that all but ``MISSED`` of the sample's pairs of that cosine keep within.

    Where the sample has few pairs the angle decides: its share of the bits and three standard errors.
    """
    cosine = np.arange(201) / 100 - 1
    share = np.arccos(np.clip(cosine, -1, 1)) / np.pi
    out = np.ceil(BITS * share + 3 * np.sqrt(BITS * share * (1 - share)))
    some = v[:1_000]
    rows, queries = coder.codes(v, query=False), coder.codes(some, query=True)
    inner = coder.rows(some, query=True) @ coder.rows(v, query=False).T
    place = np.clip(np.floor((inner + 1) * 100).astype(int), 0, 200)
    far = np.zeros(inner.shape, np.int64)
    for byte in range(rows.shape[1]):
        far += np.bitwise_count(queries[:, byte, None] ^ rows[None, :, byte])
    np.fill_diagonal(place, 200)
    counts = np.zeros((201, BITS + 1), np.int64)
    np.add.at(counts, (place.ravel(), far.ravel()), 1)
    for s in range(201):
        near = counts[max(0, s - 1) : s + 2].sum(axis=0)
        if near.sum() >= 500:
            out[s] = np.searchsorted(np.cumsum(near), (1 - MISSED) * near.sum())
    # The less alike, the farther: no cosine has a smaller radius than a larger one.
    return np.minimum(np.maximum.accumulate(out[::-1])[::-1], BITS).astype(np.int64)


FLIPS = [
    np.array([sum(1 << b for b in c) for c in combinations(range(SUBSTRING_BITS), k)], np.uint8)
    for k in range(SUBSTRING_BITS + 1)
]


class Block:
    """The substring indexes of one block of rows: row numbers sorted by each substring's value."""

    def __init__(self, codes: np.ndarray):
        self.wide = codes.view(np.uint64)
        self.order = np.argsort(codes, axis=0, kind="stable").T.ravel()
        counts = np.stack([np.bincount(column, minlength=256) for column in codes.T])
        self.size = counts.ravel()
        self.start = np.cumsum(self.size) - self.size

    def probe(self, code: np.ndarray, flips: int, seen: np.ndarray) -> np.ndarray:
        """Rows not ``seen`` of which some substring differs from the query's in exactly ``flips`` bits."""
        buckets = ((FLIPS[flips] ^ code[:, None]) + 256 * np.arange(SUBSTRINGS)[:, None]).ravel()
        size = self.size[buckets]
        skipped = np.repeat(self.start[buckets] - np.cumsum(size) + size, size)
        fresh = np.zeros(len(seen), bool)
        fresh[self.order[skipped + np.arange(len(skipped))]] = True
        fresh &= ~seen
        seen |= fresh
        return np.flatnonzero(fresh)

    def distance(self, code: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.bitwise_count(self.wide[rows] ^ code.view(np.uint64)).sum(axis=1, dtype=np.int64)


def search_block(
    coder: Coder, queries: np.ndarray, query_ids: np.ndarray, rows: np.ndarray, row_ids: np.ndarray, k: int
) -> Iterator[tuple[int, int, float]]:
    """The ``k`` best rows of one block for each query, as (query, row, inner product)."""
    index, codes = Block(coder.codes(rows, query=False)), coder.codes(queries, query=True)
    scales = np.maximum(np.linalg.norm(queries, axis=1) * coder.length, 1e-300)
    for query, own, code, scale in zip(queries, query_ids, codes, scales, strict=True):
        seen = row_ids == own
        best, scores = np.zeros(0, np.int64), np.zeros(0)
        waiting, far = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for flips in range(SUBSTRING_BITS + 1):
            met = index.probe(code, flips, seen)
            waiting, far = np.append(waiting, met), np.append(far, index.distance(code, met))
            # By the pigeonhole rule all codes within this radius have been met.
            radius = SUBSTRINGS * (flips + 1) - 1
            needed = coder.reach(scores[-1:] / scale)[0] if len(best) >= k else BITS
            near = far <= min(radius, needed)
            best, scores = _best(rows, row_ids, query, np.append(best, waiting[near]), k)
            waiting, far = waiting[~near], far[~near]
            if len(best) >= k and radius >= coder.reach(scores[-1:] / scale)[0]:
                break
        for row, score in zip(best, scores, strict=True):
            yield int(own), int(row_ids[row]), float(score)


def _best(
    rows: np.ndarray, row_ids: np.ndarray, query: np.ndarray, found: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` of ``found`` with the largest inner products, ties to the smaller id."""
    rough = rows[found] @ query
    if len(found) > k:
        # Rounding differs between ways to sum, so what is nearly as good as the k-th stays for the exact sums.
        edge = np.partition(rough, -k)[-k]
        found = found[rough >= edge - 1e-9 * (1 + abs(edge))]
    scores = _inner(rows[found], query)
    top = np.lexsort((row_ids[found], -scores))[:k]
    return found[top], scores[top]


def _inner(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Summed the same way for every row, so that equal vectors score alike wherever they are."""
    return (rows * query).sum(axis=1)


def nearest(vectors: DataFrame, queries: DataFrame, k: int = NEIGHBOURS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of ``vectors`` with the largest inner product for each query.

    Both have ``vec_id`` and ``embedding``. A query is no answer to itself; ties go to the smaller id.
    Vectors that are null, zero, or hold null or non-finite components take no part.
    A query's candidates are the rows of its own width; each width that queries have is searched by itself.
    Fewer than ``k`` rows are all returned. Every row is indexed; a query block meets
    every row block, and leaves at most ``k`` rows a query.
    """
    rows = whole(vectors)
    widths = rows.groupBy(F.size("v").alias("width")).agg(
        F.count("*").alias("n"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)).alias("square")
    )
    asked = whole(queries)
    # A row for each width, of which an embedding table has few.
    sizes = widths.join(asked.groupBy(F.size("v").alias("width")).agg(F.count("*").alias("asked")), "width")
    found = [
        _of_width(rows, asked, Coded(r.width, r.n, r.square**0.5, r.asked), k) for r in sizes.orderBy("width").collect()
    ]
    if not found:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    # At most k rows from each cell; Spark cuts each query to k before the shuffle too.
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    every = reduce(DataFrame.unionByName, found)
    return every.select("query_id", F.row_number().over(by_query).alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


@dataclass(frozen=True)
class Coded:
    """One width: its rows, the length of the longest, and how many queries it has."""

    width: int
    n: int
    length: float
    asked: int


def _of_width(every_row: DataFrame, every_query: DataFrame, of: Coded, k: int) -> DataFrame:
    """``query_id, vec_id, score``: the ``k`` best of each block for each query of one width."""
    width, schema = of.width, "query_id long, vec_id long, score double"
    rows, asked = (df.where(F.size("v") == width) for df in (every_row, every_query))
    coder = fit(rows, width, of.length)
    blocks = max(1, -(-of.n // BLOCK_ROWS))
    query_blocks = max(1, -(-of.asked // QUERY_BLOCK))
    i = F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int")
    j = F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int")
    row_cells = rows.select(
        i.alias("i"), F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("j"), "vec_id", "v"
    )
    query_cells = asked.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("i"), j.alias("j"), "vec_id", "v")

    def matrix(table: pa.Table) -> np.ndarray:
        flat = table.column("v").combine_chunks().flatten()
        return flat.to_numpy(zero_copy_only=False).reshape(-1, width)

    def cell(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int, float]] = []
        if left.num_rows and right.num_rows:
            ids = [t.column("vec_id").to_numpy() for t in (left, right)]
            found = list(search_block(coder, matrix(left), ids[0], matrix(right), ids[1], k))
        frame = pd.DataFrame(found, columns=["query_id", "vec_id", "score"])
        return pa.Table.from_pandas(
            frame.astype({"query_id": "int64", "vec_id": "int64", "score": "float64"}), preserve_index=False
        )

    return query_cells.groupBy("i", "j").cogroup(row_cells.groupBy("i", "j")).applyInArrow(cell, schema)


def every_twentieth(vectors: DataFrame) -> DataFrame:
    """The stated query set, rows whose id is divisible by 20, against all rows."""
    return nearest(vectors, vectors.where(F.col("vec_id") % QUERY_EVERY == 0))
