"""Connected components by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.sources.cuts import cut


def _minima(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node around it; sums up before each shuffle."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = _minima(both).select("u", F.least("u", "m").alias("m"))
    return both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the smallest of them."""
    least = _minima(edges)
    passed = edges.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return passed.unionAll(least.select("u", F.col("m").alias("v")))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(2**40)))).first())


def components(links: DataFrame) -> DataFrame:
    """``doc_id`` and ``component_id`` (smallest id reachable) of every id in ``links`` (a, b).

    Links may repeat, run either way or join an id with itself; a null end makes no link.
    The driver sees a count and a checksum in each round. The edges at the end are
    stars around the smallest ids.
    """
    known = links.where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
    edges = cut(known.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    state = _state(edges)
    while True:
        edges = cut(_small_star(_large_star(edges).distinct()).distinct())
        before, state = state, _state(edges)
        if state == before:
            break
    members = edges.select(F.col("u").alias("doc_id"), F.col("v").alias("component_id"))
    return members.unionAll(members.select(F.col("component_id").alias("doc_id"), "component_id").distinct())
