"""Documents to piece ids: reject poor ones, near copies and benchmark leaks, mask secrets, encode."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.llm import contamination, neardup, pieces, quality, secrets
from ledgerline.llm.common import table
from ledgerline.sources.cuts import kept_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.without_near_duplicates(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return contamination.without_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.masked(docs)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encoded(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", good_documents),
    ("near_duplicates", one_of_each),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("sentencepiece", piece_ids),
]

#: Trained trees, minima, tilings and Viterbi paths are beyond SQL; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; each is stored as Parquet in the shared folder and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = kept_table(stage(spark, docs, sf_dir))
    return docs
