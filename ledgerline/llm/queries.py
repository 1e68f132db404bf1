"""One query for each corpus operator: (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from ledgerline.llm import alignment, chat, contamination, licenses, nearest, neardup, ngrams, oracle, periodic, pieces, quality, secrets, toxicity, warc
from ledgerline.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
ROOT = str(Path(__file__).resolve().parents[2])


def _importable(spark: SparkSession) -> SparkSession:
    """Python workers started from now on find this library as the driver does."""
    environment = spark.sparkContext.environment
    if ROOT not in environment.get("PYTHONPATH", "").split(":"):
        environment["PYTHONPATH"] = ":".join(filter(None, [ROOT, environment.get("PYTHONPATH", "")]))
    return spark


def _near_duplicates(documents: DataFrame) -> DataFrame:
    return neardup.near_duplicates(documents, size=3, percent=85)


def _query(operator: Callable[..., DataFrame], *tables: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return operator(*(table(_importable(spark), sf_dir, name) for name in tables))

    return run


QUERIES: dict[str, Query] = {
    "pipeline": lambda spark, sf_dir: corpus_pipeline.run(_importable(spark), sf_dir),
    "op1_sentencepiece": _query(pieces.encoded, "documents"),
    "op2_warc": _query(warc.page_derivatives, "pages"),
    "op3_toxicity": _query(toxicity.toxicity_scores, "documents", "labels"),
    "op4_decontamination": _query(contamination.report, "documents", "benchmark"),
    "op5_secrets": _query(secrets.find_secrets, "documents"),
    "op6_language_model": _query(ngrams.language_scores, "documents"),
    "op7_minhash": _query(_near_duplicates, "documents"),
    "op8_quality": _query(quality.quality_scores, "documents", "labels"),
    "op9_nearest": _query(nearest.every_twentieth, "embeddings"),
    "op10_licenses": _query(licenses.find_licenses, "documents"),
    "op11_chat": _query(chat.report, "conversations"),
    "op12_alignment": _query(alignment.report, "documents"),
    "op13_periodic": _query(periodic.planted_report, "documents"),
}


def oracle_sql() -> dict[str, str]:
    whole = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {**whole, **oracle.oracle_sql()}
