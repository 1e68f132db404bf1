"""Stages keep every column of any name, with its values."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.rows import DATA, odd

NAMES = ["key", "_key", "every", "_spans", "own_id", "_id", "place", "_place", "score", "_score", "__score", "KEY2", "Seeds", "text_", "n", "item"]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES[:-1])
def test_columns_stay(spark, name, stage):
    docs = odd(spark).select("doc_id", "text", "n_chars").withColumns({c: F.lit(f"value of {c}") for c in NAMES})
    secret = spark.createDataFrame([(50, "password = abcdef123456 and the rest of it")], "doc_id long, text string")
    docs = docs.unionByName(secret.withColumns({c: F.lit(f"value of {c}") for c in NAMES}), allowMissingColumns=True)
    out = stage(spark, docs, DATA)
    assert out.columns == docs.columns
    for r in out.collect():
        assert {c: r[c] for c in NAMES} == {c: f"value of {c}" for c in NAMES}
