"""Small documents that hold every odd case."""

from pyspark.sql import functions as F

DATA = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor " * 20_000
ODD = [
    (1, "The quick brown fox jumps over the lazy dog near the river bank today"),
    (1, "The quick brown fox jumps over the lazy dog near the river bank today"),
    (2, "the quick brown FOX jumps over the lazy dog near the river bank today"),
    (3, ""),
    (4, None),
    (None, "no id here but a token = \"abcdef123456\" and words"),
    (None, None),
    (5, LONG),
    (6, "one"),
    (7, "two words"),
    (8, " \t\n "),
    (9, "é☃𓀀   x\x00y"),
]


def odd(spark, columns="doc_id long, text string"):
    """With columns whose names clash with those that operators make."""
    docs = spark.createDataFrame(ODD, columns)
    clash = ("score", "held_out", "key", "label", "words", "n", "seeds", "bucket", "chunk", "part", "spans", "component_id")
    return docs.withColumns({c: F.lit(None).cast("string") for c in clash}).withColumn("n_chars", F.length("text").cast("long"))


def none(spark, columns="doc_id long, text string"):
    return spark.createDataFrame([], columns)


def table(spark, name):
    return spark.read.parquet(f"{DATA}/{name}.parquet")
