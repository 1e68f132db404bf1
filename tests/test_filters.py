"""The key filter never loses a key, and references and transactions meet it before they are shuffled."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerline.functions.filters import key_filter, may_hold
from ledgerline.operators import recon
from ledgerline.plans.params import Params
from ledgerline.sources import schemas

BITS = 2**16
PARAMS = Params(as_of=datetime(2026, 1, 14).date(), reference_filter_bits=BITS)
NOON = datetime(2026, 1, 13, 12)


def texts(spark, first, last):
    return spark.range(first, last).select(F.concat(F.lit("key"), "id").alias("key"))


def passing(rows, keys, bits=BITS):
    return rows.where(may_hold(key_filter(keys, "key", bits), F.col("key"), bits))


def test_every_key_passes_and_few_others(spark):
    keys, others = texts(spark, 0, 4096), texts(spark, 10_000, 60_000)
    assert passing(keys, keys).count() == 4096
    # 16 bits a key
    assert passing(others, keys).count() < 0.02 * 50_000


@pytest.mark.parametrize("bits", [64, 100, 640])
def test_a_filter_too_small_loses_no_key(spark, bits):
    keys = texts(spark, 0, 3000)
    assert passing(keys, keys, bits).count() == 3000


def test_repeated_null_and_no_keys(spark):
    keys = spark.createDataFrame([("a",), ("a",), (None,), ("",), ("x" * 100_000,)], "key string")
    assert passing(keys.where("key is not null"), keys).count() == 4
    assert passing(keys, keys.where("false")).count() == 0
    one = key_filter(keys.where("key = 'a'"), "key", BITS).collect()
    assert len(one) == 1 and sum(w != 0 for w in one[0].words) == 1 and len(one[0].words) == BITS // 64


def test_numbers_as_keys(spark):
    keys = spark.range(1000).select(F.col("id").alias("key"))
    assert passing(keys, keys).count() == 1000


def test_a_filter_has_a_word(spark):
    with pytest.raises(ValueError, match="one word"):
        key_filter(texts(spark, 0, 1), "key", 63)


def card_route(spark, tmp_path, hits, rows):
    """Stored tables of ``rows`` transactions with a reference each, of which the feed names ``hits``."""
    ids = spark.range(rows)
    at = F.lit(NOON).cast("timestamp_ntz")
    tables = {
        "trx": ids.select(F.col("id").cast("string").alias("trx_id"), at.alias("trx_date")).to(schemas.TRANSACTIONS),
        "refs": ids.select(
            F.col("id").cast("string").alias("yt_ref"), F.concat(F.lit("c"), "id").alias("approval_code"), at.alias("transaction_date")
        ).to(schemas.CARD_REFS),
        "feed": ids.where(F.col("id") < hits).select(
            F.concat(F.lit("c"), "id", F.lit("_payment")).alias("sequence_id"), at.alias("transaction_date")
        ),
    }
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / name))
    read = {name: spark.read.parquet(str(tmp_path / name)) for name in tables}
    keys = recon.keys_by_route({"linkaja_mcd": read["feed"]}, read["trx"], read["refs"], PARAMS)
    return keys[recon.APPROVAL]


def test_both_scans_are_filtered_below_their_shuffle(spark, tmp_path):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        keys = card_route(spark, tmp_path, hits=50, rows=40_000)
        got = {r.match_key for r in keys.collect()}
        shown = keys._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == {str(n) for n in range(50)}
    for column in ("approval_code", "trx_id"):
        # The filter stands over the scan of its column, and an exchange over both.
        probes = [line for line in shown.splitlines() if " Filter " in line and "subquery" in line.lower() and f"xxhash64({column}#" in line]
        assert probes, f"no filter on {column}"
    # What comes out of the exchanges is near the 50 matches, not near 40,000 rows.
    passed = shuffled_rows(keys)
    assert passed and max(passed) < 1000


def shuffled_rows(df):
    """Rows written by each shuffle of the last run of ``df``, subqueries left out."""
    found, stack = [], [df._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            stack.append(node.executedPlan())
            continue
        if re.search("QueryStage$", name):
            stack.append(node.plan())
            continue
        if name == "Exchange":
            found.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        stack += [children.apply(n) for n in range(children.size())]
    return found
