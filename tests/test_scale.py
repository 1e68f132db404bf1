"""Plans and results that must hold on large and skewed data."""

import random
import re
from contextlib import contextmanager
from dataclasses import replace
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import amounts, batches, daily, pick, recon
from ledgerline.plans import extracts, settlement
from ledgerline.sources import cuts, schemas
from ledgerline.sources.inputs import DECLARED, conform_inputs
from testbed import binding
from tests.books import PARAMS, Books, noon

SMALL = "/root/testdata/sf0.001"


@contextmanager
def settings(spark, **values):
    values = {k.replace("__", "."): str(v) for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


NO_BROADCAST = {"spark__sql__autoBroadcastJoinThreshold": -1}


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_report_without_broadcast_joins_is_the_same(spark):
    inputs = binding.inputs(spark, SMALL)
    expected = rows_of(settlement.settlement_report(inputs, binding.PARAMS))
    with settings(spark, **NO_BROADCAST, spark__sql__adaptive__autoBroadcastJoinThreshold=-1):
        assert rows_of(settlement.settlement_report(inputs, binding.PARAMS)) == expected


def test_report_does_not_depend_on_the_session_time_zone(spark):
    expected = rows_of(settlement.settlement_report(binding.inputs(spark, SMALL), binding.PARAMS))
    with settings(spark, spark__sql__session__timeZone="Asia/Jakarta"):
        assert rows_of(settlement.settlement_report(binding.inputs(spark, SMALL), binding.PARAMS)) == expected


def test_window_filter_and_columns_reach_the_scan(spark):
    text = plan(amounts.signed_daily(binding.ledger(spark, SMALL), binding.PARAMS))
    assert "GreaterThanOrEqual(ts,2024-01-14T00:00" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"ts", "user_id", "value", "props"}


def test_tables_stored_by_date_are_pruned(spark, tmp_path):
    inputs = Books().row(6, 100).balance(7, 100).inputs(spark)
    clock = {"ledger": "txn_date", "transactions": "trx_date", "ops_balances": "processed_dttm"}
    tables, feeds = {n: getattr(inputs, n) for n in DECLARED}, {}
    tables["transactions"] = spark.createDataFrame([("1", noon(6))], schemas.TRANSACTIONS)
    tables["public_holidays"] = spark.createDataFrame([(date(2025, 12, 25),), (date(2026, 1, 1),)], schemas.HOLIDAYS)
    tables["holiday_coverage"] = spark.createDataFrame([(date(2025, 1, 1), date(2026, 12, 31))], schemas.HOLIDAY_COVERAGE)
    for name, column in clock.items():
        path = str(tmp_path / name)
        tables[name].withColumn("dt", F.to_date(column)).write.partitionBy("dt").parquet(path)
        tables[name] = spark.read.parquet(path)
    for spec in recon.FEEDS:
        empty = spark.createDataFrame([], f"{spec.key} string, {spec.timestamp} timestamp_ntz")
        feeds[spec.name] = inputs.feeds.get(spec.name, empty).withColumn("dt", F.to_date(spec.timestamp))
    stored = dict.fromkeys([*clock, *feeds], "dt")
    bound = conform_inputs(spark, tables, feeds, PARAMS, stored_by=stored)
    for name, first_day in (("ledger", "2025-12-15"), ("transactions", "2025-11-10"), ("ops_balances", "2025-10-31")):
        text = plan(getattr(bound, name))
        assert re.search(rf"PartitionFilters: \[[^\]]*dt#\d+ >= {first_day}", text)
    rates = replace(bound, rates=inputs.rates, holidays=inputs.holidays)
    expected = rows_of(settlement.settlement_report(inputs, PARAMS))
    assert rows_of(settlement.settlement_report(rates, PARAMS)) == expected


def test_a_date_far_in_the_future_neither_blows_up_the_report_nor_changes_it(spark):
    def books():
        return Books().row(6, 100000).balance(7, 100000)

    stray = books().row(datetime(2999, 12, 31, 12), 5, name="Shop")
    assert stray.report(spark) == books().report(spark)
    days = settlement.days_of(stray.inputs(spark), PARAMS, settlement.last_reported_day(PARAMS))
    assert days.count() == 2 * len(range(5, 14))
    # Without a given end the spine ends with the tail after the run date.
    assert settlement.days_of(stray.inputs(spark), PARAMS).count() == 2 * len(range(5, 14 + 7 + 1))


def test_one_join_matches_all_routes(spark):
    """Ledger rows are shuffled for one look-up and for the de-duplication, not once for each route."""
    inputs = binding.inputs(spark, SMALL)
    with settings(spark, **NO_BROADCAST):
        text = plan(recon.flag_matches(inputs.ledger.withColumn("trx_date", F.to_date("txn_date")), settlement.match_keys(inputs, binding.PARAMS)))
        left = [line for line in text.splitlines() if "LeftOuter" in line and "trx_date" in line]
    assert len(left) == 1


def test_no_look_up_of_codes_that_nobody_reads(spark):
    inputs = binding.inputs(spark, SMALL)
    given = extracts.extracts(inputs, binding.PARAMS, all_codes=False)
    rows = extracts.settled_rows(given.base, binding.PARAMS)
    with settings(spark, **NO_BROADCAST):
        assert "min(approval_code" not in rows._jdf.queryExecution().optimizedPlan().toString()
        assert "match_key" not in plan(extracts.extract_counts(inputs, binding.PARAMS))


def test_spine_and_walk_share_one_exchange_and_one_sort(spark):
    """From daily sums, measures and ops balances to settled batches: one shuffle by account."""

    def stored(df):
        return cuts.cut(df)

    inputs = binding.inputs(spark, SMALL)
    totals = stored(settlement.daily(inputs, binding.PARAMS))
    first, last = daily.spine_bounds(totals, binding.PARAMS)
    measures = stored(amounts.day_measures(inputs.ledger, binding.PARAMS))
    ops = stored(daily.ops_by_balance_date(inputs.ops_balances))
    accounts = stored(daily.account_spine(totals, first, last)).withColumnRenamed("merch_name", "_last_name")
    laid = daily.lay_on_spine(accounts, totals, measures, ops)
    calendar = stored(settlement.settlement_calendar(inputs.holidays, first, last))
    text = plan(batches.settlements(daily.account_days(laid, calendar, binding.PARAMS), binding.PARAMS))
    assert text.count("Exchange hashpartitioning") == 1
    assert text.count("Sort [") == 1
    assert text.count("Join") == 1  # the calendar


def test_one_row_per_key_is_cut_down_before_the_shuffle(spark):
    df = binding.bank_accounts(spark, SMALL)
    text = plan(pick.preferred_bank(df))
    final, exchange, partial = (
        text.index("WindowGroupLimit"),
        text.index("Exchange hashpartitioning"),
        text.rindex("WindowGroupLimit"),
    )
    assert final < exchange < partial


def hot_books(spark, n=20000):
    """A third of the ledger is copies of one row, a third one account without ids, the rest ordinary."""
    null = "cast(null as {})".format
    noon_6 = "timestamp_ntz '2026-01-06 12:00:00'"

    def rows(account, at, trx_id, extref):
        df = spark.range(n).selectExpr(
            f"{account} as account_id", "'m' as merchant_id", "'Shop' as merch_name", f"{at} as txn_date",
            "'X' as issuer", "'Customer Purchase' as txn_type", "10 as amt", f"{trx_id} as credit_trans_trx_id",
            f"{null('string')} as issuer_txn_ref", f"{extref} as txn_extref", "'t' as txn_ref", "'t' as terminal_id",
        )
        return schemas.conform(df, schemas.LEDGER)

    copies = rows("100", noon_6, "1", "'hot'")
    no_id = rows("200", f"{noon_6} + make_dt_interval(0, 0, 0, id % 3600)", null("bigint"), null("string"))
    plain = rows("300 + id % 50", noon_6, "id + 10", "concat('r', id)")

    def feed(df):
        return df.selectExpr("txn_extref as transaction_id", "txn_date as create_time")

    merchants = [(a, "R1", "t", 1) for a in [100, 200, *range(300, 350)]]
    return replace(
        Books(spine_anchor=False).inputs(spark),
        ledger=copies.unionByName(no_id).unionByName(plain),
        feeds={"shopeepay": feed(copies).unionByName(feed(plain.where("credit_trans_trx_id % 2 = 0")))},
        merchants=spark.createDataFrame(merchants, schemas.MERCHANTS),
    )


@pytest.mark.parametrize("broadcast", [True, False])
def test_hot_groups_keep_their_whole_result(spark, broadcast):
    n = 20000
    limits = {} if broadcast else NO_BROADCAST
    with settings(
        spark,
        **limits,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="16KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="16KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor=1.2,
    ):
        totals = settlement.daily(hot_books(spark, n), PARAMS)
        got = {r.account_id: r for r in totals.collect()}
    assert got[100].amount_base == 10 and got[100].unmatched_traffic == 0
    assert got[200].unmatched_amount == 10 and got[200].unmatched_traffic == 1
    assert sum(got[a].amount_base for a in range(300, 350)) == 10 * n / 2
    assert sum(got[a].unmatched_traffic for a in range(300, 350)) == n / 2


def test_hot_reference_is_split_over_several_tasks(spark):
    """A reference shared by a third of the rows: the adaptive rule splits its side of the join."""
    n = 60000
    rows = spark.range(n, numPartitions=6).select(
        F.lit(100).cast("bigint").alias("account_id"),
        F.lit(noon(6)).cast("timestamp_ntz").alias("txn_date"),
        F.to_date(F.lit("2026-01-06")).alias("trx_date"),
        F.col("id").alias("credit_trans_trx_id"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("r"), F.col("id"))).alias("ref"),
        F.sha2(F.col("id").cast("string"), 256).alias("payload"),
    )
    keys = rows.select(F.col("ref").alias("match_key"), F.col("trx_date").alias("feed_date"))
    with settings(
        spark,
        **NO_BROADCAST,
        spark__sql__shuffle__partitions=8,
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64KB",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor=2,
    ):
        found = recon.look_up(rows, recon.distinct_keys(keys), F.col("ref"), F.lit(True), "hit")
        counted = found.groupBy("hit", F.substring("payload", 1, 1)).count()
        assert sum(r["count"] for r in counted.where("hit").collect()) == n
        counted.collect()
        text = plan(counted)
    assert re.search(r"SortMergeJoin\(skew=true\) \[_key", text)


def test_card_route_equals_brute_force_with_hot_codes_and_ids(spark):
    """A third of the references share a code, a third share a transaction; ids and keys repeat."""
    rng = random.Random(7)
    code, trx = (lambda: f"c{rng.randint(1, 60)}"), (lambda: str(rng.randint(1, 80)))
    refs = [(trx(), "hot") for _ in range(100)] + [("0", code()) for _ in range(100)]
    refs += [(trx(), code()) for _ in range(100)] + [(None, "hot"), (trx(), None)]
    known = ["0"] * 100 + [trx() for _ in range(100)] + [None]
    feed = [("hot_payment", noon(n)) for n in (6, 7, 8)] * 20
    feed += [(f"{code()}_payment", noon(rng.randint(5, 9))) for _ in range(60)] + [(None, noon(6))]
    expected = {
        (t, at.date())
        for t, c in refs
        for key, at in feed
        if t in known and t is not None and c is not None and key == f"{c}_payment"
    }
    with settings(spark, **NO_BROADCAST):
        feeds = {"linkaja_mcd": spark.createDataFrame(feed, "sequence_id string, transaction_date timestamp_ntz")}
        transactions = spark.createDataFrame([(t, noon(6)) for t in known], schemas.TRANSACTIONS)
        card_refs = spark.createDataFrame([(t, c, noon(6)) for t, c in refs], schemas.CARD_REFS)
        keys = recon.keys_by_route(feeds, transactions, card_refs, PARAMS)[recon.APPROVAL]
        got = [(r.match_key, r.feed_date) for r in keys.collect()]
        codes = dict(map(tuple, recon.approval_codes(transactions, card_refs, PARAMS).collect()))
    assert len(got) == len(set(got)) and set(got) == expected
    assert codes == {
        t: min((c for r, c in refs if r == t and c is not None), default=None)
        for t in {t for t, _ in refs if t in known and t is not None}
    }


def test_a_cluster_must_name_a_checkpoint_folder():
    class Context:
        master = "spark://host"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        cuts.shared_folder(Session())


def test_cut_reads_from_the_checkpoint(spark):
    df = cuts.cut(spark.range(10))
    assert df.count() == 10
    folder = spark.sparkContext.getCheckpointDir()
    assert folder and "Scan ExistingRDD" in plan(df)
