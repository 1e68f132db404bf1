"""Reports from stored day states equal reports computed anew, whatever arrives late."""

import random
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import incremental
from ledgerline.plans.job import run, run_from_states
from ledgerline.plans.settlement import matched_rows, settlement_report
from ledgerline.sources import snapshots
from ledgerline.sources.sink import read_report
from tests.books import OTHER, PARAMS, Books, day, noon


def rows_of(df):
    return sorted(map(repr, df.collect()))


def busy_books():
    """Ids come again on other days, matched or not, and some rows have none."""
    rng = random.Random(4)
    books = Books()
    for _ in range(120):
        books.row(
            datetime(2026, 1, rng.randrange(1, 14), rng.randrange(24)),
            rng.randrange(1, 90_000),
            account=rng.choice((100, OTHER)),
            trx=rng.choice(("next", None, *range(500, 520))),
            matched=rng.random() < 0.6,
        )
    for n in range(2, 14):
        books.balance(n, 10_000 * n)
    return books


def test_day_by_day_equals_anew_with_late_rows_and_feeds(spark, tmp_path):
    inputs, path = busy_books().inputs(spark), str(tmp_path / "states")
    feed = inputs.feeds["shopeepay"]
    matched = []
    for n, ledger_hours, feed_hours in ((8, 24, 9), (10, 20, 12), (14, 24, 24)):
        # Late evenings of the ledger, and most of a feed's last days, come with a later run.
        last = noon(n) - timedelta(days=3)
        now = replace(
            inputs,
            ledger=inputs.ledger.where((F.col("txn_date") < F.lit(last)) | (F.hour("txn_date") < ledger_hours)).where(F.col("txn_date") < F.lit(noon(n))),
            feeds={"shopeepay": feed.where((F.col("create_time") < F.lit(last)) | (F.hour("create_time") < feed_hours))},
        )
        params = replace(PARAMS, as_of=day(n))
        matched.append(incremental.advance(now, params, path))
        columns = ["account_id", "credit_trans_trx_id", "txn_date", "amount_base", "is_matched"]
        assert rows_of(incremental.settled_rows(spark, path, params).select(columns)) == rows_of(matched_rows(now, params).select(columns))
        want = rows_of(settlement_report(now, params))
        assert rows_of(incremental.report_from_state(now, params, path)) == want
    assert want
    # The first days were complete at the first run and were matched once.
    assert min(matched[0]) == day(1) and min(matched[1]) >= day(5) and min(matched[2]) >= day(7)


def test_nothing_new_matches_nothing(spark, tmp_path):
    inputs, path = busy_books().inputs(spark), str(tmp_path / "states")
    assert incremental.advance(inputs, PARAMS, path)
    assert incremental.advance(inputs, PARAMS, path) == ()
    assert snapshots.versions(path) == [1]
    # One account leaves the scope: its days change, and its rows go.
    fewer = replace(inputs, merchants=inputs.merchants.where(f"account_id <> {OTHER}"))
    assert incremental.advance(fewer, PARAMS, path)
    assert incremental.settled_rows(spark, path, PARAMS).where(f"account_id = {OTHER}").count() == 0


def test_a_corrected_amount_changes_its_day_only(spark, tmp_path):
    inputs, path = busy_books().inputs(spark), str(tmp_path / "states")
    incremental.advance(inputs, PARAMS, path)
    on_day = F.to_date("txn_date") == F.lit(day(6))
    corrected = replace(inputs, ledger=inputs.ledger.withColumn("amt", F.when(on_day, F.col("amt") + 1).otherwise(F.col("amt")).cast("decimal(18,4)")))
    assert incremental.advance(corrected, PARAMS, path) == (day(6),)
    assert rows_of(incremental.report_from_state(corrected, PARAMS, path)) == rows_of(settlement_report(corrected, PARAMS))


def test_a_broken_run_and_a_second_writer_change_nothing(spark, tmp_path):
    inputs, path = busy_books().inputs(spark), str(tmp_path / "states")
    early = replace(inputs, ledger=inputs.ledger.where(F.col("txn_date") < F.lit(noon(9))))
    incremental.advance(early, PARAMS, path)
    before = rows_of(incremental.settled_rows(spark, path, PARAMS))

    def broken(*_):
        raise OSError("store went away")

    with pytest.raises(OSError):
        incremental.advance(inputs, PARAMS, path, create=broken)
    with pytest.raises(snapshots.Conflict):
        incremental.advance(inputs, PARAMS, path, create=lambda *_: False)
    assert rows_of(incremental.settled_rows(spark, path, PARAMS)) == before


def test_no_ledger_rows(spark, tmp_path):
    inputs, path = Books(spine_anchor=False).inputs(spark), str(tmp_path / "states")
    assert incremental.advance(inputs, PARAMS, path) == ()
    assert incremental.report_from_state(inputs, PARAMS, path).count() == 0


def test_the_job_stores_the_same_report_from_states(spark, tmp_path):
    inputs, states = busy_books().inputs(spark), str(tmp_path / "states")
    run(inputs, PARAMS, str(tmp_path / "anew"))
    _, matched = run_from_states(inputs, PARAMS, str(tmp_path / "from_states"), states)
    assert matched and run_from_states(inputs, PARAMS, str(tmp_path / "from_states"), states)[1] == ()
    assert rows_of(read_report(spark, str(tmp_path / "from_states"))) == rows_of(read_report(spark, str(tmp_path / "anew")))
