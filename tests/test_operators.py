"""Operators one by one, with the rules that are easy to get wrong."""

from dataclasses import replace
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import columns as c
from ledgerline.operators import amounts, daily, pick, recon
from ledgerline.operators.batches import close_batches
from ledgerline.operators.ledger import ledger_since, prune_accounts, signed_ledger
from ledgerline.plans import fixed_values as house
from ledgerline.plans.calendar import holiday_table, settlement_calendar
from ledgerline.plans import extracts, settlement
from ledgerline.plans.counts import InputCounts
from ledgerline.plans.job import run
from ledgerline.plans.params import Params
from ledgerline.plans.rates import (
    in_scope,
    merchant_dimension,
    one_row_per_account,
    rate_card,
    referral_in_scope,
    with_rates,
)
from ledgerline.sources import cuts, schemas
from ledgerline.sources.inputs import DECLARED, conform_inputs
from ledgerline.sources.sink import read_report
from testbed import binding
from tests.books import PARAMS, Books, day, noon


def values(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def one(spark, expression, **fields):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in fields.items()])
    return df.select(expression.alias("x")).first()["x"]


# --- scalar forms


@pytest.mark.parametrize(
    "raw, form, expected",
    [
        ("123", c.padded_reference, "000000000123"),
        ("1234567890123", c.padded_reference, "123456789012"),
        ("INV-T00000000000000001", c.invoice_reference, "T00000000000000001"),
        ("short", c.invoice_reference, "short"),
        ("A1_payment_payment", c.sequence_reference, "A1"),
    ],
)
def test_match_key_forms(spark, raw, form, expected):
    assert one(spark, form(F.col("raw")), raw=raw) == expected


@pytest.mark.parametrize(
    "kind, amt, expected",
    [
        ("Customer Purchase", "5.25", "5.25"),
        ("Emoney Reversal", "5.25", "-5.25"),
        ("Top Up", "5.25", "0"),
        (None, "5.25", "0"),
    ],
)
def test_signed_amount(spark, kind, amt, expected):
    got = one(spark, c.signed_amount(), txn_type=kind, amt=Decimal(amt))
    assert got == Decimal(expected)


def test_midnight_bounds_are_inclusive_to_the_microsecond(spark):
    rows = [datetime(2026, 1, 6, 0, 1, 0, us) for us in (0, 500000)]
    rows += [datetime(2026, 1, 6, 0, 1, 1, us) for us in (0, 500000)]
    df = spark.createDataFrame([(r,) for r in rows], "t timestamp_ntz")
    first = values(df, c.shortly_after_midnight("t", PARAMS.first_trx_until))
    weekday = values(df, c.shortly_after_midnight("t", PARAMS.weekday_opening_until))
    assert [x[0] for x in first] == [True, False, False, False]
    assert [x[0] for x in weekday] == [True, True, True, False]


def test_trailing_window_includes_its_first_day_and_has_no_end(spark):
    books = Books(spine_anchor=False)
    for when in (datetime(2025, 12, 28, 23, 59, 59), datetime(2025, 12, 29), datetime(2026, 3, 1)):
        books.row(when, 1)
    rows = ledger_since(books.inputs(spark).ledger, 16, PARAMS).collect()
    assert sorted(r.txn_date for r in rows) == [datetime(2025, 12, 29), datetime(2026, 3, 1)]


def test_null_keys_are_spread_and_never_meet_a_held_key(spark):
    df = spark.range(100).select(F.lit(None).cast("string").alias("k"), "id")
    sought = df.select(c.sought_key(F.col("k"), "id").alias("s")).distinct()
    assert sought.count() == 100
    assert sought.where("s like 'k%'").count() == 0
    assert one(spark, c.sought_key(F.col("k"), "id"), k="a", id=1) == one(spark, c.held_key(F.col("k")), k="a")


# --- conform


def test_conform_casts_text_and_turns_bad_values_into_nulls(spark):
    df = spark.createDataFrame(
        [("1", "x", "12.5", "2026-01-02 03:04:05"), ("b", "y", "n/a", "never")],
        "ACCOUNT_ID string, BAL string, BALANCE string, created_date string",
    ).withColumn("PROCESSED_DTTM", F.col("created_date"))
    got = schemas.conform(df, schemas.OPS_BALANCES)
    assert got.schema == schemas.OPS_BALANCES
    assert values(got, "account_id", "balance", "created_date") == [
        (1, Decimal("12.5"), datetime(2026, 1, 2, 3, 4, 5)),
        (None, None, None),
    ]


def test_conform_renames_and_insists_on_every_column(spark):
    df = spark.createDataFrame([("7", noon(6))], "id string, trx_date timestamp_ntz")
    assert values(schemas.conform(df, schemas.TRANSACTIONS, {"trx_id": "ID"}), "trx_id") == [("7",)]
    with pytest.raises(ValueError, match="trx_id"):
        schemas.conform(df, schemas.TRANSACTIONS)


def test_digits_that_do_not_fit_fail_the_run(spark):
    for kind, value in (("string", "0.00725"), ("decimal(9,6)", Decimal("0.00725")), ("double", 0.00725)):
        df = spark.createDataFrame([(0, "account", "1", value)], f"place bigint, kind string, key string, rate {kind}")
        with pytest.raises(Exception, match="more than 4 decimals"):
            schemas.conform(df, schemas.RATES).collect()
    fine = spark.createDataFrame([(0, "account", "1", 0.1 + 0.2)], "place bigint, kind string, key string, rate double")
    assert values(schemas.conform(fine, schemas.RATES), "rate") == [(Decimal("0.3000"),)]


def test_zoned_timestamps_become_local_times_of_the_business(spark):
    df = spark.sql("select '1' as trx_id, timestamp_ltz '2026-01-05 20:00:00 UTC' as trx_date")
    assert values(schemas.conform(df, schemas.TRANSACTIONS, zone="Asia/Jakarta"), "trx_date") == [(datetime(2026, 1, 6, 3),)]


def test_text_ids_stay_apart(spark):
    books = Books()
    for trx in ("TX-1", "TX-2", "007", "7"):
        books.row(6, 100, trx=trx)
    totals = settlement.daily(books.inputs(spark), PARAMS)
    assert values(totals.where("account_id = 100"), "amount_base") == [(Decimal(400),)]


def test_holidays_must_be_given_and_reach_the_run(spark):
    inputs = Books().inputs(spark)
    tables = {n: getattr(inputs, n) for n in DECLARED}
    feeds = {f.name: spark.createDataFrame([], f"{f.key} string, {f.timestamp} timestamp_ntz") for f in recon.FEEDS}
    with pytest.raises(ValueError, match="public_holidays"):
        conform_inputs(spark, tables, feeds, PARAMS)
    tables["public_holidays"] = spark.createDataFrame([(date(2025, 12, 25),)], schemas.HOLIDAYS)
    with pytest.raises(ValueError, match="holiday_coverage"):
        conform_inputs(spark, tables, feeds, PARAMS)
    known = [(date(2025, 1, 1), date(2025, 12, 31)), (date(2025, 12, 1), date(2026, 1, 10)), (date(2026, 1, 11), None)]
    for more, missing in (([], "2026-01-11"), ([(date(2026, 1, 12), date(2026, 3, 31))], "2026-01-11"), ([(date(2026, 1, 11), date(2026, 3, 31))], None)):
        tables["holiday_coverage"] = spark.createDataFrame(known + more, schemas.HOLIDAY_COVERAGE)
        bound = conform_inputs(spark, tables, feeds, PARAMS)
        report = settlement.settlement_report(bound, PARAMS)
        if missing:
            with pytest.raises(Exception, match=f"holidays are not known for {missing}"):
                report.collect()
        else:
            report.collect()
    june = replace(PARAMS, as_of=date(2026, 6, 10))
    late = replace(bound, ledger=Books(spine_anchor=False).row(datetime(2026, 6, 8, 12), 100).inputs(spark).ledger)
    with pytest.raises(Exception, match="holidays are not known for 2026-0[4-6]"):
        settlement.settlement_report(late, june).collect()


def test_extracts_are_counted_by_the_jobs_of_the_run(spark, tmp_path):
    inputs, params = binding.inputs(spark, "/root/testdata/sf0.001"), binding.PARAMS
    context, jobs = spark.sparkContext, []
    for name, counts in (("plain", None), ("counted", InputCounts())):
        context.setJobGroup(name, name)
        run(inputs, params, str(tmp_path / name), counts)
        jobs.append(len(context.statusTracker().getJobIdsForGroup(name)))
    context.setLocalProperty("spark.jobGroup.id", None)
    exact = {r.extract: r.n_rows for r in extracts.extract_counts(inputs, params).collect()}
    assert counts.read(lambda: pytest.fail("all were observed")) == exact and min(exact.values()) > 0
    stored = [sorted(map(tuple, read_report(spark, str(tmp_path / n)).collect())) for n in ("plain", "counted")]
    assert stored[0] == stored[1]
    # The semi-join may cost a job for a broadcast or a shuffle of its own, counting itself none.
    assert jobs[1] <= jobs[0] + 3


def test_what_cannot_be_read_is_told_and_is_what_conform_loses(spark):
    rows = [("x", 1.5, "2026-01-05", "7"), ("x", float("nan"), "soon", "7.5"), (None, None, None, None), (" 12 ", 0.0, "", "1e3"), ("1", float("inf"), "2026-01-05 10:00:00", "-")]
    df = spark.createDataFrame(rows, "AMT string, rate double, at string, own string")
    schema = schemas._schema(amt=schemas.AMOUNT, rate=schemas.MONEY, at=schemas.TIME, id=schemas.LONG, own=schemas.TEXT)
    rename = {"id": "own"}
    told = {(r.column_name, r.value): r.n_rows for r in schemas.unreadable(df, schema, rename).collect()}
    assert told == {("AMT", "x"): 2} | dict.fromkeys([("rate", "NaN"), ("rate", "Infinity"), ("at", "soon"), ("at", ""), ("own", "-")], 1)
    names = {"amt": "AMT", "rate": "rate", "at": "at", "id": "own"}
    read = schemas.conform(df, schema, rename).collect()
    lost = sum(r[c] is None and given[n] is not None for r, given in zip(read, df.collect(), strict=True) for c, n in names.items())
    assert lost == sum(told.values())


def test_the_first_rule_holds_under_every_spelling_of_an_account(spark):
    merchants = spark.createDataFrame([(7, None, "t", 1), (8, "R", "t", 1), (9, None, "t", 1)], schemas.MERCHANTS)
    rules = [(1, "account", "007", Decimal("0.01")), (2, "account", "7", Decimal("0.02")), (3, "account", "x1", Decimal("0.03")),
             (4, "referral", "R", Decimal("0.04")), (5, "account", "9" * 40, Decimal("0.05")), (6, "account", None, Decimal("0.06"))]
    got = with_rates(merchants, spark.createDataFrame(rules, schemas.RATES), PARAMS)
    assert sorted(values(got, "account_id", "mdr_rate")) == [(7, Decimal("0.01")), (8, Decimal("0.04")), (9, PARAMS.default_rate)]


def test_building_the_report_starts_no_job_but_the_cut(spark):
    """Bounds, calendar and holiday coverage are part of the plan."""
    inputs = Books().row(6, 100000).balance(7, 100000).inputs(spark)
    context = spark.sparkContext
    context.setJobGroup("cut", "the cut alone")
    cuts.cut(settlement.daily(inputs, PARAMS))
    context.setJobGroup("whole", "the whole report")
    settlement.settlement_report(inputs, PARAMS)
    jobs = [len(context.statusTracker().getJobIdsForGroup(g)) for g in ("cut", "whole")]
    context.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1] > 0


def test_a_closed_run_longer_than_the_look_back_fails(spark):
    closed = spark.sql("select explode(sequence(date '2025-11-01', date '2026-01-20')) as holiday_date")
    with pytest.raises(Exception, match="no settlement day in 31 days"):
        settlement_calendar(closed, day(5), day(14)).collect()


def test_first_of_repeated_rules_wins(spark):
    rules = [(2, "referral", "R1", Decimal("0.02")), (1, "referral", "R1", Decimal("0.01")), (3, "account", "1", Decimal("0.03")), (0, "account", "1", Decimal("0.04"))]
    rates = spark.createDataFrame(rules, schemas.RATES)
    got = with_rates(merchants(spark, (1, "R1", "t", 1), (2, "R1", "t", 1)), rates, PARAMS)
    assert {r.account_id: r.mdr_rate for r in got.collect()} == {1: Decimal("0.04"), 2: Decimal("0.01")}


def test_two_rows_of_one_source_fail(spark):
    spine = spark.createDataFrame([(1, day(6))], "account_id bigint, balance_date date")
    twice = spark.createDataFrame([(1, day(6), 1), (1, day(6), 2)], "account_id bigint, balance_date date, x int")
    with pytest.raises(Exception, match="two rows of one source"):
        daily.lay_on_spine(spine, twice).collect()


# --- merchants, rates, exclusions


def merchants(spark, *rows):
    return spark.createDataFrame(rows, "account_id bigint, referral_code_acquisition string, vendor_type string, vendor_id bigint")


def test_vendor_null_is_dropped_and_referral_null_is_kept(spark):
    df = merchants(
        spark,
        (1, "A", "t", 5),
        (2, "A", "t", None),
        (3, "A", "t", house.EXCLUDED_VENDOR),
        (house.EXCLUDED_ACCOUNTS[0], "A", "t", 5),
        (4, None, "t", 5),
        (5, house.EXCLUDED_REFERRALS[0], "t", 5),
    )
    kept = df.where(in_scope(PARAMS))
    assert {r.account_id for r in kept.collect()} == {1, 4, 5}
    assert {r.account_id for r in kept.where(referral_in_scope(PARAMS)).collect()} == {1, 4}


def test_house_rates_first_rule_wins(spark):
    zero_rated = house.ZERO_RATE_ACCOUNTS[0]
    df = merchants(
        spark,
        (zero_rated, "98ENTP062", "t", 1),
        (128013, "98ENTP062", "t", 1),
        (1, "98ENTP062", "t", 1),
        (2, "99ENTP003", "t", 1),
        (3, None, "t", 1),
        (4, "unknown", "t", 1),
    )
    got = {r.account_id: r.mdr_rate for r in with_rates(df, rate_card(spark), PARAMS).collect()}
    expected = {zero_rated: "0", 128013: "0.015", 1: "0.02", 2: "0.01", 3: "0.007", 4: "0.007"}
    assert got == {k: Decimal(v) for k, v in expected.items()}


def test_house_rules_are_complete():
    assert len(set(house.ZERO_RATE_ACCOUNTS)) == 41
    assert len(house.REFERRAL_RATES) == 10
    assert len(house.EXCLUDED_REFERRALS) == 6
    assert len(house.HOLIDAYS) == 14


def test_duplicate_merchant_fails_the_job(spark):
    df = merchants(spark, (1, "A", "t", 5), (1, "B", "t", 5))
    with pytest.raises(Exception, match="merchant account occurs twice: 1"):
        one_row_per_account(df).collect()


def test_accounts_out_of_scope_are_pruned(spark):
    from ledgerline.plans.settlement import daily as daily_plan

    books = Books()
    books.merchants += [(300, "99ENTP001", "t", 1), (400, "R1", "t", None)]
    for account in (100, 300, 400, 500):
        books.row(6, account, account=account)
    inputs = books.inputs(spark)
    kept = prune_accounts(inputs.ledger, inputs.merchants, PARAMS)
    assert {r.account_id for r in kept.collect()} == {100, 200}
    assert sorted(values(daily_plan(inputs, PARAMS), "account_id", "amount_base")) == [(100, Decimal(100)), (200, Decimal(0))]


# --- reconciliation


RAW_KEYS = {
    "linkaja_msme": "ISS", "linkaja_mcd": "APP_payment", "linkaja_expansion": "ISS", "bni": "77",
    "shopeepay": "000000000077", "mandiri": "000000000077", "ovo": "INV-123456789012345678",
    "kredivo": "000000000077", "indodana": "000000000077", "bca": "000000000077", "btn": 77,
    "ottopay": "000000000077", "ottopay_dashboard": "000000000077",
}
REPORTED = {"linkaja_mcd": "APP", "bni": "000000000077", "ovo": "123456789012345678", "btn": "77"}


def recon_keys(spark, present, feed_day=6, trx="9"):
    """Keys of all feeds and the approval codes, of which only those in ``present`` hold the transaction."""
    feeds = {}
    for spec in recon.FEEDS:
        kind = "bigint" if spec.name == "btn" else "string"
        rows = [(RAW_KEYS[spec.name], noon(feed_day))] * 2 if spec.name in present else []
        feeds[spec.name] = spark.createDataFrame(rows, f"{spec.key} {kind}, {spec.timestamp} timestamp_ntz")
    transactions = spark.createDataFrame([(trx, noon(6))] * 2, schemas.TRANSACTIONS)
    refs = [("9", "APP", noon(6)), ("9", "APP", noon(6)), ("9", "AAA", noon(6))]
    refs = spark.createDataFrame(refs, schemas.CARD_REFS)
    codes = recon.approval_codes(transactions, refs, PARAMS)
    return recon.keys_by_route(feeds, transactions, refs, PARAMS), codes


def recon_row(spark, issuer_ref="ISS"):
    row = (100, "m", "Shop", noon(6), "X", "Customer Purchase", Decimal(1), "9", issuer_ref, "000000000077", None, None)
    return signed_ledger(spark.createDataFrame([row], schemas.LEDGER), PARAMS)


def flagged(rows, keys):
    """One row per transaction, as the matching is used: a row comes out once for each reference that matched."""
    return pick.deduplicate_transactions(recon.flag_matches(rows, keys))


@pytest.mark.parametrize("feed", [f.name for f in recon.FEEDS])
def test_every_feed_matches_on_its_own(spark, feed):
    row = recon_row(spark, "123456789012345678" if feed == "ovo" else "ISS")
    keys, codes = recon_keys(spark, {feed})
    assert values(flagged(row, keys), "is_matched") == [(True,)]
    got = values(recon.with_match_key(row, keys, codes), "mcd_approval_code", "key_join_issuer")
    # The approval code the feed holds, else the smallest; duplicate keys and codes add no rows.
    code = "APP" if feed == "linkaja_mcd" else "AAA"
    assert got == [(code, REPORTED.get(feed, RAW_KEYS[feed]))]


@pytest.mark.parametrize(
    "without, expected",
    [
        ((), "ISS"),
        (("linkaja_msme",), "APP"),
        (("linkaja_msme", "linkaja_mcd"), "ISS"),
        (("linkaja_msme", "linkaja_mcd", "linkaja_expansion"), "000000000077"),
    ],
)
def test_key_comes_from_the_first_feed_in_order(spark, without, expected):
    keys, codes = recon_keys(spark, {f.name for f in recon.FEEDS} - set(without))
    got = recon.with_match_key(recon_row(spark), keys, codes)
    assert values(got, "key_join_issuer") == [(expected,)]


def test_another_date_or_a_null_key_does_not_match(spark):
    everywhere = {f.name for f in recon.FEEDS}
    row = recon_row(spark)
    next_day, _ = recon_keys(spark, everywhere, 7)
    assert values(flagged(row, next_day), "is_matched") == [(False,)]
    bare = row.withColumns(
        {n: F.lit(None).cast("string") for n in ("issuer_txn_ref", "txn_extref")}
    ).withColumn("credit_trans_trx_id", F.lit(None).cast("string"))
    same_day, codes = recon_keys(spark, everywhere)
    assert values(flagged(bare, same_day), "is_matched") == [(False,)]
    got = recon.with_match_key(bare, same_day, codes)
    assert values(got, "key_join_issuer", "mcd_approval_code") == [(None, None)]


def test_card_route_needs_a_known_transaction(spark):
    keys, _ = recon_keys(spark, {"linkaja_mcd"}, trx="8")
    assert values(flagged(recon_row(spark), keys), "is_matched") == [(False,)]


def test_match_split(spark):
    df = spark.createDataFrame(
        [(Decimal(100), True), (Decimal(50), False), (Decimal(0), False)],
        "amount_base decimal(18,4), is_matched boolean",
    ).withColumn("mdr_rate", F.lit(Decimal("0.0100")))
    got = recon.split_by_match(df)
    columns = ("amt_matched", "amt_unmatched", "mdr_unmatched", "net_unmatched", "traffic_unmatched")
    assert values(got, *columns) == [(100, 0, 0, 0, 0), (0, 50, Decimal("0.5"), Decimal("49.5"), 1), (0, 0, 0, 0, 1)]


# --- one row per key


def test_deduplication_prefers_the_matched_row_and_treats_null_ids_as_equal(spark):
    df = spark.createDataFrame(
        [
            (1, 5, noon(6), Decimal(10), "a", False),
            (1, 5, noon(7), Decimal(20), "a", True),
            (1, None, noon(6), Decimal(30), "a", False),
            (1, None, noon(8), Decimal(40), "a", False),
            (2, None, noon(8), Decimal(50), "a", False),
        ],
        """account_id bigint, credit_trans_trx_id string, txn_date timestamp_ntz,
           amount_base decimal(18,4), merch_name string, is_matched boolean""",
    )
    got = sorted(r.amount_base for r in pick.deduplicate_transactions(df).collect())
    assert got == [20, 30, 50]


def test_bank_without_a_name_sorts_last(spark):
    rows = [(1, None, "n", "1", "c"), (1, "B", "n", "2", "c"), (1, "A", "n", "3", "c"), (2, None, "n", "4", "c")]
    got = pick.preferred_bank(spark.createDataFrame(rows, schemas.BANK_ACCOUNTS))
    assert sorted(values(got, "account_id", "bank_account_number")) == [(1, "3"), (2, "4")]


def test_earliest_ops_balance_with_unknown_time_last(spark):
    rows = [
        (1, Decimal(1), noon(6), None),
        (1, Decimal(2), noon(6), noon(8)),
        (1, Decimal(3), noon(6), noon(7)),
        (2, None, noon(6), noon(7)),
    ]
    df = spark.createDataFrame(rows, schemas.OPS_BALANCES)
    assert sorted(values(pick.earliest_ops_balance(df), "account_id", "balance"), key=str) == [(1, 3), (2, None)]
    assert sorted(values(daily.ops_by_balance_date(df), "account_id", "balance_date", "balance_raw")) == [
        (1, day(5), 3), (2, day(5), 0),
    ]


# --- ledger amounts


def opening_books():
    books = Books(spine_anchor=False)
    books.row(datetime(2026, 1, 6, 0, 0, 10), 100).row(datetime(2026, 1, 6, 0, 0, 10), 50)
    books.row(datetime(2026, 1, 6, 0, 0, 40), 7).row(datetime(2026, 1, 6, 0, 1, 0, 500000), 5)
    books.row(datetime(2026, 1, 10, 0, 0, 5), 30)  # a Saturday
    books.row(datetime(2025, 12, 16, 0, 0, 5), 11)  # a Tuesday, 29 days back
    books.row(7, 60, issuer="SNAP PROD Settlement").row(7, 9, kind="Emoney Reversal", issuer="YTI_VOUCHER")
    return books


def test_first_transaction_of_day(spark):
    inputs = opening_books().inputs(spark)
    dim = merchant_dimension(inputs.merchants, inputs.rates, PARAMS)
    got = amounts.first_transactions(inputs.ledger, dim, PARAMS)
    assert sorted(values(got, "txn_date", "amount", "mdr_amount", "nett_amount")) == [
        (datetime(2026, 1, 6, 0, 0, 10), 150, 2, 149),  # 1.5 and 148.5: half away from zero
        (datetime(2026, 1, 10, 0, 0, 5), 30, 0, 30),
    ]


def test_weekday_opening_reaches_30_days_back_and_skips_weekends(spark):
    got = amounts.weekday_opening_totals(opening_books().inputs(spark).ledger, PARAMS)
    assert sorted(values(got, "trx_date", "amount")) == [(date(2025, 12, 16), 11), (day(6), 162)]


def test_vouchers_are_booked_on_the_next_day(spark):
    got = amounts.voucher_totals(opening_books().inputs(spark).ledger, PARAMS)
    assert values(got, "balance_date", "amount_voucher") == [(day(8), 51)]


def test_one_scan_measures_equal_the_separate_ones(spark):
    ledger = opening_books().inputs(spark).ledger
    got = amounts.day_measures(ledger, PARAMS)
    measured = {r.balance_date: (r.amount_voucher, r.trx_00_amt, r.first_trx) for r in got.collect()}
    assert measured == {
        date(2025, 12, 16): (None, 11, None),
        day(5): (None, None, 150),
        day(6): (None, 162, None),
        day(8): (51, None, None),
        day(9): (None, None, 30),
    }


# --- calendar, spine, rates over time


def test_calendar(spark):
    holidays = spark.createDataFrame([(day(7),), (day(7),)], schemas.HOLIDAYS)
    got = settlement_calendar(holiday_table(spark, holidays, extra=()), day(5), day(12))
    assert {r.day.day: (r.is_settlement_day, r.next_is_settlement_day, r.last_working_day) for r in got.collect()} == {
        5: (True, True, date(2026, 1, 2)),
        6: (True, False, day(5)),
        7: (False, True, day(6)),
        8: (True, True, day(6)),
        9: (True, False, day(8)),
        10: (False, False, day(9)),
        11: (False, True, day(9)),
        12: (True, True, day(9)),
    }


def test_name_is_the_earliest_known_and_the_spine_takes_the_last_active_day(spark):
    books = Books(spine_anchor=False)
    books.row(datetime(2026, 1, 6, 9), 1, name=None).row(datetime(2026, 1, 6, 10), 1, name="Old")
    books.row(datetime(2026, 1, 6, 11), 1, name="New").row(7, 1, name="Newer")
    rows = signed_ledger(books.inputs(spark).ledger, PARAMS).withColumn("is_matched", F.lit(True))
    rates = spark.createDataFrame([(100, Decimal("0.01"))], "account_id bigint, mdr_rate decimal(5,4)")
    totals = daily.daily_totals(rows, rates, PARAMS)
    assert sorted(values(totals, "balance_date", "merch_name")) == [(day(6), "Old"), (day(7), "Newer")]
    spine = daily.spine_days(totals, day(5), day(14))
    got = sorted(values(spine, "balance_date", "merch_name", "amount_base"))
    assert [d for d, _, _ in got] == [day(n) for n in range(5, 15)]
    assert {name for _, name, _ in got} == {"Newer"}

    def bounds(totals, *until):
        return tuple(spark.range(1).select(*daily.spine_bounds(totals, PARAMS, *until)).first())

    assert bounds(totals) == (day(6), day(14))
    assert bounds(totals, day(9)) == (day(6), day(9)) and bounds(totals, day(2)) == (day(6), day(6))
    assert bounds(totals.limit(0)) == (day(14), day(21))


def test_a_nameless_last_day_falls_back_to_the_name_of_each_day(spark):
    books = Books(spine_anchor=False).row(6, 1, name="Old").row(7, 1, name=None)
    rows = signed_ledger(books.inputs(spark).ledger, PARAMS).withColumn("is_matched", F.lit(True))
    rates = spark.createDataFrame([(100, Decimal("0.01"))], "account_id bigint, mdr_rate decimal(5,4)")
    spine = daily.spine_days(daily.daily_totals(rows, rates, PARAMS), day(6), day(14))
    names = dict(values(spine, "balance_date", "merch_name"))
    assert names[day(6)] == "Old" and names[day(7)] is None and names[day(8)] is None


def test_spine_keeps_its_rows_and_takes_only_matching_sources(spark):
    spine = spark.createDataFrame([(1, day(5)), (1, day(6))], "account_id bigint, balance_date date")
    a = spark.createDataFrame([(1, day(5), 10), (2, day(5), 20)], "account_id bigint, balance_date date, a int")
    b = spark.createDataFrame([(1, day(6), None), (1, day(9), 7)], "account_id bigint, balance_date date, b int")
    got = daily.lay_on_spine(spine, a, b)
    assert sorted(values(got, "balance_date", "a", "b")) == [(day(5), 10, None), (day(6), None, None)]


def test_rate_fill(spark):
    rows = [(1, day(n), r) for n, r in ((5, None), (6, Decimal("0.02")), (7, None), (8, Decimal("0.03")), (9, None))]
    rows += [(2, day(5), None)]
    df = spark.createDataFrame(rows, "account_id bigint, balance_date date, mdr_rate decimal(5,4)")
    got = df.select("account_id", "balance_date", daily.filled_rate(PARAMS).alias("r"))
    rates = [str(r.r) for r in got.orderBy("account_id", "balance_date").collect()]
    assert rates == ["0.0200", "0.0200", "0.0200", "0.0300", "0.0300", "0.0070"]


# --- batches as an operator of its own


def test_close_batches_on_other_columns(spark):
    rows = [  # (key, order, boundary, gate, extra)
        ("a", 1, False, 5, 1), ("a", 2, True, -5, 1),  # cancels: does not close
        ("a", 3, False, 0, 1), ("a", 4, True, 7, 1),  # closes; the extra runs on from row 1
        ("a", 5, True, 0, 1), ("a", 6, True, 2, 1),
        ("b", 1, True, 0, 1),
    ]
    df = spark.createDataFrame(rows, "k string, o int, edge boolean, g int, x bigint")
    df = df.withColumn("g", F.col("g").cast("decimal(20,4)"))
    got = close_batches(df, key=["k"], order="o", boundary=F.col("edge"), gate=["g"], measures=["x"])
    closed = got.where("closes_batch").orderBy("k", "o")
    assert values(closed, "k", "o", "batch_g", "batch_x") == [("a", 4, 7, 4), ("a", 6, 2, 2)]
    assert sorted(values(got.where("opens_batch"), "k", "o")) == [("a", 1), ("a", 6)]


def test_params_are_frozen():
    params = Params(as_of=day(14))
    assert params.report_from == date(2025, 12, 31)
    assert params.first_trx_until == timedelta(minutes=1)
    with pytest.raises(AttributeError):
        params.as_of = day(15)
