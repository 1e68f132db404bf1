"""Every operator as a query on the benchmark tables: (spark, sf_dir) -> DataFrame."""

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import or_zero
from ledgerline.operators import amounts, batches, daily, ledger, pick, recon, report
from ledgerline.plans import extracts, incremental, settlement
from ledgerline.plans.calendar import LOOK_BACK_DAYS, holiday_table, settlement_calendar, unknown_days
from ledgerline.plans.rates import merchant_dimension, referral_in_scope
from ledgerline.sources import sink
from ledgerline.sources.cuts import cut, shared_folder
from ledgerline.sources.inputs import unreadable_values as unreadable_in
from testbed import binding as b
from testbed.binding import PARAMS

Query = Callable[[SparkSession, str], DataFrame]


def _doubles(*names: str) -> list[Column]:
    return [F.col(n).cast("double").alias(n) for n in names]


def _signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.signed_ledger(b.ledger(spark, sf_dir), PARAMS)


def _scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merchant_dimension(b.merchants(spark, sf_dir), b.repeated_rules(spark), PARAMS)


def _micros_of_day() -> Column:
    seconds = F.hour("txn_date") * 3600 + F.minute("txn_date") * 60 + F.expr("extract(second from txn_date)")
    return (seconds * 1000000).cast("bigint").alias("micros_of_day")


def ledger_window(spark, sf_dir):
    rows = ledger.ledger_since(b.ledger(spark, sf_dir), PARAMS.ledger_days, PARAMS)
    return rows.select(
        "account_id", "credit_trans_trx_id", F.to_date("txn_date").alias("trx_date"), "txn_type", *_doubles("amt")
    )


def signed_amount_daily(spark, sf_dir):
    return amounts.signed_daily(b.ledger(spark, sf_dir), PARAMS).select(
        "account_id", "trx_date", *_doubles("amount_base")
    )


def merchant_rates(spark, sf_dir):
    return _scope(spark, sf_dir).select(
        "account_id", "referral_code_acquisition", "vendor_id", *_doubles("mdr_rate")
    )


def referral_filter_null_safe(spark, sf_dir):
    """Account sums first, then merchants: the ledger itself is never joined."""
    per_account = _signed(spark, sf_dir).groupBy("account_id").agg(
        F.count("*").alias("n"), F.sum("amount_base").alias("amount")
    )
    return (
        ledger.with_merchants(per_account, _scope(spark, sf_dir).where(referral_in_scope(PARAMS)))
        .groupBy("referral_code_acquisition")
        .agg(F.sum("n").alias("n_rows"), F.sum("amount").cast("double").alias("amount_base"))
    )


def dedup_transactions(spark, sf_dir):
    inputs = b.inputs(spark, sf_dir)
    rows = ledger.signed_ledger(inputs.ledger, PARAMS)
    rows = rows.join(_scope(spark, sf_dir).select("account_id"), "account_id", "left_semi")
    flagged = recon.flag_matches(rows, settlement.match_keys(inputs, PARAMS))
    return pick.deduplicate_transactions(flagged).select(
        "account_id", "credit_trans_trx_id", "trx_date", "merch_name", "is_matched", *_doubles("amount_base")
    )


def dedup_text_ids(spark, sf_dir):
    """Ids that are no plain numbers, or differ in leading zeros only, are different transactions."""
    number = F.col("txn_ref").cast("bigint")
    group = F.floor(number / 6).cast("string")
    by_kind = F.when(number % 3 == 0, F.concat(F.lit("TX-"), group)).when(number % 3 == 1, F.lpad(group, 9, "0")).otherwise(group)
    rows = _signed(spark, sf_dir).withColumn(
        "credit_trans_trx_id", F.when(F.col("credit_trans_trx_id").isNotNull(), by_kind)
    )
    return pick.deduplicate_transactions(rows.withColumn("is_matched", F.lit(False))).select(
        "account_id", "credit_trans_trx_id", "trx_date", *_doubles("amount_base")
    )


def feed_keys(spark, sf_dir):
    feeds = b.feeds(spark, sf_dir)
    routes = [
        recon.route_keys(feeds, route, PARAMS).select(F.lit(route).alias("route"), "*")
        for route in (recon.ISSUER_REF, recon.APPROVAL, recon.EXTREF)
    ]
    united = reduce(DataFrame.unionByName, routes)
    return united.withColumn("priority", F.col("priority").cast("bigint")).distinct()


def _found_by(spark, sf_dir, route: str) -> DataFrame:
    keys = settlement.match_keys(b.inputs(spark, sf_dir), PARAMS)[route]
    best, shown = recon.best_keys(keys), F.col("hit.reported_key")
    rows = recon.look_up(_signed(spark, sf_dir), best, recon.ledger_side(route), shown, "key_found")
    return rows.where("key_found is not null").select(
        "account_id", "credit_trans_trx_id", "trx_date", "key_found"
    )


def recon_issuer_ref_match(spark, sf_dir):
    return _found_by(spark, sf_dir, recon.ISSUER_REF)


def recon_extref_match(spark, sf_dir):
    return _found_by(spark, sf_dir, recon.EXTREF)


def recon_approval_match(spark, sf_dir):
    return _found_by(spark, sf_dir, recon.APPROVAL)


def card_approval_keys(spark, sf_dir):
    keys = settlement.match_keys(b.inputs(spark, sf_dir), PARAMS)[recon.APPROVAL]
    return keys.select(F.col("match_key").alias("trx_id"), "feed_date", "reported_key").distinct()


def card_keys_by_filter(spark, sf_dir):
    """The same keys, references and transactions filtered before their shuffles."""
    params = replace(PARAMS, reference_filter_bits=2**23)
    keys = settlement.match_keys(b.inputs(spark, sf_dir), params)[recon.APPROVAL]
    return keys.select(F.col("match_key").alias("trx_id"), "feed_date", "reported_key").distinct()


def recon_key_first_match(spark, sf_dir):
    return extracts.base_rows(b.inputs(spark, sf_dir), PARAMS).select(
        "account_id", "credit_trans_trx_id", "trx_date", "mcd_approval_code", "key_join_issuer"
    )


def base_projection(spark, sf_dir):
    money = ("amt", "amount_base", "mdr_rate")
    plain = [c for c in extracts.BASE_COLUMNS if c not in money and c != "txn_date"]
    base = extracts.base_rows(b.inputs(spark, sf_dir), PARAMS)
    return base.select(*plain, _micros_of_day(), *_doubles(*money))


def match_split(spark, sf_dir):
    """Account sums by flag first; rate and split are then applied to the sums."""
    rows = settlement.matched_rows(b.inputs(spark, sf_dir), PARAMS)
    sums = rows.groupBy("account_id", "is_matched").agg(
        F.count("*").alias("n"), F.sum("amount_base").cast("decimal(20,4)").alias("amount_base")
    )
    merchants = _scope(spark, sf_dir).where(referral_in_scope(PARAMS))
    measures = ["amt_matched", "amt_unmatched", "mdr_unmatched", "net_unmatched"]
    return (
        recon.split_by_match(ledger.with_merchants(sums, merchants))
        .groupBy("is_matched")
        .agg(
            F.sum("n").alias("n_rows"),
            *[F.sum(c).cast("double").alias(c) for c in measures],
            F.sum(F.col("traffic_unmatched") * F.col("n")).alias("traffic_unmatched"),
        )
    )


def voucher_next_day(spark, sf_dir):
    vouchers = amounts.voucher_totals(b.ledger(spark, sf_dir), PARAMS)
    totals = settlement.daily(b.inputs(spark, sf_dir), PARAMS)
    return totals.join(vouchers, ["account_id", "balance_date"], "left").select(
        "account_id", "balance_date", or_zero(F.col("amount_voucher")).cast("double").alias("amount_voucher")
    )


def voucher_rows(spark, sf_dir):
    rows = amounts.voucher_rows(b.ledger(spark, sf_dir), _scope(spark, sf_dir), PARAMS)
    return rows.select(
        "account_id", "merchant_id", "issuer", "trx_date", _micros_of_day(), *_doubles("amount_base")
    )


def first_transaction_of_day(spark, sf_dir):
    rows = amounts.first_transactions(b.ledger(spark, sf_dir), _scope(spark, sf_dir), PARAMS)
    return rows.select(
        "account_id", F.to_date("txn_date").alias("trx_date"), _micros_of_day(),
        *_doubles("amount", "mdr_amount", "nett_amount"),
    )


def midnight_weekday_amount(spark, sf_dir):
    totals = amounts.weekday_opening_totals(b.ledger(spark, sf_dir), PARAMS)
    return ledger.with_merchants(totals, _scope(spark, sf_dir)).select(
        "account_id", "trx_date", *_doubles("amount")
    )


def day_measures(spark, sf_dir):
    return amounts.day_measures(b.ledger(spark, sf_dir), PARAMS).select(
        "account_id", "balance_date", *_doubles("amount_voucher", "trx_00_amt", "first_trx")
    )


def _days(spark, sf_dir):
    return settlement.days_of(b.inputs(spark, sf_dir), PARAMS)


def holiday_carry(spark, sf_dir):
    return _days(spark, sf_dir).where("holiday_carry_amt <> 0").select(
        "account_id", "balance_date", "last_working_day", *_doubles("holiday_carry_amt")
    )


def calendar_last_working_day(spark, sf_dir):
    """The calendar over the days the events span, up to the end of the run's calendar."""
    first, last = b.table(spark, sf_dir, "events").agg(F.to_date(F.min("ts")), F.to_date(F.max("ts"))).first()
    last = min(last, PARAMS.as_of + timedelta(days=PARAMS.spine_tail_days))
    return settlement_calendar(holiday_table(spark, b.public_holidays(spark)), first, last)


def holiday_coverage_gaps(spark, sf_dir):
    """Days that the run's calendar touches but no event type's span of events holds."""
    days = F.to_date("ts")
    spans = b.table(spark, sf_dir, "events").groupBy("event_type").agg(F.min(days).alias("known_from"), F.max(days).alias("known_to"))
    bounds = spans.agg(F.date_sub(F.min("known_from"), LOOK_BACK_DAYS).alias("day")).scalar()
    return unknown_days(spans, bounds, PARAMS.as_of + timedelta(days=PARAMS.spine_tail_days + 1))


def orders_by_settlement_day_of_2026(spark, sf_dir):
    """Orders moved to the same day of 2026, by the house's own holidays."""
    day = F.date_add(F.lit(date(2026, 1, 1)), F.dayofyear("o_orderdate") - 1)
    orders = b.table(spark, sf_dir, "orders").groupBy(day.alias("day")).agg(F.count("*").alias("n_orders"))
    calendar = settlement_calendar(holiday_table(spark), date(2026, 1, 1), date(2027, 1, 1))
    return orders.join(F.broadcast(calendar), "day").select("day", "n_orders", "is_settlement_day", "last_working_day")


def drop_helper_columns(spark, sf_dir):
    """Helper columns go by name, in any case; a name that isn't there is ignored."""
    helpers = ("MERCHANT_ID", "merch_name", "issuer_txn_ref", "txn_extref", "txn_date", "amt", "terminal_id", "no_such_column")
    rows = _signed(spark, sf_dir).drop(*helpers)
    return rows.withColumn("amount_base", F.col("amount_base").cast("double"))


def daily_matched_unmatched(spark, sf_dir):
    return settlement.daily(b.inputs(spark, sf_dir), PARAMS).select(
        "account_id", "balance_date", "merch_name", "unmatched_traffic",
        *_doubles("mdr_rate", "amount_base", "unmatched_amount", "unmatched_mdr", "unmatched_net"),
    )


def account_day_spine(spark, sf_dir):
    totals = cut(settlement.daily(b.inputs(spark, sf_dir), PARAMS))
    first, last = daily.spine_bounds(totals, PARAMS)
    return daily.spine_days(totals, first, last).select(
        "account_id", "balance_date", "merch_name", *_doubles("amount_base", "unmatched_amount")
    )


def rate_fill(spark, sf_dir):
    return _days(spark, sf_dir).select("account_id", "balance_date", *_doubles("mdr_rate"))


def ops_balance_first(spark, sf_dir):
    return pick.earliest_ops_balance(b.ops_balances(spark, sf_dir)).select(
        "account_id", "ops_date", *_doubles("balance")
    )


def account_day_balances(spark, sf_dir):
    return _days(spark, sf_dir).select(
        "account_id", "balance_date", "is_settlement_day", "next_is_settlement_day", "last_working_day",
        *_doubles("balance_raw", "trx_00_amt", "first_trx", "holiday_carry_amt", "amount_voucher", "balance", "balance_adj"),
    )


def settlement_batches(spark, sf_dir):
    return batches.settlement_batches(_days(spark, sf_dir)).where("closes_batch").select(
        "account_id", "balance_date",
        *_doubles("batch_amount_base", "batch_unmatched_amount", "batch_amount_voucher", "batch_first_trx"),
    )


def _carried(spark, sf_dir):
    return batches.with_carry_over(batches.settlement_batches(_days(spark, sf_dir)), PARAMS)


def carry_over(spark, sf_dir):
    return _carried(spark, sf_dir).select("account_id", "balance_date", *_doubles("carry_over_balance"))


def settlement_amounts(spark, sf_dir):
    return batches.settlement_amounts(_carried(spark, sf_dir), PARAMS).select(
        "account_id", "balance_date",
        *_doubles("amount_final", "total_gross_balance", "total_mdr", "total_net_trx", "balance_final", "gross_difference"),
    )


def settlement_status(spark, sf_dir):
    return batches.settlement_amounts(_carried(spark, sf_dir), PARAMS).select(
        "account_id", "balance_date", batches.settlement_status(PARAMS).alias("confirm_to_transfer")
    )


def unmatched_totals(spark, sf_dir):
    closed = batches.settlement_batches(_days(spark, sf_dir)).where("closes_batch")
    return closed.select(
        "account_id", "balance_date", F.col("batch_unmatched_traffic").alias("total_traffic_not_match"),
        F.col("batch_unmatched_amount").cast("double").alias("total_gross_transaction_not_match"),
        *[c.cast("double").alias(n) for n, c in batches.unmatched_fees().items()],
    )


def bank_pick(spark, sf_dir):
    return pick.preferred_bank(b.bank_accounts(spark, sf_dir))


def settlement_report(spark, sf_dir):
    return settlement.settlement_report(b.inputs(spark, sf_dir), PARAMS)


def report_from_extracts(spark, sf_dir):
    inputs = b.inputs(spark, sf_dir)
    given = extracts.extracts(inputs, PARAMS, all_codes=False)
    return extracts.report_from_extracts(given, inputs, PARAMS)


def extract_row_counts(spark, sf_dir):
    return extracts.extract_counts(b.inputs(spark, sf_dir), PARAMS)


def status_summary(spark, sf_dir):
    return report.status_counts(settlement_report(spark, sf_dir))


def report_sink_rows(spark, sf_dir):
    return sink.sink_rows(settlement_report(spark, sf_dir))


def report_replace_window(spark, sf_dir):
    """Stores the report of a week earlier, replaces its window by today's, and reads the table back."""
    inputs = b.inputs(spark, sf_dir)
    path = f"{shared_folder(spark)}/settlement_report_{uuid.uuid4().hex}"
    for as_of in (PARAMS.as_of - timedelta(days=7), PARAMS.as_of):
        params = replace(PARAMS, as_of=as_of)
        rows = settlement.settlement_report(inputs, params)
        sink.replace_window(rows, path, params.report_from, params.as_of)
    return sink.read_report(spark, path)


def report_from_day_states(spark, sf_dir):
    """Two daily runs from stored day states; at the first, the evenings of its last two days had not arrived yet."""
    inputs = b.inputs(spark, sf_dir)
    path = f"{shared_folder(spark)}/day_states_{uuid.uuid4().hex}"
    before = replace(PARAMS, as_of=PARAMS.as_of - timedelta(days=1))
    arrived = (F.col("txn_date") < F.lit(before.days_back(2))) | (F.hour("txn_date") < 18)
    incremental.advance(replace(inputs, ledger=inputs.ledger.where(arrived)), before, path)
    incremental.advance(inputs, PARAMS, path)
    return incremental.report_from_state(inputs, PARAMS, path)


def unreadable_values(spark, sf_dir):
    """All inputs, with amounts, accounts and times spoilt here and there."""
    tables = b.input_tables(spark, sf_dir)
    kind = F.col("issuer")
    ledger_rows = tables["ledger"]
    tables["ledger"] = ledger_rows.withColumns({
        "AMT": F.when(kind == "signup", F.concat(F.lit("Rp "), "terminal_id")).otherwise(F.col("AMT")),
        "account_id": F.when(kind == "click", F.concat(F.lit("no. "), "account_id")).otherwise(F.col("account_id").cast("string")),
        "txn_date": F.when(kind == "view", "").otherwise(F.col("txn_date").cast("string")),
    })
    balance = F.col("c_acctbal")
    tables["ops_balances"] = b.table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("account_id"), F.when(balance < 0, F.lit("NaN").cast("double")).otherwise(balance).alias("balance"),
        F.lit("2024-01-30").alias("created_date"), F.when(balance < 5000, "2024-02-30").otherwise("2024-01-30 08:00:00").alias("processed_dttm"),
    )
    return unreadable_in(tables, b.feed_sources(spark, sf_dir), b.RENAMED)


def report_empty_keeps_table(spark, sf_dir):
    """An empty report comes after today's; the table keeps today's."""
    rows = settlement_report(spark, sf_dir)
    path = f"{shared_folder(spark)}/settlement_report_{uuid.uuid4().hex}"
    for report_rows in (rows, rows.where("false")):
        sink.replace_window(report_rows, path, PARAMS.report_from, PARAMS.as_of)
    return sink.read_report(spark, path)


def report_reading_order(spark, sf_dir):
    """The sorted report, each row with its place within its settle date."""
    place = F.row_number().over(Window.partitionBy("balance_date").orderBy("account_id"))
    rows = report.for_reading(settlement_report(spark, sf_dir))
    return rows.select("balance_date", "account_id", place.cast("bigint").alias("place"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        ledger_window, signed_amount_daily, merchant_rates, referral_filter_null_safe, dedup_transactions, dedup_text_ids,
        feed_keys, card_approval_keys, card_keys_by_filter, recon_issuer_ref_match, recon_extref_match, recon_approval_match, recon_key_first_match, base_projection, match_split,
        voucher_rows, voucher_next_day, first_transaction_of_day, midnight_weekday_amount, day_measures, holiday_carry,
        calendar_last_working_day, holiday_coverage_gaps, orders_by_settlement_day_of_2026, drop_helper_columns, daily_matched_unmatched, account_day_spine, rate_fill, ops_balance_first,
        account_day_balances, settlement_batches, carry_over, settlement_amounts, settlement_status,
        unmatched_totals, bank_pick, settlement_report, report_from_extracts, extract_row_counts, status_summary, report_sink_rows, report_replace_window,
        report_empty_keeps_table, report_reading_order, report_from_day_states, unreadable_values,
    )
}
