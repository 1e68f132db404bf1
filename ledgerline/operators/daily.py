"""Daily sums and the dense account x day relation they are laid out on."""

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import FEE, MONEY, RATE, or_zero, shortly_after_midnight
from ledgerline.operators.pick import earliest_ops_balance
from ledgerline.plans.params import Params


def named_sums(rows: DataFrame, params: Params, *also_by: str) -> DataFrame:
    """Matched and unmatched sums per (account, balance_date, merch_name, ...).

    Text stays in the key, so that all buffers are fixed-width and hash
    aggregation applies; about one row per account and day comes out.
    ``opening`` is the matched part of the first moments of the day.
    """
    matched, amount = F.col("is_matched"), F.col("amount_base")
    opens = shortly_after_midnight("txn_date", params.holiday_carry_until)
    zero = F.lit(0).cast(rows.schema["amount_base"].dataType)
    by = ["account_id", F.to_date("txn_date").alias("balance_date"), "merch_name", *also_by]
    return rows.groupBy(*by).agg(
        F.sum(F.when(matched, amount).otherwise(zero)).cast(MONEY).alias("matched"),
        F.sum(F.when(matched, zero).otherwise(amount)).cast(MONEY).alias("unmatched"),
        F.sum(F.when(matched & opens, amount).otherwise(zero)).cast(MONEY).alias("opening"),
        F.count(F.when(~matched, 1)).alias("traffic"),
        F.min("txn_date").alias("first_seen"),
    )


def _day_sums(*more: Column) -> list[Column]:
    """Aggregates of :func:`named_sums` rows; the name is the earliest one that is not null."""
    named = F.when(F.col("merch_name").isNotNull(), F.struct("first_seen", "merch_name"))
    return [
        F.min_by("merch_name", named).alias("merch_name"),
        F.sum("matched").cast(MONEY).alias("amount_base"),
        F.sum("unmatched").cast(MONEY).alias("unmatched_amount"),
        F.sum("opening").cast(MONEY).alias("opening_matched"),
        F.sum("traffic").alias("unmatched_traffic"),
        *more,
    ]


def daily_totals(rows: DataFrame, merchants: DataFrame, params: Params) -> DataFrame:
    """Daily sums per (account, balance_date), with rate and merchant name.

    The rate is a property of the account: it is joined to the sums, not to the
    transactions, and the unmatched fee is the rate times the unmatched sum, exactly.
    """
    by_day = named_sums(rows, params).groupBy("account_id", "balance_date").agg(*_day_sums())
    fee = F.col("unmatched_amount") * F.col("mdr_rate")
    return by_day.join(merchants.select("account_id", "mdr_rate"), "account_id").withColumns(
        {"unmatched_mdr": fee, "unmatched_net": F.col("unmatched_amount") - fee}
    )


def daily_totals_of_priced_rows(rows: DataFrame, params: Params) -> DataFrame:
    """The same for rows that carry their own ``mdr_rate``; the day shows the highest."""
    fee = F.col("unmatched") * F.col("mdr_rate")
    sums = _day_sums(
        F.max("mdr_rate").alias("mdr_rate"),
        F.sum(fee).cast(FEE).alias("unmatched_mdr"),
        F.sum(F.col("unmatched") - fee).cast(FEE).alias("unmatched_net"),
    )
    priced = named_sums(rows, params, "mdr_rate")
    return priced.groupBy("account_id", "balance_date").agg(*sums)


Day = date | Column


def spine_bounds(daily: DataFrame, params: Params, until: date | None = None) -> tuple[Column, Column]:
    """First active day, and the end of the tail after the last one, or after ``as_of`` or at ``until`` if that is earlier.

    A row dated far in the future so adds no days. Both are scalar subqueries: one row of two
    dates, computed when the plan runs and not while it is built.
    """
    as_of = F.lit(params.as_of)
    low, high = (F.least(F.coalesce(day, as_of), as_of) for day in (F.min("balance_date"), F.max("balance_date")))
    last = F.date_add(high, params.spine_tail_days)
    if until is not None:
        last = F.greatest(low, F.least(last, F.lit(until)))
    return daily.agg(low.alias("first")).scalar(), daily.agg(last.alias("last")).scalar()


def account_spine(daily: DataFrame, first: Day, last: Day) -> DataFrame:
    """Every account on every day, named as on its last active day (which may be null)."""
    accounts = daily.groupBy("account_id").agg(F.max_by("merch_name", "balance_date").alias("merch_name"))
    return accounts.withColumn("balance_date", F.explode(F.sequence(F.lit(first), F.lit(last))))


def lay_on_spine(spine: DataFrame, *sources: DataFrame) -> DataFrame:
    """The columns of all sources on the rows of the spine.

    The result of left joins on (account_id, balance_date) with sources that are
    unique on it. Stacking the rows and regrouping them needs one shuffle, by
    account, for all sources, and the windows per account that follow need none.
    An account has no more rows here than days times sources. A second row of a source fails the run.
    """
    key = ["account_id", "balance_date"]
    rows = spine.withColumn("_on_spine", F.lit(True))
    for source in sources:
        rows = rows.unionByName(source, allowMissingColumns=True)
    twice = F.concat(F.lit("two rows of one source: "), F.concat_ws(" ", *key))

    def the_only(c: str) -> Column:
        one = F.when(F.count(c) > 1, F.raise_error(twice).cast(rows.schema[c].dataType)).otherwise(F.max(c))
        return one.alias(c)

    only = [the_only(c) for c in rows.columns if c not in key]
    laid = rows.repartition("account_id").groupBy(*key).agg(*only)
    return laid.where("_on_spine").drop("_on_spine")


def spine_days(daily: DataFrame, first: Day, last: Day, *sources: DataFrame) -> DataFrame:
    """Every account on every day with its daily sums, where there are any, and other sources.

    Sources are cut to the days of the spine first; that filter reaches their scans.
    """
    spine = account_spine(daily, first, last).withColumnRenamed("merch_name", "_last_name")
    on_days = F.col("balance_date").between(F.lit(first), F.lit(last))
    return (
        lay_on_spine(spine, *[source.where(on_days) for source in (daily, *sources)])
        .withColumn("merch_name", F.coalesce("_last_name", "merch_name"))
        .drop("_last_name")
    )


def filled_rate(params: Params) -> Column:
    """Rate carried forward per account, then backward, then the default."""
    by_day = Window.partitionBy("account_id").orderBy("balance_date")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = by_day.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return F.coalesce(
        F.last("mdr_rate", True).over(so_far),
        F.first("mdr_rate", True).over(whole),
        F.lit(params.default_rate).cast(RATE),
    )


def ops_by_balance_date(ops_balances: DataFrame) -> DataFrame:
    """Ops balances dated the day after the balance they report; text that is no number counts 0."""
    return earliest_ops_balance(ops_balances).select(
        "account_id",
        F.date_sub("ops_date", 1).alias("balance_date"),
        or_zero(F.col("balance")).alias("balance_raw"),
    )


def holiday_carry() -> Column:
    """Opening amount of the last working day up to the row, if a closed day follows that day.

    Equal to a join on the last working day before ``balance_date + 1``, but the
    spine is dense, so the latest working day at or before the row is that day.
    """
    by_day = Window.partitionBy("account_id").orderBy("balance_date")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = F.when(F.col("next_is_settlement_day"), 0).otherwise(F.col("opening_matched"))
    latest = F.last(F.when(F.col("is_settlement_day"), or_zero(carried)), True).over(so_far)
    return or_zero(latest)


def account_days(spine: DataFrame, calendar: DataFrame, params: Params) -> DataFrame:
    """One dense row per (account, balance_date) with everything the settlement walk reads.

    ``spine`` holds the daily sums, the ledger measures and the ops balances.
    ``balance_raw`` is the ops balance alone and may be null; ``balance`` adds the
    midnight amount; ``balance_adj`` also adds the holiday carry. A voucher counts
    only on a day on which the account was active.
    """
    active = F.col("amount_base").isNotNull()
    rows = spine.join(F.broadcast(calendar.withColumnRenamed("day", "balance_date")), "balance_date")
    is_open = F.col("is_settlement_day")
    return rows.select(
        "account_id",
        "balance_date",
        "merch_name",
        filled_rate(params).alias("mdr_rate"),
        or_zero(F.col("amount_base")).alias("amount_base"),
        or_zero(F.col("unmatched_amount")).alias("unmatched_amount"),
        or_zero(F.col("unmatched_mdr"), FEE).alias("unmatched_mdr"),
        or_zero(F.col("unmatched_net"), FEE).alias("unmatched_net"),
        F.coalesce("unmatched_traffic", F.lit(0)).alias("unmatched_traffic"),
        or_zero(F.when(active, F.col("amount_voucher"))).alias("amount_voucher"),
        or_zero(F.col("first_trx")).alias("first_trx"),
        or_zero(F.col("trx_00_amt")).alias("trx_00_amt"),
        holiday_carry().alias("holiday_carry_amt"),
        "balance_raw",
        is_open.alias("is_settlement_day"),
        "next_is_settlement_day",
        F.when(is_open, F.col("balance_date")).otherwise(F.col("last_working_day")).alias("last_working_day"),
    ).select(
        "*",
        (or_zero(F.col("balance_raw")) + F.col("trx_00_amt")).cast(MONEY).alias("balance"),
        (or_zero(F.col("balance_raw")) + F.col("trx_00_amt") + F.col("holiday_carry_amt"))
        .cast(MONEY)
        .alias("balance_adj"),
    )
