"""Amounts taken straight from the ledger: vouchers and the just-after-midnight sums.

None of them looks at matching, de-duplication or referral exclusions.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import (
    AMOUNT,
    MONEY,
    monday_to_friday,
    or_zero,
    shortly_after_midnight,
    signed_amount,
    since,
)
from ledgerline.operators.ledger import ledger_since, with_merchants
from ledgerline.plans.params import Params


def _is_voucher(params: Params) -> Column:
    return F.col("issuer").isin(*params.voucher_issuers)


def _opens_weekday(params: Params) -> Column:
    early = shortly_after_midnight("txn_date", params.weekday_opening_until)
    return early & monday_to_friday(F.to_date("txn_date"))


def _opens_day(params: Params) -> Column:
    return shortly_after_midnight("txn_date", params.first_trx_until)


def _amount() -> Column:
    return or_zero(signed_amount(), AMOUNT)


def signed_daily(ledger: DataFrame, params: Params) -> DataFrame:
    """Signed sum per (account, day)."""
    return (
        ledger_since(ledger, params.ledger_days, params)
        .groupBy("account_id", F.to_date("txn_date").alias("trx_date"))
        .agg(F.sum(_amount()).cast(MONEY).alias("amount_base"))
    )


def voucher_totals(ledger: DataFrame, params: Params) -> DataFrame:
    """Voucher sum per account, booked on the day after the transaction."""
    return (
        ledger_since(ledger, params.ledger_days, params)
        .where(_is_voucher(params))
        .groupBy("account_id", F.date_add(F.to_date("txn_date"), 1).alias("balance_date"))
        .agg(F.sum(_amount()).cast(MONEY).alias("amount_voucher"))
    )


def voucher_rows(ledger: DataFrame, merchants: DataFrame, params: Params) -> DataFrame:
    """Voucher transactions of the accounts in scope, one by one."""
    rows = ledger_since(ledger, params.ledger_days, params).where(_is_voucher(params))
    return with_merchants(rows, merchants.select("account_id")).select(
        "txn_date",
        F.to_date("txn_date").alias("trx_date"),
        "account_id",
        "merchant_id",
        "issuer",
        _amount().alias("amount_base"),
    )


def weekday_opening_totals(ledger: DataFrame, params: Params) -> DataFrame:
    """Signed sum of the first moments of each weekday, per (account, day)."""
    return (
        ledger_since(ledger, params.weekday_opening_days, params)
        .where(_opens_weekday(params))
        .groupBy("account_id", F.to_date("txn_date").alias("trx_date"))
        .agg(F.sum(_amount()).cast(MONEY).alias("amount"))
    )


def first_transactions(ledger: DataFrame, merchants: DataFrame, params: Params) -> DataFrame:
    """The first instant after midnight with any row, per (account, day): amount, fee, net.

    Rows are summed per instant before merchants are joined, so the join and the
    window see instants, not transactions.
    """
    amount = F.col("amount")
    fee = amount * F.col("mdr_rate")
    instants = (
        ledger_since(ledger, params.ledger_days, params)
        .where(_opens_day(params))
        .groupBy("account_id", "txn_date")
        .agg(F.sum(_amount()).cast(MONEY).alias("amount"))
    )
    by_day = Window.partitionBy("account_id", F.to_date("txn_date")).orderBy("txn_date")
    return (
        instants.withColumn("_rank", F.row_number().over(by_day))
        .where("_rank = 1")
        .drop("_rank")
        .join(merchants.select("account_id", "mdr_rate"), "account_id")
        .select(
            "txn_date",
            "account_id",
            "amount",
            F.round(fee, 0).alias("mdr_amount"),
            F.round(amount - fee, 0).alias("nett_amount"),
        )
    )


def day_measures(ledger: DataFrame, params: Params, row_counts: bool = False) -> DataFrame:
    """All ledger-side measures of the settlement walk from one scan, per (account, balance_date).

    ``amount_voucher`` is booked a day late, ``first_trx`` a day early and
    ``trx_00_amt`` on its own day. The scan keeps only voucher and midnight rows
    and sums them before anything is shuffled. ``row_counts`` adds ``voucher_rows``, how many rows the sum has.
    """
    recent = since("txn_date", params.days_back(params.ledger_days))
    weekday_recent = since("txn_date", params.days_back(params.weekday_opening_days))
    voucher = recent & F.coalesce(_is_voucher(params), F.lit(False))
    opening = recent & _opens_day(params)
    weekday = weekday_recent & _opens_weekday(params)
    days = max(params.ledger_days, params.weekday_opening_days)

    per_instant = (
        ledger_since(ledger, days, params)
        .where(voucher | opening | weekday)
        .select(
            "account_id",
            F.to_date("txn_date").alias("day"),
            F.when(opening, F.col("txn_date")).alias("instant"),
            _amount().alias("amount"),
            voucher.alias("is_voucher"),
            weekday.alias("is_weekday"),
        )
        .groupBy("account_id", "day", "instant")
        .agg(
            F.sum(F.when(F.col("is_voucher"), F.col("amount"))).cast(MONEY).alias("voucher"),
            F.sum(F.when(F.col("is_weekday"), F.col("amount"))).cast(MONEY).alias("weekday"),
            F.sum(F.when(F.col("instant").isNotNull(), F.col("amount"))).cast(MONEY).alias("opening"),
            F.count(F.when(F.col("is_voucher"), 1)).alias("rows"),
        )
    )
    none, no_time = F.lit(None).cast(MONEY), F.lit(None).cast("timestamp_ntz")

    def booked(shift: int, instant=no_time, first=none, voucher=none, weekday=none, rows=F.lit(0).cast("long")) -> Column:
        return F.struct(
            F.date_add("day", shift).alias("balance_date"),
            instant.alias("instant"),
            first.alias("first"),
            voucher.alias("voucher"),
            weekday.alias("weekday"),
            rows.alias("rows"),
        )

    bookings = F.array(
        booked(1, voucher=F.col("voucher"), rows=F.col("rows")),
        booked(0, weekday=F.col("weekday")),
        booked(-1, instant=F.col("instant"), first=F.col("opening")),
    )
    return (
        per_instant.select("account_id", F.inline(bookings))
        .where("coalesce(first, voucher, weekday) is not null")
        .groupBy("account_id", "balance_date")
        .agg(
            F.sum("voucher").cast(MONEY).alias("amount_voucher"),
            F.sum("weekday").cast(MONEY).alias("trx_00_amt"),
            F.min_by("first", "instant").alias("first_trx"),
            *([F.sum("rows").alias("voucher_rows")] if row_counts else []),
        )
    )
