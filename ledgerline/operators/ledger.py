"""Ledger rows: trailing window, sign, and early pruning by account."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import AMOUNT, held_key, or_zero, signed_amount, since
from ledgerline.plans.params import Params
from ledgerline.plans.rates import in_scope, referral_in_scope


def ledger_since(ledger: DataFrame, days: int, params: Params) -> DataFrame:
    """Ledger rows of the last ``days`` days, without the excluded accounts."""
    recent = ledger.where(since("txn_date", params.days_back(days)))
    return recent.where(~F.col("account_id").isin(*params.excluded_accounts))


def signed_ledger(ledger: DataFrame, params: Params) -> DataFrame:
    """The ledger window with ``trx_date`` and the signed ``amount_base`` (null counts as 0)."""
    return ledger_since(ledger, params.ledger_days, params).select(
        "*",
        F.to_date("txn_date").alias("trx_date"),
        or_zero(signed_amount(), AMOUNT).alias("amount_base"),
    )


def with_merchants(rows: DataFrame, merchants: DataFrame) -> DataFrame:
    """Inner join on account; ``merchants`` is already reduced to the accounts in scope.

    Joined on the held form of the account, so that a hot account can be split.
    """
    key = held_key(F.col("account_id").cast("string"))
    held = merchants.withColumn("_key", key).drop("account_id")
    return rows.withColumn("_key", key).join(held, "_key").drop("_key")


def prune_accounts(rows: DataFrame, merchants: DataFrame, params: Params) -> DataFrame:
    """Drop rows of out-of-scope accounts early; Catalyst plans the join by its own size estimates.

    Joined on the held form of the account, so that a hot account can be split where rows are shuffled.
    """
    key = held_key(F.col("account_id").cast("string"))
    scope = merchants.where(in_scope(params) & referral_in_scope(params)).select(key.alias("_key"))
    return rows.withColumn("_key", key).join(scope, "_key", "left_semi").drop("_key")


def flag_accounts(rows: DataFrame, merchants: DataFrame, params: Params) -> DataFrame:
    """Like :func:`prune_accounts`, but rows that only their referral excludes stay, and ``settles`` says which do not.

    ``merchants`` has one row per account.
    """
    key = held_key(F.col("account_id").cast("string"))
    scope = merchants.where(in_scope(params)).select(key.alias("_key"), referral_in_scope(params).alias("settles"))
    return rows.withColumn("_key", key).join(scope, "_key").drop("_key")
