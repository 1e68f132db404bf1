"""Keep one row per key, under an explicit order."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_row(df: DataFrame, by: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each ``by`` group; null keys equal each other.

    ``row_number() = 1`` lets Spark cut every group to one row per map task
    before the shuffle (window group limit), so a group that holds a large share
    of all rows still reaches its final task as a handful of rows.
    """
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def first_of_transaction(rows: DataFrame, *also_by: str) -> DataFrame:
    """One row per (account, transaction id, ...): a matched row if there is one, else the earliest.

    The order covers every column read afterwards, so rows that tie are the same row.
    """
    return first_row(
        rows,
        ["account_id", "credit_trans_trx_id", *also_by],
        [
            F.col("is_matched").desc(),
            F.col("txn_date").asc(),
            F.col("amount_base").desc(),
            F.col("merch_name").asc_nulls_last(),
        ],
    )


def deduplicate_transactions(rows: DataFrame) -> DataFrame:
    return first_of_transaction(rows)


def preferred_bank(bank_accounts: DataFrame) -> DataFrame:
    """The alphabetically first bank of each account, unnamed banks last."""
    columns = ["bank_name", "bank_account_number", "bank_account_name", "bank_code"]
    picked = first_row(
        bank_accounts.select("account_id", *columns),
        ["account_id"],
        [F.col(c).asc_nulls_last() for c in columns],
    )
    return picked


def earliest_ops_balance(ops_balances: DataFrame) -> DataFrame:
    """The first processed balance of each (account, ops date)."""
    rows = ops_balances.select(
        "account_id",
        F.to_date("created_date").alias("ops_date"),
        "processed_dttm",
        "balance",
    )
    return first_row(
        rows,
        ["account_id", "ops_date"],
        [F.col("processed_dttm").asc_nulls_last(), F.col("balance").asc()],
    ).drop("processed_dttm")
