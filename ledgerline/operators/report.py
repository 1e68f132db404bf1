"""The report: output window, bank details, column layout, status counts."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.pick import preferred_bank
from ledgerline.plans.params import Params
from ledgerline.sources.schemas import REPORT


def with_bank(rows: DataFrame, bank_accounts: DataFrame) -> DataFrame:
    return rows.join(preferred_bank(bank_accounts), "account_id", "left")


def report_rows(settled: DataFrame, bank_accounts: DataFrame, params: Params) -> DataFrame:
    """Settle dates of the report window, with bank details, in the report's columns and types."""
    window = F.col("balance_date").between(params.report_from, params.as_of)
    rows = with_bank(settled.where(window), bank_accounts)
    return rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in REPORT])


def for_reading(report: DataFrame) -> DataFrame:
    """Newest settle date first, then by account. Not needed before a write."""
    return report.orderBy(F.col("balance_date").desc(), F.col("account_id").asc())


def status_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("confirm_to_transfer").agg(F.count("*").alias("n_rows"))
