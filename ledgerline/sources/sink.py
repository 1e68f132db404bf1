"""Report sink: text forms, and replacing one window of a table stored by date."""

from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.sources import snapshots
from ledgerline.sources.schemas import STORED_REPORT


def account_text(c: Column) -> Column:
    """Account id as text; anything that is no number becomes '0'."""
    number = c.cast("string").try_cast("decimal(38,4)").try_cast("bigint")
    return F.coalesce(number, F.lit(0).cast("bigint")).cast("string")


def bank_number_text(c: Column) -> Column:
    """Account number as text without a trailing '.0'; missing or 'nan' becomes ''."""
    text = F.regexp_replace(F.coalesce(c.cast("string"), F.lit("")), r"\.0$", "")
    return F.when(text == "nan", "").otherwise(text)


def sink_rows(report: DataFrame) -> DataFrame:
    """The report as it is stored."""
    return report.withColumns(
        {
            "balance_date": F.to_date("balance_date"),
            "account_id": account_text(F.col("account_id")),
            "bank_account_number": bank_number_text(F.col("bank_account_number")),
        }
    )


@dataclass(frozen=True)
class Written:
    rows: int
    dates: tuple[date, ...]
    by_status: dict[str, int]


STATUSES = ("CONFIRM", "NOT MATCH", "MINIMUM NOT MET")


DAY = "_day"


def replace_window(
    report: DataFrame, path: str, first: date, last: date, create: snapshots.Create = snapshots.create_if_absent
) -> Written:
    """Replace the settle dates ``first``..``last`` of the table at ``path`` by ``report``, as one commit.

    The new dates are written to a folder of their own. One file then makes them, and the folders of
    all dates outside the window as they were, the next version of the table:
    readers see the whole window before or after it. A run that stops half way leaves the table as it
    was; so does an empty report. If another run committed since this one began, this one
    raises :class:`snapshots.Conflict` and changes nothing. Failures raise.

    ``rebalance`` sizes the files per date at run time and splits a large date
    over several tasks. The counts are observed after it, in the stage that
    writes, where a re-run task is counted once.
    """
    snapshots.check_location(path, report.sparkSession.sparkContext.master)
    base, folder = snapshots.manifest(path), snapshots.new_folder()
    seen = Observation("settlement_report")
    status = F.col("confirm_to_transfer")
    rows = (
        sink_rows(report)
        .where(F.col("balance_date").between(first, last))
        .hint("rebalance", "balance_date")
        .observe(
            seen,
            F.count("*").alias("rows"),
            F.collect_set("balance_date").alias("dates"),
            *[F.count(F.when(status == s, 1)).alias(s) for s in STATUSES],
        )
    )
    rows.withColumn(DAY, F.col("balance_date")).write.partitionBy(DAY).parquet(f"{path}/{folder}")
    metrics = seen.get
    written = Written(
        rows=metrics["rows"],
        dates=tuple(sorted(metrics["dates"])),
        by_status={s: metrics[s] for s in STATUSES},
    )
    if written.rows:
        outside = {day: at for day, at in base.folders.items() if not first <= day <= last}
        snapshots.commit(path, base, outside | {day: f"{folder}/{DAY}={day}" for day in written.dates}, create)
    return written


def read_report(
    spark: SparkSession, path: str, first: date | None = None, last: date | None = None, version: int | None = None
) -> DataFrame:
    """The latest version of the table, or ``version``; of the settle dates ``first``..``last`` if given, no other folder is listed."""
    snapshots.check_location(path, spark.sparkContext.master)
    held = snapshots.manifest(path, version).folders.items()
    folders = [f"{path}/{f}" for day, f in sorted(held) if (first is None or day >= first) and (last is None or day <= last)]
    if not folders:
        return spark.createDataFrame([], STORED_REPORT)
    return spark.read.schema(STORED_REPORT).option("recursiveFileLookup", "true").parquet(*folders)
