"""Settlement calendar: one row per day of a bounded range."""

from collections.abc import Iterable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.plans import fixed_values as house
from ledgerline.sources.literal import literal_table
from ledgerline.sources.schemas import HOLIDAYS

# How far back the previous working day is sought; a longer closed run fails.
LOOK_BACK_DAYS = 31


def holiday_table(
    spark: SparkSession,
    public_holidays: DataFrame | None = None,
    extra: Iterable[date] = house.HOLIDAYS,
) -> DataFrame:
    """The fixed holidays plus a table of public holidays (``holiday_date``)."""
    fixed = literal_table(spark, HOLIDAYS, [(d,) for d in extra])
    if public_holidays is None:
        return fixed
    return fixed.unionByName(public_holidays.select(F.to_date("holiday_date").alias("holiday_date")))


Day = date | Column


def _days(spark: SparkSession, first: Column, last: Column) -> DataFrame:
    return spark.range(0, 1, 1, 1).select(F.explode(F.sequence(first, last)).alias("day"))


def known_days(known: DataFrame, first: Day, last: Day) -> DataFrame:
    """The days of ``first``..``last`` inside some interval (``known_from``, ``known_to``), both ends included.

    An interval with a null end is none; overlapping ones count once.
    """
    start, end = F.greatest("known_from", F.lit(first)), F.least("known_to", F.lit(last))
    held = known.where("known_from is not null and known_to is not null").select(start.alias("low"), end.alias("high"))
    return held.where("low <= high").select(F.explode(F.sequence("low", "high")).alias("day")).distinct()


def unknown_days(known: DataFrame, first: Day, last: Day) -> DataFrame:
    """The days of ``first``..``last`` that no interval holds."""
    days = _days(known.sparkSession, F.lit(first), F.lit(last))
    return days.join(F.broadcast(known_days(known, first, last)), "day", "left_anti")


def settlement_calendar(holidays: DataFrame, first: Day, last: Day, known: DataFrame | None = None) -> DataFrame:
    """One row per day ``first``..``last``; ``last_working_day`` is strictly before ``day``.

    It is computed on a range widened by the look-back and one day ahead. The
    frame has one row per day, so its single-partition window and its broadcast
    are bounded by the length of the date range. ``known`` holds the intervals for which the
    holidays are known; where it is given, the run fails on a day outside all of them, which
    would otherwise pass as a settlement day.
    """
    start, end = F.date_sub(F.lit(first), LOOK_BACK_DAYS), F.date_add(F.lit(last), 1)
    days = _days(holidays.sparkSession, start, end)
    closed = holidays.select(F.col("holiday_date").alias("day")).where(F.col("day").between(start, end)).distinct()
    days = days.join(F.broadcast(closed.withColumn("_holiday", F.lit(True))), "day", "left")
    open_day = (F.weekday("day") < 5) & F.col("_holiday").isNull()
    if known is not None:
        held = known_days(known, start, end).withColumn("_known", F.lit(True))
        days = days.join(F.broadcast(held), "day", "left")
        unknown = F.concat(F.lit("holidays are not known for "), F.col("day").cast("string"))
        open_day = F.when(F.col("_known"), open_day).otherwise(F.raise_error(unknown).cast("boolean"))
    closed_for = F.concat(F.lit(f"no settlement day in {LOOK_BACK_DAYS} days before "), F.col("day").cast("string"))
    by_day = Window.orderBy("day")
    opens = F.col("is_settlement_day")
    before = by_day.rowsBetween(Window.unboundedPreceding, -1)
    return (
        days.select("day", open_day.alias("is_settlement_day"))
        .withColumn("next_is_settlement_day", F.lead("is_settlement_day").over(by_day))
        .withColumn("last_working_day", F.last(F.when(opens, F.col("day")), True).over(before))
        .where(F.col("day").between(F.lit(first), F.lit(last)))
        .withColumn("last_working_day", F.coalesce("last_working_day", F.raise_error(closed_for).cast("date")))
    )
