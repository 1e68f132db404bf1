"""Column expressions: money, signs, windows in time, match-key forms."""

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.plans import fixed_values as house

AMOUNT = "decimal(18,4)"  # one transaction; fits a long
MONEY = "decimal(20,4)"  # totals
RATE = "decimal(5,4)"
FEE = "decimal(28,8)"  # money x rate, exact


def zero(of: str = MONEY) -> Column:
    return F.lit(0).cast(of)


def or_zero(c: Column, of: str = MONEY) -> Column:
    return F.coalesce(c.cast(of), zero(of))


def signed_amount(txn_type: str = "txn_type", amt: str = "amt") -> Column:
    """Purchases count up, reversals down, any other type is 0."""
    kind, value = F.col(txn_type), F.col(amt)
    return (
        F.when(kind == house.PURCHASE, value)
        .when(kind == house.REVERSAL, -value)
        .otherwise(zero(AMOUNT))
        .cast(AMOUNT)
    )


def since(ts: str, first_day: date) -> Column:
    """``ts`` falls on ``first_day`` or later; a plain comparison, so it reaches the scan."""
    return F.col(ts) >= F.lit(first_day).cast("timestamp_ntz")


def shortly_after_midnight(ts: str, until: timedelta) -> Column:
    """Time of day from 00:00:00 to ``until``, both included, to the microsecond."""
    midnight = F.to_date(ts).cast("timestamp_ntz")
    return F.col(ts) <= midnight + F.lit(until)


def monday_to_friday(day: Column) -> Column:
    return F.dayofweek(day).between(2, 6)


def padded_reference(c: Column) -> Column:
    """Twelve characters: padded with zeros on the left, cut on the right when longer."""
    return F.lpad(c.cast("string"), 12, "0")


def invoice_reference(c: Column) -> Column:
    return F.right(c, F.lit(18))


def sequence_reference(c: Column) -> Column:
    return F.regexp_replace(c, "_payment", "")


def held_key(key: Column) -> Column:
    """Join form of a key on the side that is looked up; pairs with :func:`sought_key`.

    The prefix makes it a new expression, so Spark shuffles this side once more
    even where it is already grouped by the bare key. Only a join whose two sides
    come straight from a shuffle is split by the adaptive skew rule.
    """
    return F.concat(F.lit("k"), key)


def sought_key(key: Column, *by: str) -> Column:
    """Join form of a key on the row side: null keys go to many partitions instead of one.

    A null key is replaced by a value that no held key has. It depends on row
    values only, so a task that runs again writes the same rows to the same
    partitions.
    """
    return F.coalesce(held_key(key), F.concat(F.lit("n"), F.hex(F.xxhash64(*by))))
