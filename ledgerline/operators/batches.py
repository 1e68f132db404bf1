"""Accumulate rows until a boundary at which something moved, then start over.

Done with running sums. All windows share one specification, partition by key and
order by day, so the operator costs one exchange and one sort.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.columns import FEE, MONEY, or_zero
from ledgerline.plans.params import Params


def close_batches(
    rows: DataFrame,
    *,
    key: Sequence[str],
    order: str,
    boundary: Column,
    gate: Sequence[str],
    measures: Sequence[str],
) -> DataFrame:
    """Mark the rows that close a batch and give every row the sums of its open batch.

    A row closes a batch when ``boundary`` holds and some ``gate`` column sums to
    non-zero since the previous boundary. That equals the sum since the previous
    close: a boundary that does not close has gate sums of exactly zero. The other
    measures are not in the gate, so they run on from one close to the next.

    Adds ``closes_batch``, ``batch_<column>`` for every gate column and measure,
    and ``opens_batch``: the first row of the batch with a non-zero gate column.
    ``boundary`` must not be null, nor may gate columns and measures.
    """
    ordered = Window.partitionBy(*key).orderBy(order)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    columns = [*gate, *measures]

    moved = F.lit(False)
    for c in gate:
        moved = moved | (F.col(c) != 0)
    running = [F.sum(c).over(so_far).alias(f"_run_{c}") for c in columns]
    sums = rows.select(
        "*", boundary.alias("_boundary"), moved.alias("_moved"), *running
    ).withColumn("_run_moved", F.count(F.when(F.col("_moved"), 1)).over(so_far))

    def at_last(flag: str, names: Sequence[str]) -> Column:
        snapshot = F.struct(*[F.col(f"_run_{c}").alias(c) for c in names])
        return F.last(F.when(F.col(flag), snapshot), True).over(before)

    def since_last(snapshot: str, c: str) -> Column:
        return F.col(f"_run_{c}") - F.coalesce(F.col(snapshot)[c], F.lit(0))

    segments = sums.withColumn("_segment", at_last("_boundary", gate))
    moved_in_segment = F.lit(False)
    for c in gate:
        moved_in_segment = moved_in_segment | (since_last("_segment", c) != 0)
    closing = segments.withColumn("closes_batch", F.col("_boundary") & moved_in_segment)
    batches = closing.withColumn("_batch", at_last("closes_batch", [*columns, "moved"]))
    return batches.select(
        *[F.col(c) for c in rows.columns],
        "closes_batch",
        (F.col("_moved") & (since_last("_batch", "moved") == 1)).alias("opens_batch"),
        *[
            since_last("_batch", c).cast(rows.schema[c].dataType).alias(f"batch_{c}")
            for c in columns
        ],
    )


GATE = ("amount_base", "unmatched_amount")
MEASURES = ("amount_voucher", "first_trx", "unmatched_mdr", "unmatched_net", "unmatched_traffic")


def settlement_batches(days: DataFrame) -> DataFrame:
    """Batches of account-days: the boundary is a day whose next day settles."""
    return close_batches(
        days,
        key=["account_id"],
        order="balance_date",
        boundary=F.col("next_is_settlement_day"),
        gate=GATE,
        measures=MEASURES,
    )


def with_carry_over(batches: DataFrame, params: Params) -> DataFrame:
    """Closing rows only, with the balance carried over into them.

    After a closed day, the carry is the raw ops balance as of the last working
    day before the settle date: on the dense spine, that sits on the latest
    earlier row whose next day settles. Otherwise it is the balance of the day
    before the batch's first active day. Balances of at least the minimum
    transfer are not carried; negative ones are. Look-ups that leave the spine
    find nothing and carry 0.
    """
    ordered = Window.partitionBy("account_id").orderBy("balance_date")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)

    def latest(flag: str, value: Column, frame) -> Column:
        # The struct keeps a null value of the latest flagged row from being skipped.
        return F.last(F.when(F.col(flag), F.struct(value.alias("v"))), True).over(frame)["v"]

    after_closed_day = latest("next_is_settlement_day", F.col("balance_raw"), before)
    before_batch = latest("opens_batch", F.col("_previous_balance"), so_far)
    source = F.when(F.col("is_settlement_day"), F.col("_before_batch")).otherwise(
        F.col("_after_closed_day")
    )
    minimum = F.lit(params.min_transfer).cast(MONEY)
    return (
        batches.withColumn("_previous_balance", F.lag("balance").over(ordered))
        .withColumn("_after_closed_day", after_closed_day)
        .withColumn("_before_batch", before_batch)
        .where("closes_batch")
        .withColumn("carry_over_balance", or_zero(F.when(source < minimum, source)))
        .drop("_previous_balance", "_after_closed_day", "_before_batch")
    )


def settlement_amounts(closed: DataFrame, params: Params) -> DataFrame:
    """Fee, net, and the balance side of every closed batch."""
    matched, voucher = F.col("batch_amount_base"), F.col("batch_amount_voucher")
    first_trx, adjusted = F.col("batch_first_trx"), F.col("balance_adj")
    final = (matched - voucher + F.col("carry_over_balance")).cast(MONEY)
    gap = F.abs((adjusted - matched) - first_trx)
    allowed = F.lit(params.first_trx_abs_tolerance) + F.lit(params.first_trx_rel_tolerance) * F.abs(
        first_trx
    )
    explained = (first_trx > 0) & (gap <= allowed)
    gross = F.when(explained, adjusted - first_trx).otherwise(adjusted).cast(MONEY)
    return (
        closed.withColumn("amount_final", final)
        .withColumn("total_gross_balance", gross)
        .withColumn("total_mdr", (F.col("amount_final") * F.col("mdr_rate")).cast(FEE))
        .withColumn("total_net_trx", (F.col("amount_final") - F.col("total_mdr")).cast(FEE))
        .withColumn("balance_final", (F.col("total_gross_balance") - voucher).cast(MONEY))
        .withColumn("gross_difference", (matched - F.col("total_gross_balance")).cast(MONEY))
    )


def settlement_status(params: Params) -> Column:
    difference = F.abs(F.col("amount_final") - F.col("balance_final"))
    return (
        F.when(F.col("total_net_trx") < F.lit(params.min_transfer), "MINIMUM NOT MET")
        .when(difference > F.lit(params.status_tolerance), "NOT MATCH")
        .otherwise("CONFIRM")
    )


def unmatched_fees() -> dict[str, Column]:
    """Fee and net of the unmatched part of a batch, rounded half to even."""
    return {
        "total_mdr_not_match": F.bround("batch_unmatched_mdr", 0),
        "total_amount_to_transfer_not_match": F.bround("batch_unmatched_net", 0),
    }


def settlements(days: DataFrame, params: Params) -> DataFrame:
    """One row per closed batch, dated by its settle date."""
    closed = with_carry_over(settlement_batches(days), params)
    return settlement_amounts(closed, params).select(
        F.date_add("balance_date", 1).alias("balance_date"),
        "account_id",
        "merch_name",
        "carry_over_balance",
        F.col("batch_amount_base").alias("total_gross_transaction"),
        "total_gross_balance",
        "gross_difference",
        F.col("batch_first_trx").alias("first_trx"),
        "trx_00_amt",
        F.col("batch_amount_voucher").alias("amount_voucher"),
        "amount_final",
        "balance_final",
        "total_mdr",
        "total_net_trx",
        F.col("total_net_trx").alias("amount_to_transfer"),
        settlement_status(params).alias("confirm_to_transfer"),
        F.col("batch_unmatched_traffic").alias("total_traffic_not_match"),
        F.col("batch_unmatched_amount").alias("total_gross_transaction_not_match"),
        *[c.alias(name) for name, c in unmatched_fees().items()],
    )
