"""The report from stored day states: a ledger day is matched when it is new or changed, and not again.

The state of a day holds one row for each account and transaction id of that day, the
one that the de-duplication prefers. That choice is a minimum, so the states of several days merge
into what the de-duplication of all their rows gives, and a run needs the feeds and the raw
ledger for changed days only. Whether a day changed is told by a print of everything
its state depends on: its ledger rows in scope, and the match keys of its date. So late or corrected
rows, late feeds, references that leave their window and accounts that come into
scope all make a day be matched anew.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.columns import AMOUNT, since
from ledgerline.operators.batches import settlements
from ledgerline.operators.daily import daily_totals
from ledgerline.operators.ledger import prune_accounts, signed_ledger
from ledgerline.operators.pick import deduplicate_transactions, first_of_transaction
from ledgerline.operators.recon import distinct_keys, flag_matches
from ledgerline.operators.report import report_rows
from ledgerline.plans.params import Params
from ledgerline.plans.rates import merchant_dimension, referral_in_scope
from ledgerline.plans.settlement import READ_LATER, last_reported_day, lay_out, match_keys, measures_of, recent_ops
from ledgerline.sources import snapshots
from ledgerline.sources.cuts import cut
from ledgerline.sources.inputs import Inputs

STATE = (
    "account_id long, merch_name string, txn_date timestamp_ntz, trx_date date, "
    f"credit_trans_trx_id string, amount_base {AMOUNT}, is_matched boolean"
)
DAY, PRINT = "_day", "_print"


def day_prints(rows: DataFrame, keys: Mapping[str, DataFrame]) -> DataFrame:
    """``day, print`` of every day with ledger rows: counts and sums of 64-bit hashes, independent of order.

    Rows are summed up where they are read; a few numbers a day are shuffled.
    """

    def summed(df: DataFrame, day: str) -> DataFrame:
        columns = [c for c in df.columns if c != day]
        hashed = F.xxhash64(*[F.struct(F.col(c).isNull(), c) for c in columns])
        parts = (F.count("*"), F.sum(hashed.cast("decimal(20,0)")), F.bit_xor(F.xxhash64(hashed)))
        return df.groupBy(F.col(day).alias("day")).agg(F.concat_ws("_", *parts).alias("part"))

    routes = [
        summed(distinct_keys(frame), "feed_date").select("day", F.concat(F.lit(f"{route}="), "part").alias("part"))
        for route, frame in keys.items()
    ]
    of_keys = routes[0]
    for more in routes[1:]:
        of_keys = of_keys.unionByName(more)
    of_keys = of_keys.groupBy("day").agg(F.array_join(F.array_sort(F.collect_list("part")), " ").alias("keys"))
    both = summed(rows, "trx_date").join(of_keys, "day", "left")
    return both.select("day", F.md5(F.concat_ws(" ", "part", F.coalesce("keys", F.lit("")))).alias("print"))


def stored_prints(path: str) -> dict[date, str]:
    return {day: folder.rsplit(f"/{PRINT}=", 1)[1] for day, folder in snapshots.manifest(path).folders.items()}


def advance(
    inputs: Inputs, params: Params, path: str, create: snapshots.Create = snapshots.create_if_absent
) -> tuple[date, ...]:
    """Bring the states at ``path`` up to ``params.as_of``, as one commit; returns the days that were matched.

    The driver sees a date and a print for each ledger day. Days that left the ledger's window, or lost all
    their rows, leave the next version. Two runs that start from one version cannot both commit.
    A run that stops half way leaves the states as they were.
    """
    spark = inputs.ledger.sparkSession
    snapshots.check_location(path, spark.sparkContext.master)
    base = snapshots.manifest(path)
    known = stored_prints(path) if base.version else {}
    rows = signed_ledger(prune_accounts(inputs.ledger, inputs.merchants, params), params).select(*READ_LATER)
    keys = match_keys(inputs, params)
    prints = {r["day"]: r["print"] for r in day_prints(rows, keys).collect()}
    changed = sorted(day for day, p in prints.items() if known.get(day) != p)
    folders = {day: base.folders[day] for day in prints if day not in changed}
    if changed:
        folder = snapshots.new_folder()
        states = _states(rows, keys, changed)
        name = F.element_at(F.create_map(*[F.lit(x) for day in changed for x in (day, prints[day])]), F.col("trx_date"))
        named = states.withColumns({DAY: F.col("trx_date"), PRINT: name}).hint("rebalance", DAY)
        named.write.partitionBy(DAY, PRINT).parquet(f"{path}/{folder}")
        folders |= {day: f"{folder}/{DAY}={day}/{PRINT}={prints[day]}" for day in changed}
    if folders != base.folders:
        snapshots.commit(path, base, folders, create)
    return tuple(changed)


def _states(rows: DataFrame, keys: Mapping[str, DataFrame], days: list[date]) -> DataFrame:
    """One row for each (day, account, transaction id) of ``days``; the first of them bounds the scan."""
    some = rows.where(since("txn_date", days[0]) & F.col("trx_date").isin(*days))
    held = {route: frame.where(F.col("feed_date").isin(*days)) for route, frame in keys.items()}
    flagged = flag_matches(some, held).drop("issuer_txn_ref", "txn_extref")
    picked = first_of_transaction(flagged, "trx_date")
    return picked.select("account_id", "merch_name", "txn_date", "trx_date", "credit_trans_trx_id", "amount_base", "is_matched")


def settled_rows(spark: SparkSession, path: str, params: Params) -> DataFrame:
    """De-duplicated rows of the ledger's window, merged from the states of its days."""
    first = params.days_back(params.ledger_days)
    folders = [f"{path}/{f}" for day, f in sorted(snapshots.manifest(path).folders.items()) if day >= first]
    if not folders:
        return spark.createDataFrame([], STATE)
    stored = spark.read.schema(STATE).option("recursiveFileLookup", "true").parquet(*folders)
    return deduplicate_transactions(stored)


def report_from_state(inputs: Inputs, params: Params, path: str) -> DataFrame:
    """The settlement report, row for row, with the matching taken from the states at ``path``.

    Call :func:`advance` first; the report is that of the ledger and feeds it saw. An ``as_of`` later
    than it had may miss ledger days, one earlier finds days that had left the window missing.
    """
    merchants = merchant_dimension(inputs.merchants, inputs.rates, params).where(referral_in_scope(params))
    totals = cut(daily_totals(settled_rows(inputs.ledger.sparkSession, path, params), merchants, params))
    ops = recent_ops(inputs.ops_balances, params)
    days = lay_out(totals, measures_of(inputs, params), ops, inputs, params, last_reported_day(params))
    return report_rows(settlements(days, params), inputs.bank_accounts, params)
