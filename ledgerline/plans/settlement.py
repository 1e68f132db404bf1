"""The settlement plan: inputs to report."""

from datetime import date
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import since
from ledgerline.operators.amounts import day_measures
from ledgerline.operators.batches import settlements
from ledgerline.operators.daily import (
    account_days,
    daily_totals,
    ops_by_balance_date,
    spine_bounds,
    spine_days,
)
from ledgerline.operators.ledger import flag_accounts, prune_accounts, signed_ledger
from ledgerline.operators.pick import deduplicate_transactions
from ledgerline.operators.recon import flag_matches, keys_by_route
from ledgerline.operators.report import report_rows
from ledgerline.plans.calendar import settlement_calendar
from ledgerline.plans.counts import InputCounts
from ledgerline.plans.params import Params
from ledgerline.plans.rates import merchant_dimension, one_row_per_account, referral_in_scope
from ledgerline.sources.cuts import cut
from ledgerline.sources.inputs import Inputs


class HolidaySource(Protocol):
    """The holidays, and the intervals for which they are known; without those it is taken that they are."""

    holidays: DataFrame
    holidays_known: DataFrame | None


#: Ledger columns that matching, de-duplication and daily sums read.
READ_LATER = ("account_id", "merch_name", "txn_date", "trx_date", "credit_trans_trx_id", "issuer_txn_ref", "txn_extref", "amount_base")


def match_keys(inputs: Inputs, params: Params) -> dict[str, DataFrame]:
    return keys_by_route(inputs.feeds, inputs.transactions, inputs.card_refs, params)


def matched_rows(inputs: Inputs, params: Params, counts: InputCounts | None = None) -> DataFrame:
    """De-duplicated ledger rows with their match flag, reduced to the columns read later."""
    if counts is None:
        rows = signed_ledger(prune_accounts(inputs.ledger, inputs.merchants, params), params).select(*READ_LATER)
    else:
        # The base extract has the rows of excluded referrals too, so those go after it was counted.
        scope = one_row_per_account(inputs.merchants)
        rows = signed_ledger(flag_accounts(inputs.ledger, scope, params), params).select(*READ_LATER, "settles")
        rows = counts.seen(rows, base=F.count("*")).where("settles").drop("settles")
    flagged = flag_matches(rows, match_keys(inputs, params))
    return deduplicate_transactions(flagged.drop("issuer_txn_ref", "txn_extref"))


def daily(inputs: Inputs, params: Params, counts: InputCounts | None = None) -> DataFrame:
    """Daily sums of the accounts in scope."""
    merchants = merchant_dimension(inputs.merchants, inputs.rates, params)
    return daily_totals(
        matched_rows(inputs, params, counts), merchants.where(referral_in_scope(params)), params
    )


def lay_out(
    totals: DataFrame,
    measures: DataFrame,
    ops: DataFrame,
    inputs: HolidaySource,
    params: Params,
    until: date | None = None,
) -> DataFrame:
    """The account-day relation over the days that ``totals`` spans plus the tail, or ``until``."""
    first, last = spine_bounds(totals, params, until)
    calendar = settlement_calendar(inputs.holidays, first, last, inputs.holidays_known)
    spine = spine_days(totals, first, last, measures, ops_by_balance_date(ops))
    return account_days(spine, calendar, params)


def recent_ops(ops_balances: DataFrame, params: Params) -> DataFrame:
    return ops_balances.where(since("processed_dttm", params.days_back(params.ops_days)))


def measures_of(inputs: Inputs, params: Params, counts: InputCounts | None = None) -> DataFrame:
    """Ledger measures per account and day; to be counted they are reduced to the accounts in scope first."""
    if counts is None:
        return day_measures(inputs.ledger, params)
    scope = merchant_dimension(inputs.merchants, inputs.rates, params).select("account_id")
    measures = day_measures(inputs.ledger, params, row_counts=True).join(scope, "account_id", "left_semi")
    return counts.seen(
        measures, vouchers=F.sum("voucher_rows"), first_trx=F.count("first_trx"), trx_00=F.count("trx_00_amt")
    ).drop("voucher_rows")


def days_of(
    inputs: Inputs, params: Params, until: date | None = None, counts: InputCounts | None = None
) -> DataFrame:
    """The account-day relation.

    The daily sums are the end of the large part of the job and are read three
    times (date bounds, account list, spine), so the plan is cut there.
    """
    ops = recent_ops(inputs.ops_balances, params)
    if counts:
        ops = counts.seen(ops, ops_balances=F.count("*"))
    return lay_out(
        cut(daily(inputs, params, counts)),
        measures_of(inputs, params, counts),
        ops,
        inputs,
        params,
        until,
    )


def last_reported_day(params: Params) -> date:
    """Batches only look back, so days that settle after ``as_of`` cannot change the report.

    This bounds the spine, also when a ledger row carries a date far in the future.
    """
    return params.days_back(1)


def settlement_report(inputs: Inputs, params: Params, counts: InputCounts | None = None) -> DataFrame:
    """The report. With ``counts`` the rows of the six extracts are counted on the way, by the same jobs."""
    days = days_of(inputs, params, last_reported_day(params), counts)
    banks = inputs.bank_accounts
    if counts:
        banks = counts.seen(banks, bank_accounts=F.count("*"))
    return report_rows(settlements(days, params), banks, params)
