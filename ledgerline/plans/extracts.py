"""The report from six extracts, for those who already have them as tables.

``extracts`` builds them from the inputs, row by row as they are exchanged;
``report_from_extracts`` settles them. ``settlement_report`` gives the same
report without building them and is the one to run on large ledgers.
"""

from dataclasses import dataclass, fields, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.columns import AMOUNT, MONEY, RATE, or_zero
from ledgerline.operators.amounts import first_transactions, voucher_rows, weekday_opening_totals
from ledgerline.operators.batches import settlements
from ledgerline.operators.daily import daily_totals_of_priced_rows
from ledgerline.operators.ledger import signed_ledger, with_merchants
from ledgerline.operators.pick import deduplicate_transactions
from ledgerline.operators.recon import approval_codes, with_match_key
from ledgerline.operators.report import report_rows
from ledgerline.plans.params import Params
from ledgerline.plans.rates import merchant_dimension, referral_in_scope
from ledgerline.plans.settlement import HolidaySource, last_reported_day, lay_out, match_keys, recent_ops
from ledgerline.sources import schemas
from ledgerline.sources.cuts import cut
from ledgerline.sources.inputs import Inputs


@dataclass(frozen=True)
class Extracts:
    base: DataFrame
    vouchers: DataFrame
    bank_accounts: DataFrame
    ops_balances: DataFrame
    first_trx: DataFrame
    trx_00: DataFrame


# The columns of the base extract.
BASE_COLUMNS = (
    "key_join_issuer",
    "txn_date",
    "trx_date",
    "issuer",
    "account_id",
    "merchant_id",
    "merch_name",
    "referral_code_acquisition",
    "vendor_type",
    "txn_extref",
    "txn_ref",
    "issuer_txn_ref",
    "mcd_approval_code",
    "credit_trans_trx_id",
    "terminal_id",
    "txn_type",
    "amt",
    "amount_base",
    "mdr_rate",
)


def scoped_rows(inputs: Inputs, params: Params) -> DataFrame:
    """Ledger rows in scope with their rate: the rows of the base extract before any look-up."""
    merchants = merchant_dimension(inputs.merchants, inputs.rates, params)
    return with_merchants(signed_ledger(inputs.ledger, params), merchants)


def base_rows(inputs: Inputs, params: Params, all_codes: bool = True) -> DataFrame:
    """Ledger rows in scope with rate and match key, in the layout of the base extract.

    ``all_codes`` shows the approval code of unmatched rows too, at the cost of a join.
    """
    codes = approval_codes(inputs.transactions, inputs.card_refs, params) if all_codes else None
    return with_match_key(scoped_rows(inputs, params), match_keys(inputs, params), codes).select(*BASE_COLUMNS)


def extracts(inputs: Inputs, params: Params, all_codes: bool = True) -> Extracts:
    merchants = merchant_dimension(inputs.merchants, inputs.rates, params)
    return Extracts(
        base=base_rows(inputs, params, all_codes),
        vouchers=voucher_rows(inputs.ledger, merchants, params),
        bank_accounts=inputs.bank_accounts,
        ops_balances=recent_ops(inputs.ops_balances, params),
        first_trx=first_transactions(inputs.ledger, merchants, params),
        trx_00=with_merchants(weekday_opening_totals(inputs.ledger, params), merchants).select(
            "account_id", "trx_date", "amount"
        ),
    )


def extract_counts(inputs: Inputs, params: Params) -> DataFrame:
    """Row count of every extract: (extract, n_rows). No look-up adds or drops a base row, so none is made."""
    given = replace(extracts(inputs, params), base=scoped_rows(inputs, params))
    counts = [
        getattr(given, f.name).select(F.lit(f.name).alias("extract")).groupBy("extract").agg(
            F.count("*").alias("n_rows")
        )
        for f in fields(given)
    ]
    return reduce(DataFrame.unionByName, counts)


def settled_rows(base: DataFrame, params: Params) -> DataFrame:
    """Base rows, one per (account, transaction id), without the excluded referrals."""
    rows = schemas.conform(base, schemas.BASE_EXTRACT, zone=params.zone).select(
        "account_id",
        "credit_trans_trx_id",
        "merch_name",
        "txn_date",
        "referral_code_acquisition",
        F.col("key_join_issuer").isNotNull().alias("is_matched"),
        or_zero(F.col("amount_base"), AMOUNT).alias("amount_base"),
        F.coalesce("mdr_rate", F.lit(params.default_rate)).cast(RATE).alias("mdr_rate"),
    )
    return deduplicate_transactions(rows.where(referral_in_scope(params)))


def measures_of(given: Extracts, params: Params) -> DataFrame:
    """Voucher, midnight and first-transaction amounts per (account, balance_date)."""
    none = F.lit(None).cast(MONEY)

    def booked(df: DataFrame, day, **amount) -> DataFrame:
        names = ("amount_voucher", "trx_00_amt", "first_trx")
        return df.select("account_id", day.alias("balance_date"), *[amount.get(n, none).alias(n) for n in names])

    def read(df: DataFrame, schema) -> DataFrame:
        return schemas.conform(df, schema, zone=params.zone)

    money = F.col("amount").cast(MONEY)
    return (
        booked(
            read(given.vouchers, schemas.VOUCHER_EXTRACT),
            F.date_add(F.to_date("txn_date"), 1),
            amount_voucher=F.col("amount_base").cast(MONEY),
        )
        .unionByName(booked(read(given.trx_00, schemas.OPENING_EXTRACT), F.to_date("trx_date"), trx_00_amt=money))
        .unionByName(booked(read(given.first_trx, schemas.FIRST_EXTRACT), F.date_sub(F.to_date("txn_date"), 1), first_trx=money))
        .groupBy("account_id", "balance_date")
        .agg(*[F.sum(n).cast(MONEY).alias(n) for n in ("amount_voucher", "trx_00_amt", "first_trx")])
    )


def report_from_extracts(given: Extracts, calendar: HolidaySource, params: Params) -> DataFrame:
    totals = cut(daily_totals_of_priced_rows(settled_rows(given.base, params), params))
    until = last_reported_day(params)
    ops = schemas.conform(given.ops_balances, schemas.OPS_BALANCES, zone=params.zone)
    banks = schemas.conform(given.bank_accounts, schemas.BANK_ACCOUNTS)
    days = lay_out(totals, measures_of(given, params), ops, calendar, params, until)
    return report_rows(settlements(days, params), banks, params)
