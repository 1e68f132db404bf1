"""Engine inputs derived from the benchmark tables ``events``, ``customer`` and ``nation``.

Every event is one ledger row and every customer one merchant account. The
feeds hold all events but signups, by type and value band, and the bands
overlap; a feed's timestamp runs five hours late, so that transactions from
19:00 on carry the next date and stay unmatched. ``k`` is the number in
``props``. ``testbed/oracle.py`` states the same in SQL.
"""

from datetime import date, timedelta
from decimal import Decimal
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.columns import MONEY
from ledgerline.operators.ledger import signed_ledger
from ledgerline.operators.recon import FEEDS
from ledgerline.plans.params import Params
from ledgerline.plans.rates import in_scope, rate_card
from ledgerline.sources import schemas
from ledgerline.sources.inputs import Inputs, conform_inputs
from ledgerline.sources.literal import literal_table

AS_OF = date(2024, 1, 30)
HOLIDAYS = (date(2023, 12, 25), date(2024, 1, 1), date(2024, 1, 18))
KNOWN = (date(2023, 1, 1), date(2024, 12, 31))

PARAMS = Params(
    as_of=AS_OF,
    first_trx_until=timedelta(minutes=30),
    weekday_opening_until=timedelta(minutes=20),
    holiday_carry_until=timedelta(minutes=45),
    excluded_vendor=7,
    excluded_accounts=(3, 5),
    excluded_referrals=("FURNITURE",),
    voucher_issuers=("signup",),
)
ACCOUNT_RATES = {10: Decimal("0"), 20: Decimal("0")}
REFERRAL_RATES = {"AUTOMOBILE": Decimal("0.02"), "BUILDING": Decimal("0.012")}

# Feed -> (event type, lowest value, value it stays below, raw key expression).
TEXT_ID = "cast(event_id as string)"
EXTREF = f"lpad({TEXT_ID}, 12, '0')"
ISSUER_REF = f"concat('T', lpad({TEXT_ID}, 17, '0'))"
FEED_EVENTS = {
    "linkaja_msme": ("view", 0, 20, ISSUER_REF),
    "linkaja_mcd": ("purchase", 0, 1000000, f"concat('A', {TEXT_ID}, '_payment')"),
    "linkaja_expansion": ("view", 15, 40, ISSUER_REF),
    "bni": ("click", 0, 25, TEXT_ID),
    "shopeepay": ("error", 0, 15, EXTREF),
    "mandiri": ("error", 10, 25, EXTREF),
    "ovo": ("view", 30, 1000000, f"concat('INV-', {ISSUER_REF})"),
    "kredivo": ("error", 20, 45, EXTREF),
    "indodana": ("error", 40, 70, EXTREF),
    "bca": ("error", 60, 1000000, EXTREF),
    "btn": ("click", 20, 60, "event_id"),
    "ottopay": ("click", 50, 110, EXTREF),
    "ottopay_dashboard": ("click", 100, 1000000, EXTREF),
}


SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_orderdate timestamp_ntz",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
}


@lru_cache(maxsize=16)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").withColumn("k", k)


def ledger_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ledger as it arrives: amounts as text, names in capitals, 'error' rows twice, ids of terminal 42 missing."""
    names = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_name")
    rows = (
        events(spark, sf_dir)
        .join(names, "user_id", "left")
        .selectExpr(
            "user_id as account_id",
            "cast(user_id as string) as merchant_id",
            "c_name as merch_name",
            "ts as txn_date",
            "event_type as issuer",
            """case when k < 6 then 'Emoney Reversal' when k < 10 then 'Other'
                    else 'Customer Purchase' end as txn_type""",
            "cast(cast(cast(value as decimal(18,2)) * 1000 as decimal(18,2)) as string) as AMT",
            f"if(k <> 42, {TEXT_ID}, null) as CREDIT_TRANS_TRX_ID",
            f"{ISSUER_REF} as issuer_txn_ref",
            f"{EXTREF} as txn_extref",
            f"{TEXT_ID} as txn_ref",
            "cast(k as string) as terminal_id",
        )
    )
    return rows.unionByName(rows.where("issuer = 'error'"))


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schemas.conform(ledger_source(spark, sf_dir), schemas.LEDGER)


def merchants(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey as account_id",
        "case when c_mktsegment <> 'MACHINERY' then c_mktsegment end as referral_code_acquisition",
        "c_mktsegment as vendor_type",
        "case when c_nationkey <> 24 then c_nationkey end as vendor_id",
    )
    return schemas.conform(rows, schemas.MERCHANTS)


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").selectExpr(f"{TEXT_ID} as trx_id", "ts as trx_date")
    return schemas.conform(rows, schemas.TRANSACTIONS)


def card_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One approval code per purchase, and a second one where ``k`` is below 10."""
    codes = f"""explode(if(k < 10, array(concat('A', {TEXT_ID}), concat('B', {TEXT_ID})),
                        array(concat('A', {TEXT_ID})))) as approval_code"""
    rows = (
        events(spark, sf_dir)
        .where("event_type = 'purchase'")
        .selectExpr("event_id as yt_ref", codes, "ts as transaction_date")
    )
    return schemas.conform(rows, schemas.CARD_REFS)


#: A feed that calls its key by another name, and sends its times as text, some of them unreadable.
RENAMED = {"bni": {"reff_id": "reff_no"}}


def feed_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    source = table(spark, sf_dir, "events")
    out = {}
    for spec in FEEDS:
        event_type, low, high, key = FEED_EVENTS[spec.name]
        kind = F.col("event_type") == event_type
        band = (F.col("value") >= low) & (F.col("value") < high)
        out[spec.name] = source.where(kind & band).selectExpr(
            f"{key} as {RENAMED.get(spec.name, {}).get(spec.key, spec.key)}", f"ts + interval 5 hours as {spec.timestamp}"
        )
    name = next(spec.timestamp for spec in FEEDS if spec.name == "bni")
    late = out["bni"].withColumn(name, F.col(name).cast("string"))
    out["bni"] = late.unionByName(late.withColumn(name, F.lit("not a time")))
    return out


def feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return dict(inputs(spark, sf_dir).feeds)


def bank_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No bank for customers with a negative balance, two for those of nations 0 to 5."""
    nation = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    rows = (
        table(spark, sf_dir, "customer")
        .where("c_acctbal >= 0")
        .join(nation, "c_nationkey", "left")
        .selectExpr(
            "c_custkey as account_id",
            """explode(if(c_nationkey < 6, array(n_name, 'AAA BANK'), array(n_name))) as bank_name""",
            "c_name as bank_account_name",
            "concat(c_custkey, '.0') as bank_account_number",
            "cast(c_nationkey as string) as bank_code",
        )
    )
    return schemas.conform(rows, schemas.BANK_ACCOUNTS)


def ops_balances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matched sum of each account-day, off by 500 for rich customers, missing for nations 11 and 12.

    Nations 0 to 5 report twice; the later row must be ignored.
    """
    owners = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("account_id"), "c_nationkey", "c_acctbal"
    )
    scope = merchants(spark, sf_dir).where(in_scope(PARAMS)).select("account_id")
    on_time = F.when((F.col("issuer") != "signup") & (F.hour("txn_date") < 19), F.col("amount_base"))
    rows = (
        signed_ledger(ledger(spark, sf_dir), PARAMS)
        .groupBy("account_id", "trx_date")
        .agg(F.coalesce(F.sum(on_time), F.lit(0)).cast(MONEY).alias("matched"))
        .join(scope, "account_id")
        .join(owners, "account_id")
        .where("c_nationkey not in (11, 12)")
        .withColumn("late", F.expr("explode(if(c_nationkey < 6, array(0, 1), array(0)))"))
        .selectExpr(
            "account_id",
            "matched + if(c_acctbal >= 6000, 500, 0) + late as balance",
            "cast(date_add(trx_date, 1) as timestamp_ntz) as created_date",
            """cast(date_add(trx_date, 1) as timestamp_ntz) + interval 8 hours
               + late * interval 1 hour as processed_dttm""",
        )
    )
    return schemas.conform(rows, schemas.OPS_BALANCES)


def input_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "ledger": ledger_source(spark, sf_dir),
        "merchants": merchants(spark, sf_dir),
        "transactions": transactions(spark, sf_dir),
        "card_refs": card_refs(spark, sf_dir),
        "bank_accounts": bank_accounts(spark, sf_dir),
        "ops_balances": ops_balances(spark, sf_dir),
        "public_holidays": public_holidays(spark),
        "holiday_coverage": literal_table(spark, schemas.HOLIDAY_COVERAGE, [KNOWN]),
        "rates": repeated_rules(spark),
    }


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    return conform_inputs(spark, input_tables(spark, sf_dir), feed_sources(spark, sf_dir), PARAMS, RENAMED)


def public_holidays(spark: SparkSession) -> DataFrame:
    return literal_table(spark, schemas.HOLIDAYS, [(d,) for d in HOLIDAYS])


def repeated_rules(spark: SparkSession) -> DataFrame:
    """The rate card, and after it a second rule for every key, with zeros before account numbers, and one for no account, which must change nothing."""
    rules = rate_card(spark, ACCOUNT_RATES, REFERRAL_RATES)
    zeros = F.when(F.col("kind") == "account", F.concat(F.lit("00"), "key")).otherwise(F.col("key"))
    again = rules.withColumns({"place": F.col("place") + 100, "key": zeros, "rate": F.lit("0.05").cast(schemas.RATE)})
    nobody = literal_table(spark, schemas.RATES, [(999, "account", "x1", Decimal("0.05"))])
    return rules.unionByName(again).unionByName(nobody)
