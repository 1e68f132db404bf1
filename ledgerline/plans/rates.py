"""Fee rates and account exclusions, as joins against small tables."""

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.columns import RATE
from ledgerline.plans import fixed_values as house
from ledgerline.plans.params import Params
from ledgerline.sources.literal import literal_table
from ledgerline.sources.schemas import RATES


def rate_card(
    spark: SparkSession,
    accounts: Mapping[int, Decimal] = house.ACCOUNT_RATES,
    referrals: Mapping[str, Decimal] = house.REFERRAL_RATES,
) -> DataFrame:
    rules = [("account", str(k), v) for k, v in accounts.items()]
    rules += [("referral", k, v) for k, v in referrals.items()]
    return literal_table(spark, RATES, [(place, *rule) for place, rule in enumerate(rules)])


def with_rates(merchants: DataFrame, rates: DataFrame, params: Params) -> DataFrame:
    """Add ``mdr_rate``: the account's first rule, else its referral's first, else the default.

    Account keys count as numbers, so ``007`` and ``7`` are one; a key that is no number names no account.
    """
    first = F.min(F.struct("place", "rate"))["rate"]
    account = F.col("key").try_cast("decimal(38,0)").try_cast("bigint").alias("account_id")
    by_account = rates.where("kind = 'account'").groupBy(account).agg(first.alias("_account_rate"))
    referral = F.col("key").alias("referral_code_acquisition")
    by_referral = rates.where("kind = 'referral'").groupBy(referral).agg(first.alias("_referral_rate"))
    rate = F.coalesce("_account_rate", "_referral_rate", F.lit(params.default_rate).cast(RATE))
    return (
        merchants.join(by_account, "account_id", "left")
        .join(by_referral, "referral_code_acquisition", "left")
        .withColumn("mdr_rate", rate.cast(RATE))
        .drop("_account_rate", "_referral_rate")
    )


def in_scope(params: Params) -> Column:
    """Vendor and account exclusions. An unknown vendor is out, as in SQL."""
    return (F.col("vendor_id") != params.excluded_vendor) & ~F.col("account_id").isin(
        *params.excluded_accounts
    )


def referral_in_scope(params: Params) -> Column:
    """Referral exclusions. An unknown referral stays in."""
    referral = F.col("referral_code_acquisition")
    return referral.isNull() | ~referral.isin(*params.excluded_referrals)


def one_row_per_account(merchants: DataFrame) -> DataFrame:
    """Fail the job when an account occurs twice, since that would double its amounts."""
    once = F.count("*") == 1
    message = F.concat(F.lit("merchant account occurs twice: "), F.col("account_id").cast("string"))

    def only(c: str) -> Column:
        return F.when(once, F.max(c)).otherwise(F.raise_error(message)).alias(c)

    return (
        merchants.where(F.col("account_id").isNotNull())
        .groupBy("account_id")
        .agg(only("referral_code_acquisition"), only("vendor_type"), only("vendor_id"))
    )


def merchant_dimension(merchants: DataFrame, rates: DataFrame, params: Params) -> DataFrame:
    """In-scope accounts with referral and rate, one row each."""
    unique = one_row_per_account(merchants).where(in_scope(params))
    return with_rates(unique, rates, params)
