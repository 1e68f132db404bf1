"""Declared schemas of the inputs and the report, and the boundary that enforces them."""

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LONG, TEXT, DOUBLE, DATE, TIME = (
    T.LongType(),
    T.StringType(),
    T.DoubleType(),
    T.DateType(),
    T.TimestampNTZType(),
)
AMOUNT, MONEY, RATE = T.DecimalType(18, 4), T.DecimalType(20, 4), T.DecimalType(5, 4)


def _schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


LEDGER = _schema(
    account_id=LONG,
    merchant_id=TEXT,
    merch_name=TEXT,
    txn_date=TIME,
    issuer=TEXT,
    txn_type=TEXT,
    amt=AMOUNT,
    credit_trans_trx_id=TEXT,
    issuer_txn_ref=TEXT,
    txn_extref=TEXT,
    txn_ref=TEXT,
    terminal_id=TEXT,
)
MERCHANTS = _schema(
    account_id=LONG, referral_code_acquisition=TEXT, vendor_type=TEXT, vendor_id=LONG
)
TRANSACTIONS = _schema(trx_id=TEXT, trx_date=TIME)
CARD_REFS = _schema(yt_ref=TEXT, approval_code=TEXT, transaction_date=TIME)
BANK_ACCOUNTS = _schema(
    account_id=LONG,
    bank_name=TEXT,
    bank_account_name=TEXT,
    bank_account_number=TEXT,
    bank_code=TEXT,
)
OPS_BALANCES = _schema(account_id=LONG, balance=MONEY, created_date=TIME, processed_dttm=TIME)
HOLIDAYS = _schema(holiday_date=DATE)
#: For which days the holidays are known, both ends included.
HOLIDAY_COVERAGE = _schema(known_from=DATE, known_to=DATE)
#: ``place`` orders the rules; the first of those with one kind and key holds.
RATES = _schema(place=LONG, kind=TEXT, key=TEXT, rate=RATE)

# The columns that the report reads of the six extracts.
BASE_EXTRACT = _schema(
    account_id=LONG,
    credit_trans_trx_id=TEXT,
    merch_name=TEXT,
    txn_date=TIME,
    referral_code_acquisition=TEXT,
    key_join_issuer=TEXT,
    amount_base=AMOUNT,
    mdr_rate=RATE,
)
VOUCHER_EXTRACT = _schema(account_id=LONG, txn_date=TIME, amount_base=AMOUNT)
OPENING_EXTRACT = _schema(account_id=LONG, trx_date=TIME, amount=MONEY)
FIRST_EXTRACT = _schema(account_id=LONG, txn_date=TIME, amount=MONEY)

REPORT = _schema(
    balance_date=DATE,
    account_id=LONG,
    merch_name=TEXT,
    carry_over_balance=DOUBLE,
    total_gross_transaction=DOUBLE,
    total_gross_balance=DOUBLE,
    gross_difference=DOUBLE,
    first_trx=DOUBLE,
    trx_00_amt=DOUBLE,
    amount_voucher=DOUBLE,
    amount_final=DOUBLE,
    balance_final=DOUBLE,
    total_mdr=DOUBLE,
    total_net_trx=DOUBLE,
    amount_to_transfer=DOUBLE,
    confirm_to_transfer=TEXT,
    bank_account_name=TEXT,
    bank_account_number=TEXT,
    bank_code=TEXT,
    bank_name=TEXT,
    total_traffic_not_match=DOUBLE,
    total_gross_transaction_not_match=DOUBLE,
    total_mdr_not_match=DOUBLE,
    total_amount_to_transfer_not_match=DOUBLE,
)

# As stored: the account id is text.
STORED_REPORT = T.StructType(
    [T.StructField(f.name, T.StringType() if f.name == "account_id" else f.dataType) for f in REPORT]
)


#: What a float may differ from its decimal form before digits count as lost.
FLOAT_NOISE = "0.0000001"


def _whole(c: Column, source: T.DataType, target: T.DecimalType) -> Column:
    """As a decimal of the target's scale. Digits beyond it are an error, not rounded away in silence."""
    wide = c.try_cast(T.DecimalType(38, 14))
    near = wide.cast(T.DecimalType(38, target.scale))
    noise = FLOAT_NOISE if isinstance(source, (T.DoubleType, T.FloatType)) else "0"
    lost = F.abs(wide - near) > F.lit(noise).cast(T.DecimalType(38, 14))
    message = F.concat(F.lit(f"more than {target.scale} decimals: "), c.cast("string"))
    return F.when(lost, F.raise_error(message).cast(target)).otherwise(near.cast(target))


def _conformed(c: Column, source: T.DataType, target: T.DataType, zone: str = "UTC") -> Column:
    """Cast to the declared type. Text or floats that hold no such value become null;
    a number that is too large or too fine for the type is an error, not a null.
    A timestamp with a zone becomes the local time of ``zone``, whatever the session's zone is."""
    if source == target:
        return c
    if isinstance(source, T.TimestampType) and isinstance(target, (T.TimestampNTZType, T.DateType)):
        return F.convert_timezone(F.current_timezone(), F.lit(zone), c.cast("timestamp_ntz")).cast(target)
    if isinstance(target, T.DecimalType) and isinstance(source, T.DecimalType) and source.scale > target.scale:
        return _whole(c, source, target)
    if isinstance(source, (T.StringType, T.DoubleType, T.FloatType)):
        if isinstance(target, T.DecimalType):
            return _whole(c, source, target)
        if isinstance(target, T.LongType):
            return c.try_cast(T.DecimalType(38, 4)).cast(target)
        return c.try_cast(target)
    return c.cast(target)


def _source_columns(df: DataFrame, schema: T.StructType, rename: Mapping[str, str] | None) -> dict[str, tuple[str, T.DataType]]:
    """Declared column -> its name and type in ``df``, whatever its case; one that is missing is an error."""
    held = {f.name.lower(): f for f in df.schema}
    names = {f.name: (rename or {}).get(f.name, f.name) for f in schema}
    missing = [n for n in names.values() if n.lower() not in held]
    if missing:
        raise ValueError(f"missing input columns: {missing}")
    return {declared: (held[name.lower()].name, held[name.lower()].dataType) for declared, name in names.items()}


def conform(
    df: DataFrame, schema: T.StructType, rename: Mapping[str, str] | None = None, zone: str = "UTC"
) -> DataFrame:
    """Select the declared columns, whatever their case, with the declared types.

    ``rename`` maps a declared name to the name the table uses. A declared
    column that is missing is an error.
    """
    source = _source_columns(df, schema, rename)
    return df.select(*[_conformed(F.col(source[f.name][0]), source[f.name][1], f.dataType, zone).alias(f.name) for f in schema])


def unreadable(df: DataFrame, schema: T.StructType, rename: Mapping[str, str] | None = None) -> DataFrame:
    """What :func:`conform` turns into null although there is something: (column_name, value, n_rows).

    ``column_name`` is the table's own, ``value`` what it holds, as text; a float that is no number counts too.
    One scan of the columns that can hold such values, summed up before the shuffle. Values
    that fail a run (too many digits) are not looked for.
    """
    lost = []
    for f in schema:
        name, kind = _source_columns(df, T.StructType([f]), rename)[f.name]
        if isinstance(kind, (T.StringType, T.DoubleType, T.FloatType)) and kind != f.dataType and f.dataType != TEXT:
            numeric = T.DecimalType(38, 14) if isinstance(f.dataType, T.DecimalType) else T.DecimalType(38, 4)
            read = F.col(name).try_cast(numeric if isinstance(f.dataType, (T.DecimalType, T.LongType)) else f.dataType)
            bad = F.col(name).isNotNull() & read.isNull()
            lost.append(F.when(bad, F.struct(F.lit(name).alias("column_name"), F.col(name).cast("string").alias("value"))))
    if not lost:
        return df.sparkSession.createDataFrame([], "column_name string, value string, n_rows bigint")
    found = df.select(F.explode(F.array_compact(F.array(*lost))).alias("found")).select("found.*")
    return found.groupBy("column_name", "value").agg(F.count("*").alias("n_rows"))
