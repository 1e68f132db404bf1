"""The input tables of a run."""

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.recon import FEEDS
from ledgerline.plans.calendar import holiday_table
from ledgerline.plans.params import Params
from ledgerline.plans.rates import rate_card
from ledgerline.sources import schemas


@dataclass(frozen=True)
class Inputs:
    ledger: DataFrame
    merchants: DataFrame
    transactions: DataFrame
    card_refs: DataFrame
    feeds: Mapping[str, DataFrame]
    bank_accounts: DataFrame
    ops_balances: DataFrame
    holidays: DataFrame
    rates: DataFrame
    holidays_known: DataFrame | None = None


DECLARED = {
    "ledger": schemas.LEDGER,
    "merchants": schemas.MERCHANTS,
    "transactions": schemas.TRANSACTIONS,
    "card_refs": schemas.CARD_REFS,
    "bank_accounts": schemas.BANK_ACCOUNTS,
    "ops_balances": schemas.OPS_BALANCES,
}


def conform_inputs(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    feeds: Mapping[str, DataFrame],
    params: Params,
    rename: Mapping[str, Mapping[str, str]] | None = None,
    stored_by: Mapping[str, str] | None = None,
) -> Inputs:
    """Bind source tables to the declared schemas.

    ``tables`` holds the declared tables, ``public_holidays`` and ``holiday_coverage`` by name, optionally with
    ``rates``; without it the house rules alone apply. All feeds must be there: a feed
    left out would make its transactions look unmatched. So must the holidays, and the intervals
    for which they are known: a run that needs another day fails, since a day
    missing there would pass as a settlement day.
    ``rename`` maps table or feed -> {declared column: source column}. ``stored_by`` maps
    a table or feed to the date column it is partitioned by, which holds the date
    of its timestamp; partitions before the table's window are then not listed.
    """
    wanted = {feed.name for feed in FEEDS}
    if set(feeds) != wanted:
        raise ValueError(f"missing feeds {wanted - set(feeds)}, unknown feeds {set(feeds) - wanted}")
    for needed in ("public_holidays", "holiday_coverage"):
        if needed not in tables:
            raise ValueError(f"missing table {needed}")
    rename, stored_by = rename or {}, stored_by or {}

    def recent(name: str, df: DataFrame) -> DataFrame:
        if name not in stored_by:
            return df
        return df.where(F.col(stored_by[name]) >= F.lit(params.first_day(name)))

    bound = {
        n: schemas.conform(recent(n, tables[n]), schema, rename.get(n), params.zone) for n, schema in DECLARED.items()
    }
    public = schemas.conform(tables["public_holidays"], schemas.HOLIDAYS, rename.get("public_holidays"), params.zone)
    known = schemas.conform(tables["holiday_coverage"], schemas.HOLIDAY_COVERAGE, rename.get("holiday_coverage"), params.zone)
    rates = tables.get("rates")
    return Inputs(
        feeds={
            f.name: schemas.conform(recent(f.name, feeds[f.name]), f.schema, rename.get(f.name), params.zone) for f in FEEDS
        },
        holidays=holiday_table(spark, public),
        holidays_known=known,
        rates=rate_card(spark) if rates is None else schemas.conform(rates, schemas.RATES, rename.get("rates")),
        **bound,
    )


def unreadable_values(
    tables: Mapping[str, DataFrame],
    feeds: Mapping[str, DataFrame],
    rename: Mapping[str, Mapping[str, str]] | None = None,
) -> DataFrame:
    """Values of all inputs that a run reads as null: (table_name, column_name, value, n_rows).

    Beside :func:`conform_inputs`, which has no place for them: a run goes on without such values, and
    this says which they were and in how many rows. Each table is scanned for its own columns alone.
    """
    rename = rename or {}
    declared = DECLARED | {"public_holidays": schemas.HOLIDAYS, "holiday_coverage": schemas.HOLIDAY_COVERAGE, "rates": schemas.RATES}
    given = [(n, df, declared[n]) for n, df in tables.items() if n in declared]
    given += [(f.name, feeds[f.name], f.schema) for f in FEEDS if f.name in feeds]
    each = [
        schemas.unreadable(df, schema, rename.get(name)).select(F.lit(name).alias("table_name"), "column_name", "value", "n_rows")
        for name, df, schema in given
    ]
    return reduce(DataFrame.unionByName, each)


def read_inputs(
    spark: SparkSession,
    tables: Mapping[str, str],
    feeds: Mapping[str, str],
    params: Params,
    rename: Mapping[str, Mapping[str, str]] | None = None,
    stored_by: Mapping[str, str] | None = None,
    fmt: str = "parquet",
) -> Inputs:
    """Like :func:`conform_inputs`, from locations: a path where there is a ``/``, else a table name."""

    def load(location: str) -> DataFrame:
        if "/" in location:
            return spark.read.format(fmt).load(location)
        return spark.table(location)

    return conform_inputs(
        spark,
        {n: load(x) for n, x in tables.items()},
        {n: load(x) for n, x in feeds.items()},
        params,
        rename,
        stored_by,
    )
