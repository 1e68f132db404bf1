"""Reconciliation: which ledger rows do the issuer feeds confirm?

Thirteen feeds reach the ledger by only three routes: the issuer reference, the
external reference, and the card approval code. Every feed is reduced to its
distinct (key, date) pairs, the feeds of a route are united, and each route is
one left join that cannot multiply rows. The card route is resolved to
transaction ids first.
"""

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.functions.columns import (
    held_key,
    invoice_reference,
    padded_reference,
    sequence_reference,
    since,
    sought_key,
)
from ledgerline.functions.filters import key_filter, may_hold
from ledgerline.plans.params import Params

ISSUER_REF = "issuer_ref"
APPROVAL = "approval"
EXTREF = "extref"


def _text(c: Column) -> Column:
    return c.cast("string")


@dataclass(frozen=True)
class Feed:
    """One feed: where it ranks, how it is keyed and dated.

    ``match`` turns the raw key into the form the ledger holds; ``reported`` is
    the form that is shown as the row's match key.
    """

    name: str
    priority: int
    route: str
    key: str
    timestamp: str
    match: Callable[[Column], Column] = _text
    reported: Callable[[Column], Column] | None = None

    @property
    def schema(self) -> T.StructType:
        """The two columns that a feed is read for, under its own names."""
        return T.StructType([T.StructField(self.key, T.StringType()), T.StructField(self.timestamp, T.TimestampNTZType())])

    def keys(self, df: DataFrame, params: Params) -> DataFrame:
        raw = F.col(self.key)
        recent = df.where(since(self.timestamp, params.days_back(params.ledger_days)))
        return recent.select(
            self.match(raw).alias("match_key"),
            F.to_date(self.timestamp).alias("feed_date"),
            F.lit(self.priority).alias("priority"),
            (self.reported or self.match)(raw).alias("reported_key"),
        ).where("match_key is not null")


# The issuer feeds in order of precedence, with their own column names.
FEEDS = (
    Feed("linkaja_msme", 1, ISSUER_REF, "ref_no", "transaction_date"),
    Feed("linkaja_mcd", 2, APPROVAL, "sequence_id", "transaction_date", sequence_reference),
    Feed("linkaja_expansion", 3, ISSUER_REF, "ref_no", "transaction_date"),
    Feed("bni", 4, EXTREF, "reff_id", "trx_datetime", padded_reference),
    Feed("shopeepay", 5, EXTREF, "transaction_id", "create_time"),
    Feed("mandiri", 6, EXTREF, "refference_number", "trxdate"),
    Feed("ovo", 7, ISSUER_REF, "merchantinvoice", "transactiondate", invoice_reference),
    Feed("kredivo", 8, EXTREF, "transaction_id", "transaction_date"),
    Feed("indodana", 9, EXTREF, "transidmerchant", "transaction_date"),
    Feed("bca", 10, EXTREF, "reference_no", "payment_date"),
    Feed("btn", 11, EXTREF, "retrieval_reference_number", "transaction_date", padded_reference, _text),
    Feed("ottopay", 12, EXTREF, "issuer_rrn", "transaction_time"),
    Feed("ottopay_dashboard", 13, EXTREF, "reference_number", "transaction_date"),
)


def route_keys(
    feeds: Mapping[str, DataFrame], route: str, params: Params, specs: Iterable[Feed] = FEEDS
) -> DataFrame:
    """All keys of one route: match_key, feed_date, priority, reported_key; not yet distinct."""
    parts = [
        spec.keys(feeds[spec.name], params)
        for spec in specs
        if spec.route == route and spec.name in feeds
    ]
    if not parts:
        raise ValueError(f"no feed for route {route}")
    return reduce(DataFrame.unionByName, parts)


def distinct_keys(keys: DataFrame) -> DataFrame:
    return keys.select("match_key", "feed_date").distinct()


def best_keys(keys: DataFrame) -> DataFrame:
    """The highest-ranking feed per (key, date)."""
    return keys.groupBy("match_key", "feed_date").agg(
        F.min(F.struct("priority", "reported_key")).alias("hit")
    )


def _recent_refs(card_refs: DataFrame, params: Params) -> DataFrame:
    recent = since("transaction_date", params.days_back(params.reference_days))
    return card_refs.where(recent).select(_text(F.col("yt_ref")).alias("trx_id"), "approval_code")


def _of_known(rows: DataFrame, transactions: DataFrame, params: Params) -> DataFrame:
    """Rows whose ``trx_id`` is a recent transaction.

    Both sides arrive summed up per transaction, so neither has a hot key here.
    """
    recent = since("trx_date", params.days_back(params.reference_days))
    return rows.join(transactions.where(recent).select("trx_id").distinct(), "trx_id", "left_semi")


def approval_codes(transactions: DataFrame, card_refs: DataFrame, params: Params) -> DataFrame:
    """The smallest approval code of every recent transaction that has one."""
    codes = _recent_refs(card_refs, params).groupBy("trx_id").agg(
        F.min("approval_code").alias("approval_code")
    )
    return _of_known(codes, transactions, params)


def card_keys(
    approval_keys: DataFrame, transactions: DataFrame, card_refs: DataFrame, params: Params
) -> DataFrame:
    """The approval route re-keyed by transaction id, so the ledger needs no card columns.

    Starts from the smallest input, the distinct keys of the feed. A transaction
    may have several approval codes; any of them counts. With ``reference_filter_bits`` a filter of
    the feed's keys drops references as they are read, and a filter of the references that are left drops
    transactions; the joins decide either way. A filter too small for its keys lets more rows through to them.
    """
    bits, refs = params.reference_filter_bits, _recent_refs(card_refs, params)
    if bits:
        refs = refs.where(may_hold(key_filter(approval_keys, "match_key", bits), F.col("approval_code"), bits))
        transactions = transactions.where(may_hold(key_filter(refs, "trx_id", bits), F.col("trx_id"), bits))
    held = approval_keys.distinct().select(
        held_key(F.col("match_key")).alias("_key"), "feed_date", "priority", "reported_key"
    )
    found = held.join(refs.withColumn("_key", held_key(F.col("approval_code"))), "_key").withColumnRenamed("trx_id", "match_key")
    best = best_keys(found).select(F.col("match_key").alias("trx_id"), "feed_date", "hit.*")
    return _of_known(best, transactions, params).withColumnRenamed("trx_id", "match_key")


def ledger_side(route: str) -> Column:
    """What the ledger is looked up by: a reference, or the transaction id for the card route."""
    if route == APPROVAL:
        return _text(F.col("credit_trans_trx_id"))
    return F.col({ISSUER_REF: "issuer_txn_ref", EXTREF: "txn_extref"}[route])


def keys_by_route(
    feeds: Mapping[str, DataFrame],
    transactions: DataFrame,
    card_refs: DataFrame,
    params: Params,
    specs: Iterable[Feed] = FEEDS,
) -> dict[str, DataFrame]:
    """Route -> all its keys, in the form the ledger holds them."""
    specs = tuple(specs)
    routes = sorted({spec.route for spec in specs if spec.name in feeds})
    out = {route: route_keys(feeds, route, params, specs) for route in routes}
    if APPROVAL in out:
        out[APPROVAL] = card_keys(out[APPROVAL], transactions, card_refs, params)
    return out


def look_up(rows: DataFrame, keys: DataFrame, key: Column, value: Column, name: str) -> DataFrame:
    """Add ``value`` of the ``keys`` row with the same key and date, or null.

    ``keys`` has at most one row per (match_key, feed_date).
    """
    found = keys.select(
        held_key(F.col("match_key")).alias("_key"),
        F.col("feed_date").alias("trx_date"),
        value.alias(name),
    )
    return (
        rows.withColumn("_key", sought_key(key, "account_id", "txn_date", "credit_trans_trx_id"))
        .join(found, ["_key", "trx_date"], "left")
        .drop("_key")
    )


def flag_matches(rows: DataFrame, keys: Mapping[str, DataFrame]) -> DataFrame:
    """Add ``is_matched``: some feed holds the row's reference on the same calendar date.

    One join for all routes: every reference that a row has is looked up among the
    united keys. A row comes out once for each reference that matched, or once
    unmatched beside them if its first did not, so :func:`deduplicate_transactions`, which
    prefers a matched row, must follow.
    """
    held = [
        route_rows.select(held_key(F.concat(F.lit(f"{route}:"), "match_key")).alias("_key"), F.col("feed_date").alias("trx_date"))
        for route, route_rows in keys.items()
    ]
    found = reduce(DataFrame.unionByName, held).distinct().withColumn("_found", F.lit(True))
    # A null reference makes a null key; a row without any keeps one of those.
    sought = F.array_compact(
        F.array(*[held_key(F.concat(F.lit(f"{route}:"), _text(ledger_side(route)))) for route in keys])
    )
    spread = F.concat(F.lit("n"), F.hex(F.xxhash64("account_id", "txn_date", "credit_trans_trx_id")))
    forms = F.posexplode(F.when(F.size(sought) > 0, sought).otherwise(F.array(spread)))
    return (
        rows.select("*", forms.alias("_place", "_key"))
        .join(found, ["_key", "trx_date"], "left")
        .withColumn("is_matched", F.coalesce("_found", F.lit(False)))
        .where("is_matched or _place = 0")
        .drop("_key", "_place", "_found")
    )


def with_match_key(
    rows: DataFrame, keys: Mapping[str, DataFrame], codes: DataFrame | None = None
) -> DataFrame:
    """Add ``key_join_issuer``, the key of the first feed that matches, and ``mcd_approval_code``.

    One row per ledger row. Of several approval codes the one the feed holds is
    shown, else the smallest, as ``codes`` has it per transaction; without ``codes``
    only the one the feed holds, which spares the ledger a join.
    """
    out, hits = rows, []
    for route, route_rows in keys.items():
        hit = f"_hit_{route}"
        out = look_up(out, best_keys(route_rows), ledger_side(route), F.col("hit"), hit)
        hits.append(hit)
    shown = [F.col(f"_hit_{APPROVAL}.reported_key")] if APPROVAL in keys else []
    if codes is not None:
        held = codes.select(
            held_key(F.col("trx_id")).alias("_key"), F.col("approval_code").alias("_code")
        )
        trx = sought_key(ledger_side(APPROVAL), "account_id", "txn_date", "txn_extref")
        out = out.withColumn("_key", trx).join(held, "_key", "left")
        shown.append(F.col("_code"))
    first = F.least(*hits) if len(hits) > 1 else F.col(hits[0])
    return (
        out.withColumn("mcd_approval_code", F.coalesce(*shown, F.lit(None).cast("string")))
        .withColumn("key_join_issuer", first["reported_key"])
        .drop("_key", "_code", *hits)
    )


def split_by_match(rows: DataFrame) -> DataFrame:
    """Matched and unmatched amount, and the unmatched fee, net and count, per row."""
    amount, matched = F.col("amount_base"), F.col("is_matched")
    unmatched = F.when(matched, 0).otherwise(amount).cast(amount_type(rows))
    fee = unmatched * F.col("mdr_rate")
    return rows.select(
        "*",
        F.when(matched, amount).otherwise(0).cast(amount_type(rows)).alias("amt_matched"),
        unmatched.alias("amt_unmatched"),
        fee.alias("mdr_unmatched"),
        (unmatched - fee).alias("net_unmatched"),
        F.when(matched, 0).otherwise(1).alias("traffic_unmatched"),
    )


def amount_type(rows: DataFrame) -> str:
    return rows.schema["amount_base"].dataType.simpleString()
