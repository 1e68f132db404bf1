"""Tiny books for the tests: a ledger, one feed, ops balances, as plain rows."""

from dataclasses import dataclass, field
from datetime import date, datetime, timedelta
from decimal import Decimal

from ledgerline.plans.calendar import holiday_table
from ledgerline.plans.params import Params
from ledgerline.plans.rates import rate_card
from ledgerline.plans.settlement import settlement_report
from ledgerline.sources import schemas
from ledgerline.sources.inputs import Inputs

PARAMS = Params(as_of=date(2026, 1, 14))
ACCOUNT, OTHER = 100, 200


def day(n: int) -> date:
    return date(2026, 1, n)


def noon(n: int) -> datetime:
    return datetime(2026, 1, n, 12)


@dataclass
class Books:
    """Rows are matched through the feed ``shopeepay`` unless said otherwise."""

    spine_anchor: bool = True
    ledger: list = field(default_factory=list)
    feed: list = field(default_factory=list)
    ops: list = field(default_factory=list)
    merchants: list = field(default_factory=lambda: [(ACCOUNT, "R1", "t", 1), (OTHER, "R1", "t", 1)])
    banks: list = field(default_factory=list)
    holidays: tuple = ()

    def __post_init__(self):
        self._next = 1
        if self.spine_anchor:
            self.row(5, 1, account=OTHER, matched=False)

    def row(
        self, when, amt, *, account=ACCOUNT, kind="Customer Purchase", trx="next", matched=True,
        issuer="X", name="Shop",
    ):
        at = noon(when) if isinstance(when, int) else when
        ref = f"ref{self._next}"
        trx_id = self._next if trx == "next" else trx
        self._next += 1
        self.ledger.append(
            (account, "m", name, at, issuer, kind, _money(amt), trx_id if trx_id is None else str(trx_id), None, ref, None, None)
        )
        if matched:
            self.feed.append((ref, at))
        return self

    def balance(self, n, amount, account=ACCOUNT, processed=8):
        created = datetime.combine(day(n), datetime.min.time())
        self.ops.append((account, _money(amount), created, created + timedelta(hours=processed)))
        return self

    def inputs(self, spark) -> Inputs:
        def frame(rows, schema):
            return spark.createDataFrame(rows, schema)

        return Inputs(
            ledger=frame(self.ledger, schemas.LEDGER),
            merchants=frame(self.merchants, schemas.MERCHANTS),
            transactions=frame([], schemas.TRANSACTIONS),
            card_refs=frame([], schemas.CARD_REFS),
            feeds={"shopeepay": frame(self.feed, "transaction_id string, create_time timestamp_ntz")},
            bank_accounts=frame(self.banks, schemas.BANK_ACCOUNTS),
            ops_balances=frame(self.ops, schemas.OPS_BALANCES),
            holidays=holiday_table(spark, extra=self.holidays),
            rates=rate_card(spark, {}, {"R1": Decimal("0.01")}),
        )

    def report(self, spark, params=PARAMS, account=ACCOUNT) -> dict:
        """Settle date -> row, for one account."""
        rows = settlement_report(self.inputs(spark), params).where(f"account_id = {account}").collect()
        out = {r["balance_date"]: r for r in rows}
        assert len(out) == len(rows)
        return out


def _money(x):
    return None if x is None else Decimal(str(x)).quantize(Decimal("0.0001"))
