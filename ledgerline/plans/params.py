"""Run parameters. One ``as_of`` date stands for "today" everywhere."""

from dataclasses import dataclass
from datetime import date, timedelta
from decimal import Decimal

from ledgerline.plans import fixed_values as house


@dataclass(frozen=True)
class Params:
    as_of: date

    # The zone whose calendar days the business counts; timestamps without a zone are taken as local.
    zone: str = "UTC"

    # Trailing windows in days; the first day is included and there is no upper bound.
    ledger_days: int = 16
    weekday_opening_days: int = 30
    reference_days: int = 65
    ops_days: int = 75

    # Bits of the filters that spare references and transactions a shuffle; 0 for none. 2**23 (1 MB) is good for
    # half a million keys, 16 bits each; with more keys a filter lets more rows through, never fewer.
    reference_filter_bits: int = 0

    report_days: int = 14
    spine_tail_days: int = 7

    # "Just after midnight", inclusive; three separate bounds.
    first_trx_until: timedelta = timedelta(seconds=60)
    weekday_opening_until: timedelta = timedelta(seconds=61)
    holiday_carry_until: timedelta = timedelta(seconds=60)

    min_transfer: Decimal = house.MIN_TRANSFER
    default_rate: Decimal = house.DEFAULT_RATE
    status_tolerance: Decimal = Decimal("1")
    first_trx_abs_tolerance: Decimal = Decimal("1")
    first_trx_rel_tolerance: Decimal = Decimal("0.00001")

    excluded_vendor: int = house.EXCLUDED_VENDOR
    excluded_accounts: tuple = house.EXCLUDED_ACCOUNTS
    excluded_referrals: tuple = house.EXCLUDED_REFERRALS
    voucher_issuers: tuple = house.VOUCHER_ISSUERS

    def days_back(self, days: int) -> date:
        return self.as_of - timedelta(days=days)

    def first_day(self, table: str) -> date:
        """Earliest day that any operator reads of a table; feeds go by the ledger window."""
        days = {
            "ledger": max(self.ledger_days, self.weekday_opening_days),
            "transactions": self.reference_days,
            "card_refs": self.reference_days,
            "ops_balances": self.ops_days,
        }
        return self.days_back(days.get(table, self.ledger_days))

    @property
    def report_from(self) -> date:
        return self.days_back(self.report_days)
