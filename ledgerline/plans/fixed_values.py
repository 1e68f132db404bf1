"""House rules: fixed values of the settlement contract, as plain data.

They are defaults only. Every operator takes its rules as a parameter or a
DataFrame; nothing outside this module names an account or a referral code.
"""

from datetime import date
from decimal import Decimal

# Transaction types that move money, and their sign.
PURCHASE = "Customer Purchase"
REVERSAL = "Emoney Reversal"

# Accounts with their own fee rate.
ZERO_RATE_ACCOUNTS = (
    89236, 90181, 88552, 88116, 65440, 2553, 2568, 73707, 87227, 4194,
    82784, 82947, 86202, 86989, 85961, 86015, 86034, 86275, 86288, 86473,
    86480, 86506, 86513, 86759, 86948, 94399, 86738, 51873, 113441, 119398,
    117910, 121980, 140668, 142342, 147566, 148766, 150562, 154443, 157985,
    302966, 302155,
)
ACCOUNT_RATES = {
    **{account: Decimal("0") for account in ZERO_RATE_ACCOUNTS},
    128013: Decimal("0.015"),
}

# Fee rate per acquisition referral code.
REFERRAL_RATES = {
    "98ENTP062": Decimal("0.02"),
    "99ENTP017": Decimal("0.012"),
    "99ENTP018": Decimal("0.012"),
    "98ENTP029": Decimal("0.017"),
    "98ENTP011": Decimal("0.006"),
    "98ENTP017": Decimal("0.006"),
    "99ENTP003": Decimal("0.01"),
    "98ENTP026": Decimal("0.015"),
    "98ENTP032": Decimal("0.017"),
    "98ENTP014": Decimal("0.013"),
}
DEFAULT_RATE = Decimal("0.007")

# What the report leaves out.
EXCLUDED_REFERRALS = (
    "99ENTP001", "99ENTP004", "99ENTP014", "99ENTP019", "99ENTP023", "99ENTP026",
)
EXCLUDED_VENDOR = 1602
EXCLUDED_ACCOUNTS = (367540, 367620, 287527)

# Issuers whose rows are vouchers.
VOUCHER_ISSUERS = ("MCD_VOUCHER", "YTI_VOUCHER", "SNAP PROD Settlement")

# The smallest net amount that is paid out; balances below it carry over.
MIN_TRANSFER = Decimal("20140")

# Non-settlement weekdays of 2026 on top of the public holiday table.
HOLIDAYS = (
    date(2026, 1, 1),
    date(2026, 1, 16),
    date(2026, 2, 17),
    date(2026, 3, 19),
    date(2026, 3, 21),
    date(2026, 3, 22),
    date(2026, 4, 3),
    date(2026, 5, 1),
    date(2026, 5, 14),
    date(2026, 5, 27),
    date(2026, 5, 31),
    date(2026, 6, 1),
    date(2026, 8, 17),
    date(2026, 12, 25),
)
