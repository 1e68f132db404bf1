"""Random books against a day-by-day model, and invariants of the report."""

import random
from collections import defaultdict
from dataclasses import replace
from datetime import date, datetime, time, timedelta
from decimal import ROUND_HALF_EVEN, Decimal

import pytest

from ledgerline.operators.batches import settlements
from ledgerline.plans.settlement import days_of
from tests.books import PARAMS, Books, day

HOLIDAYS = (day(7), day(12))
MINIMUM = Decimal(20140)
ONE = timedelta(days=1)


def open_day(d: date) -> bool:
    return d.weekday() < 5 and d not in HOLIDAYS


def working_day_before(d: date) -> date:
    return next(d - n * ONE for n in range(1, 40) if open_day(d - n * ONE))


def random_books(seed: int, accounts: int = 60) -> Books:
    rng = random.Random(seed)
    books = Books(spine_anchor=False, holidays=HOLIDAYS, merchants=[])
    for account in range(1, accounts + 1):
        books.merchants.append((account, "R1" if account % 2 else None, "t", 1))
        for _ in range(rng.randint(1, 14)):
            n = rng.randint(1, 13)
            opening = timedelta(seconds=rng.randint(0, 62))
            at = datetime.combine(day(n), time()) + (opening if rng.random() < 0.3 else timedelta(hours=12))
            amount = rng.choice([100, 100, 2000, 25000, 60000])
            kind = rng.choice(["Customer Purchase"] * 4 + ["Emoney Reversal"] * 2 + ["Other"])
            books.row(
                at, amount, account=account, kind=kind, matched=rng.random() < 0.7,
                issuer=rng.choice(["X", "X", "X", "YTI_VOUCHER"]),
            )
        for n in range(1, 15):
            if rng.random() < 0.6:
                books.balance(n, rng.choice([-500, 100, 4000, 20140, 25000, 60000]), account=account)
    return books


def model(books: Books) -> dict:
    """(account, settle date) -> the numbers that settle, by walking each account's days."""
    matched_refs = {ref for ref, _ in books.feed}
    zero = Decimal(0)
    matched, unmatched, count, voucher, opening, weekday, first = (defaultdict(lambda: zero) for _ in range(7))
    first_at = {}
    for account, _, _, at, issuer, kind, amt, _, _, ref, _, _ in books.ledger:
        sign = {"Customer Purchase": 1, "Emoney Reversal": -1}.get(kind, 0)
        value, key, clock = sign * amt, (account, at.date()), at.time()
        if ref in matched_refs:
            matched[key] += value
            if clock <= time(0, 1):
                opening[key] += value
        else:
            unmatched[key] += value
            count[key] += 1
        if issuer == "YTI_VOUCHER":
            voucher[account, at.date() + ONE] += value
        if clock <= time(0, 1, 1) and at.weekday() < 5:
            weekday[key] += value
        if clock <= time(0, 1):
            if key not in first_at or at < first_at[key]:
                first_at[key], first[key] = at, zero
            if at == first_at[key]:
                first[key] += value
    ops = {(a, created.date()): balance for a, balance, created, _ in books.ops}
    active = {(a, at.date()) for a, _, _, at, *_ in books.ledger}
    low, high = min(d for _, d in active), max(d for _, d in active) + 7 * ONE
    rates = {a: Decimal("0.01") if r == "R1" else Decimal("0.007") for a, r, _, _ in books.merchants}
    out = {}
    for account in {a for a, _ in active}:
        rate = rates[account]

        def balance(d, account=account):
            return ops.get((account, d + ONE), zero) + weekday[account, d]

        total = dict.fromkeys(("m", "u", "v", "f", "n"), zero)
        start, d = None, low
        while d <= high:
            key = account, d
            total["m"] += matched[key]
            total["u"] += unmatched[key]
            total["v"] += voucher[key] if key in active else zero
            total["f"] += first[account, d + ONE]
            total["n"] += count[key]
            if start is None and (matched[key] or unmatched[key]):
                start = d
            settle = d + ONE
            if open_day(settle) and (total["m"] or total["u"]):
                if open_day(d):
                    source = balance(start - ONE) if start > low else None
                else:
                    last = working_day_before(settle)
                    source = ops.get((account, last)) if last - ONE >= low else None
                carry = source if source is not None and source < MINIMUM else zero
                last = working_day_before(settle)
                held = opening[account, last] if last >= low and not open_day(last + ONE) else zero
                adjusted = balance(d) + held
                final = total["m"] - total["v"] + carry
                gap = abs(adjusted - total["m"] - total["f"])
                if total["f"] > 0 and gap <= 1 + abs(total["f"]) / 100000:
                    adjusted -= total["f"]
                net = final - final * rate
                if net < MINIMUM:
                    status = "MINIMUM NOT MET"
                else:
                    status = "NOT MATCH" if abs(final - (adjusted - total["v"])) > 1 else "CONFIRM"
                fee = (total["u"] * rate).quantize(Decimal(1), ROUND_HALF_EVEN)
                out[account, settle] = (
                    total["m"], carry, final, net, adjusted, total["v"], total["f"], total["u"], total["n"], fee, status,
                )
                total = dict.fromkeys(total, zero)
                start = None
            d += ONE
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_settlements_equal_the_model(spark, seed):
    books = random_books(seed)
    rows = settlements(days_of(books.inputs(spark), PARAMS), PARAMS).collect()
    actual = {
        (r.account_id, r.balance_date): (
            r.total_gross_transaction, r.carry_over_balance, r.amount_final, r.total_net_trx, r.total_gross_balance,
            r.amount_voucher, r.first_trx, r.total_gross_transaction_not_match, r.total_traffic_not_match,
            r.total_mdr_not_match, r.confirm_to_transfer,
        )
        for r in rows
    }
    assert len(actual) == len(rows), "at most one row per account and settle date"
    expected = model(books)
    assert set(actual) == set(expected)
    assert {k: v for k, v in actual.items() if v != expected[k]} == {}
    assert all(open_day(settle) for _, settle in actual)
    statuses = {v[-1] for v in actual.values()}
    assert statuses == {"MINIMUM NOT MET", "NOT MATCH", "CONFIRM"}


def test_batch_sums_add_up_to_the_ledger(spark):
    """With a tail that always reaches a boundary, every matched amount settles exactly once."""
    books = random_books(4)
    inputs = books.inputs(spark)
    settled = settlements(days_of(inputs, PARAMS), PARAMS).collect()
    refs = {ref for ref, _ in books.feed}
    signs = {"Customer Purchase": 1, "Emoney Reversal": -1}
    for pick, column in (
        (lambda ref: ref in refs, "total_gross_transaction"),
        (lambda ref: ref not in refs, "total_gross_transaction_not_match"),
    ):
        ledger_sum = sum(signs.get(r[5], 0) * r[6] for r in books.ledger if pick(r[9]))
        assert sum(r[column] for r in settled) == ledger_sum


def test_arrival_order_does_not_matter(spark):
    books = random_books(5)
    # Several rows under one id, and several without any: a choice has to be made.
    books.ledger = [(*r[:7], str(int(r[7]) % 40) if int(r[7]) % 5 else None, *r[8:]) for r in books.ledger]

    def settled(shuffle_seed):
        shuffled = random_books(5)
        shuffled.ledger = random.Random(shuffle_seed).sample(books.ledger, len(books.ledger))
        inputs = shuffled.inputs(spark)
        inputs = replace(inputs, ledger=inputs.ledger.repartition(shuffle_seed + 2))
        return sorted(map(str, settlements(days_of(inputs, PARAMS), PARAMS).collect()))

    assert settled(1) == settled(2) == settled(3)
