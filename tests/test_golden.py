"""Worked cases G1 to G12."""

from datetime import datetime

from tests.books import ACCOUNT, Books, day


def check(row, **expected):
    actual = {k: row[k] for k in expected}
    assert actual == expected


def test_g1_plain_day(spark):
    out = Books().row(6, 100000).balance(7, 100000).report(spark)
    assert set(out) == {day(7)}
    check(
        out[day(7)], total_gross_transaction=100000, carry_over_balance=0, amount_final=100000, total_mdr=1000,
        total_net_trx=99000, amount_to_transfer=99000, total_gross_balance=100000, balance_final=100000,
        gross_difference=0, confirm_to_transfer="CONFIRM", merch_name="Shop",
    )


def test_g2_tolerance(spark):
    near = Books().row(6, 100000).balance(7, 100001).report(spark)
    assert near[day(7)]["confirm_to_transfer"] == "CONFIRM"
    far = Books().row(6, 100000).balance(7, 100002).report(spark)
    assert far[day(7)]["confirm_to_transfer"] == "NOT MATCH"


def test_g3_minimum_then_carry(spark):
    out = Books().row(5, 10000).row(6, 50000).balance(6, 10000).balance(7, 60000).report(spark)
    check(out[day(6)], total_net_trx=9900, confirm_to_transfer="MINIMUM NOT MET")
    check(
        out[day(7)], carry_over_balance=10000, amount_final=60000, total_mdr=600, total_net_trx=59400,
        gross_difference=-10000, confirm_to_transfer="CONFIRM",
    )


def weekend():
    return Books().row(9, 30000).row(10, 40000).row(11, 50000).balance(9, 5000).balance(12, 125000)


def test_g4_weekend(spark):
    out = weekend().report(spark)
    assert set(out) == {day(12)}
    check(
        out[day(12)], total_gross_transaction=120000, carry_over_balance=5000, amount_final=125000,
        total_mdr=1250, total_net_trx=123750, confirm_to_transfer="CONFIRM",
    )


def test_g5_holiday_carry(spark):
    out = weekend().row(datetime(2026, 1, 9, 0, 0, 30), 2000).report(spark)
    check(
        out[day(12)], total_gross_transaction=122000, carry_over_balance=5000, amount_final=127000,
        total_gross_balance=127000, first_trx=2000, confirm_to_transfer="CONFIRM",
    )


def test_g6_first_trx_explains_the_gap(spark):
    books = Books().row(6, 100000).row(datetime(2026, 1, 7, 0, 0, 20), 8000).balance(7, 108000)
    out = books.report(spark)
    check(
        out[day(7)], total_gross_transaction=100000, first_trx=8000, total_gross_balance=100000,
        confirm_to_transfer="CONFIRM",
    )
    check(
        out[day(8)], total_gross_transaction=8000, carry_over_balance=0, trx_00_amt=8000,
        total_gross_balance=8000, confirm_to_transfer="MINIMUM NOT MET",
    )


def test_g7_voucher(spark):
    books = Books().row(5, 15000, matched=False, issuer="MCD_VOUCHER").row(6, 100000).balance(7, 100000)
    out = books.report(spark)
    check(
        out[day(6)], total_gross_transaction=0, amount_final=0, confirm_to_transfer="MINIMUM NOT MET",
        total_traffic_not_match=1, total_gross_transaction_not_match=15000, total_mdr_not_match=150,
        total_amount_to_transfer_not_match=14850,
    )
    check(
        out[day(7)], amount_voucher=15000, amount_final=85000, balance_final=85000, total_net_trx=84150,
        confirm_to_transfer="CONFIRM",
    )


def test_g8_voucher_without_activity_is_lost(spark):
    books = Books().row(5, 15000, matched=False, issuer="MCD_VOUCHER").balance(7, 100000)
    out = books.report(spark)
    assert set(out) == {day(6)}
    assert out[day(6)]["amount_voucher"] == 0


def test_g9_nothing_moved(spark):
    books = Books().row(6, 100).row(6, 100, kind="Emoney Reversal")
    assert books.report(spark) == {}


def test_g10_batch_start_survives_a_boundary_that_does_not_close(spark):
    books = Books().row(10, 100).row(11, 100, kind="Emoney Reversal").row(12, 50000)
    out = books.balance(10, 7000).balance(13, 57000).report(spark)
    assert set(out) == {day(13)}
    check(
        out[day(13)], total_gross_transaction=50000, carry_over_balance=7000, amount_final=57000,
        total_net_trx=56430,
    )


def test_g11_null_and_duplicate_ids(spark):
    same = Books()
    same.row(6, 100, trx=7)
    same.ledger.append(same.ledger[-1])
    assert same.report(spark)[day(7)]["total_gross_transaction"] == 100

    nulls = Books().row(6, 100, trx=None, matched=False).row(7, 300, trx=None)
    out = nulls.report(spark)
    assert set(out) == {day(8)}  # the matched row of the two wins
    assert out[day(8)]["total_gross_transaction"] == 300

    undone = Books().row(6, 100, trx=7).row(6, 100, trx=7, kind="Emoney Reversal")
    assert undone.report(spark)[day(7)]["total_gross_transaction"] == 100


def test_g12_no_row_to_look_back_to(spark):
    books = Books(spine_anchor=False).row(6, 100000).balance(6, 9000)
    assert books.report(spark, account=ACCOUNT)[day(7)]["carry_over_balance"] == 0


def test_negative_balance_is_carried_and_the_minimum_is_not(spark):
    low = Books().row(6, 50000).balance(6, -500)
    assert low.report(spark)[day(7)]["carry_over_balance"] == -500
    high = Books().row(6, 50000).balance(6, 20140)
    assert high.report(spark)[day(7)]["carry_over_balance"] == 0


def test_unmatched_fee_rounds_half_to_even(spark):
    for amount, fee in ((250, 2), (350, 4)):
        out = Books().row(6, amount, matched=False).report(spark)
        assert out[day(7)]["total_mdr_not_match"] == fee


def test_missing_ops_balance_after_a_closed_day_carries_nothing(spark):
    # The row of the last working day exists but has no balance; an older balance must not be used.
    books = Books().row(9, 30000).row(10, 40000).balance(8, 5000)
    assert books.report(spark)[day(12)]["carry_over_balance"] == 0


def test_weekday_holiday_rolls_up(spark):
    books = Books(holidays=(day(7),)).row(6, 30000).row(7, 40000)
    out = books.report(spark)
    assert set(out) == {day(8)}
    assert out[day(8)]["total_gross_transaction"] == 70000


def test_report_window_ends_today_and_starts_14_days_back(spark):
    from dataclasses import replace

    from tests.books import PARAMS

    books = Books().row(13, 30000).row(14, 40000)
    assert set(books.report(spark)) == {day(14)}
    late = replace(PARAMS, as_of=day(15))
    assert set(books.report(spark, late)) == {day(14), day(15)}


def test_empty_ledger_gives_an_empty_report(spark):
    assert Books(spine_anchor=False).report(spark) == {}
