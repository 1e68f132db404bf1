"""Text forms of the sink, and replacing a window."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.report import for_reading, report_rows, status_counts
from ledgerline.plans.job import run
from ledgerline.sources import schemas, sink
from tests.books import PARAMS, Books, day

NUMBERS = [f.name for f in schemas.REPORT if isinstance(f.dataType, type(schemas.DOUBLE))]


def report(spark, *rows):
    """(settle date, account, status) rows in the report's layout."""
    df = spark.createDataFrame(rows, "balance_date date, account_id bigint, confirm_to_transfer string")
    filled = df.withColumns({c: F.lit(1.0) for c in NUMBERS}).withColumns(
        {c: F.lit("x") for c in ("merch_name", "bank_account_name", "bank_account_number", "bank_code", "bank_name")}
    )
    return filled.select(schemas.REPORT.names)


def stored(spark, path):
    return sorted((r.balance_date, r.account_id) for r in sink.read_report(spark, path).collect())


@pytest.mark.parametrize("raw, text", [("12.0", "12"), ("12.05", "12.05"), ("nan", ""), (None, ""), ("1.0.0", "1.0")])
def test_bank_number_text(spark, raw, text):
    df = spark.createDataFrame([(raw,)], "n string")
    assert df.select(sink.bank_number_text(F.col("n"))).first()[0] == text


@pytest.mark.parametrize("raw, text", [("12", "12"), ("12.0", "12"), ("x", "0"), (None, "0")])
def test_account_text(spark, raw, text):
    df = spark.createDataFrame([(raw,)], "n string")
    assert df.select(sink.account_text(F.col("n"))).first()[0] == text


def test_replace_drops_stale_dates_and_keeps_the_rest(spark, tmp_path):
    path = str(tmp_path / "report")
    first = report(spark, *[(day(n), a, "CONFIRM") for n in (2, 5, 6, 7) for a in (1, 2)])
    sink.replace_window(first, path, day(1), day(8))
    second = report(spark, (day(5), 1, "CONFIRM"), (day(7), 3, "NOT MATCH"), (day(7), 4, "MINIMUM NOT MET"))
    written = sink.replace_window(second, path, day(5), day(9))
    assert stored(spark, path) == [(day(2), "1"), (day(2), "2"), (day(5), "1"), (day(7), "3"), (day(7), "4")]
    assert written.rows == 3
    assert written.dates == (day(5), day(7))
    assert written.by_status == {"CONFIRM": 1, "NOT MATCH": 1, "MINIMUM NOT MET": 1}


def test_replace_again_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "report")
    rows = report(spark, (day(5), 1, "CONFIRM"), (day(6), 1, "CONFIRM"))
    sink.replace_window(rows, path, day(5), day(9))
    sink.replace_window(rows, path, day(5), day(9))
    assert stored(spark, path) == [(day(5), "1"), (day(6), "1")]


def test_an_empty_report_leaves_the_table_alone(spark, tmp_path):
    path = str(tmp_path / "report")
    sink.replace_window(report(spark, (day(5), 1, "CONFIRM")), path, day(5), day(9))
    assert sink.replace_window(report(spark).limit(0), path, day(5), day(9)).rows == 0
    assert stored(spark, path) == [(day(5), "1")]


def test_rows_outside_the_window_are_not_written(spark, tmp_path):
    path = str(tmp_path / "report")
    sink.replace_window(report(spark, (day(4), 1, "CONFIRM"), (day(5), 1, "CONFIRM")), path, day(5), day(9))
    assert stored(spark, path) == [(day(5), "1")]


def test_daily_run(spark, tmp_path):
    path = str(tmp_path / "report")
    books = Books().row(6, 100000).balance(7, 100000)
    books.banks = [(100, "B BANK", "Owner", "991.0", "B"), (100, "A BANK", "Owner", "123.0", "A")]
    written = run(books.inputs(spark), PARAMS, path)
    assert written.by_status == {"CONFIRM": 1, "NOT MATCH": 0, "MINIMUM NOT MET": 1}
    rows = {r.account_id: r for r in sink.read_report(spark, path).collect()}
    assert rows["100"].bank_name == "A BANK" and rows["100"].bank_account_number == "123"
    assert rows["200"].bank_account_number == ""
    assert sink.read_report(spark, path).columns == schemas.REPORT.names


def test_command_line_run_from_stored_tables(spark, tmp_path, capsys):
    import json

    from ledgerline.operators.recon import FEEDS
    from ledgerline.plans.job import main
    from ledgerline.sources.inputs import DECLARED

    inputs = Books().row(6, 100000).balance(7, 100000).inputs(spark)
    config = {"tables": {}, "feeds": {}, "rename": {"ledger": {"txn_extref": "ext_reference"}}}
    given = {n: getattr(inputs, n) for n in [*DECLARED, "rates"]}
    given["public_holidays"] = spark.createDataFrame([(date(2025, 12, 25),), (date(2026, 1, 1),)], "holiday_date date")
    given["holiday_coverage"] = spark.createDataFrame([(date(2025, 1, 1), date(2026, 12, 31))], "known_from date, known_to date")
    for name, df in given.items():
        df = df.withColumnRenamed("txn_extref", "ext_reference") if name == "ledger" else df
        config["tables"][name] = str(tmp_path / name)
        df.write.parquet(config["tables"][name])
    for spec in FEEDS:
        empty = spark.createDataFrame([], f"{spec.key} string, {spec.timestamp} timestamp_ntz")
        config["feeds"][spec.name] = str(tmp_path / spec.name)
        inputs.feeds.get(spec.name, empty).write.parquet(config["feeds"][spec.name])
    file = tmp_path / "tables.json"
    file.write_text(json.dumps(config))
    out = str(tmp_path / "report")
    args = ["--config", str(file), "--out", out, "--as-of", "2026-01-14"]
    written = main(args)
    assert (written.rows, written.by_status["CONFIRM"]) == (2, 1)
    told = capsys.readouterr().out
    assert "CONFIRM: 1 | NOT MATCH: 0 | MINIMUM NOT MET: 1" in told
    assert "base: 2 | vouchers: 0 | bank_accounts: 0 | ops_balances: 1 | first_trx: 0 | trx_00: 0" in told
    del config["feeds"]["ovo"]
    file.write_text(json.dumps(config))
    with pytest.raises(ValueError, match="ovo"):
        main(args)


def test_window_status_counts_and_reading_order(spark):
    rows = report(spark, (day(5), 2, "CONFIRM"), (day(6), 2, "NOT MATCH"), (day(6), 1, "CONFIRM"))
    assert {tuple(r) for r in status_counts(rows).collect()} == {("CONFIRM", 2), ("NOT MATCH", 1)}
    order = [(r.balance_date, r.account_id) for r in for_reading(rows).collect()]
    assert order == [(day(6), 1), (day(6), 2), (day(5), 2)]
    edges = [(d, 1, "CONFIRM") for d in (date(2025, 12, 30), date(2025, 12, 31), day(14), day(15))]
    settled = report(spark, *edges).drop("bank_name", "bank_code", "bank_account_name", "bank_account_number")
    kept = report_rows(settled, spark.createDataFrame([], schemas.BANK_ACCOUNTS), PARAMS)
    assert sorted(r.balance_date for r in kept.collect()) == [date(2025, 12, 31), day(14)]
