"""The daily run: compute the report and replace its window in the report table.

    spark-submit run_settlement.py --config tables.json --out PATH [--as-of DATE] [--states PATH]
"""

import argparse
import json
from collections.abc import Sequence
from datetime import date
from pathlib import Path

from pyspark.sql import SparkSession

from ledgerline.plans.counts import InputCounts
from ledgerline.plans.extracts import extract_counts
from ledgerline.plans.incremental import advance, report_from_state
from ledgerline.plans.params import Params
from ledgerline.plans.settlement import settlement_report
from ledgerline.sources.inputs import Inputs, read_inputs
from ledgerline.sources.sink import Written, replace_window


def run(inputs: Inputs, params: Params, path: str, counts: InputCounts | None = None) -> Written:
    """Returns the row count, settle dates and rows per status of what was written; ``counts`` learns the rows of the extracts."""
    report = settlement_report(inputs, params, counts)
    return replace_window(report, path, params.report_from, params.as_of)


def run_from_states(inputs: Inputs, params: Params, path: str, states: str) -> tuple[Written, tuple[date, ...]]:
    """Like :func:`run`, but only new and changed ledger days are matched; also returns those days."""
    matched = advance(inputs, params, states)
    written = replace_window(report_from_state(inputs, params, states), path, params.report_from, params.as_of)
    return written, matched


def main(argv: Sequence[str] | None = None) -> Written:
    parser = argparse.ArgumentParser(description="Daily merchant settlement")
    parser.add_argument("--config", required=True, help="JSON: tables, feeds, and optionally rename, stored_by")
    parser.add_argument("--out", required=True, help="folder of the report table")
    parser.add_argument("--as-of", type=date.fromisoformat, default=None, help="run date, default today")
    parser.add_argument("--states", help="folder of day states: match only ledger days that are new or changed; extracts are not counted")
    args = parser.parse_args(argv)

    config = json.loads(Path(args.config).read_text())
    builder = SparkSession.builder.appName("settlement")
    # Checkpoints go when nothing refers to them any more, so that daily runs leave none behind.
    spark = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").getOrCreate()
    params = Params(as_of=args.as_of or date.today())
    inputs = read_inputs(spark, params=params, **config)
    if args.states:
        written, matched = run_from_states(inputs, params, args.out, args.states)
        print("matched: " + (", ".join(map(str, matched)) or "no day"))
    else:
        counts = InputCounts()
        written = run(inputs, params, args.out, counts)
        told = counts.read(lambda: extract_counts(inputs, params))
        print(" | ".join(f"{extract}: {n}" for extract, n in told.items()))
    print(f"{written.rows} rows on {len(written.dates)} settle dates")
    print(" | ".join(f"{status}: {n}" for status, n in written.by_status.items()))
    return written
