"""Row counts of the six extracts, observed while the report is computed."""

from collections.abc import Callable

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# The extracts in the order in which they are told.
EXTRACTS = ("base", "vouchers", "bank_accounts", "ops_balances", "first_trx", "trx_00")


class InputCounts:
    """Collects the counts of one run.

    The rows are counted as they pass, by the jobs that the report needs anyway. A stage that is run again after a lost
    executor can count its rows twice; ``extract_counts`` computes them exactly, by jobs of its own.
    """

    def __init__(self):
        self._seen: list[Observation] = []

    def seen(self, rows: DataFrame, **counts: Column) -> DataFrame:
        """``rows`` themselves, with ``counts`` observed; columns that nobody reads are to be dropped before."""
        watch = Observation()
        self._seen.append(watch)
        return rows.observe(watch, *[F.coalesce(c, F.lit(0)).cast("long").alias(n) for n, c in counts.items()])

    def read(self, exact: Callable[[], DataFrame]) -> dict[str, int]:
        """Extract -> rows; to be called once the report was computed.

        Adaptive execution leaves out a branch that turns out to add nothing, and what was observed
        there with it. ``exact`` (extract, n_rows) is asked for those, and only for those.
        """
        told: dict[str, int] = {}
        for watch in self._seen:
            try:
                told |= watch.get
            except Py4JError:
                continue
        missing = [name for name in EXTRACTS if name not in told]
        if missing:
            rows = exact().where(F.col("extract").isin(missing)).collect()
            told |= dict.fromkeys(missing, 0) | {r.extract: r.n_rows for r in rows}
        return {name: told[name] for name in EXTRACTS}
