"""The entry offers the settlement queries wherever corpus modules are missing."""

import subprocess
import sys
from pathlib import Path

import pytest

PROGRAM = """
import sys
sys.modules["{missing}"] = None
import __spark_entry__ as entry
from testbed.queries import QUERIES
assert set(entry.queries()) == set(QUERIES) and set(entry.oracle_sql()) == set(QUERIES)
"""


@pytest.mark.parametrize("missing", ["ahocorasick", "ledgerline.llm", "ledgerline.llm.queries"])
def test_settlement_queries_stand_alone(missing):
    ended = subprocess.run([sys.executable, "-c", PROGRAM.format(missing=missing)], cwd=Path(__file__).parents[1], capture_output=True, text=True)
    assert ended.returncode == 0, ended.stderr
    assert "corpus queries left out" in ended.stderr
