"""The report window is replaced by one commit or not at all."""

import subprocess
import sys
import textwrap
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import sink, snapshots
from tests.books import day
from tests.test_sink import report, stored

OLD = [(2, 1), (5, 1), (6, 1), (7, 1)]
NEW = [(5, 2), (6, 2), (7, 2)]


def rows(spark, of):
    return report(spark, *[(day(n), a, "CONFIRM") for n, a in of])


def as_stored(of):
    return sorted((day(n), str(a)) for n, a in of)


@pytest.fixture
def path(spark, tmp_path):
    path = str(tmp_path / "report")
    sink.replace_window(rows(spark, OLD), path, day(1), day(8))
    return path


def test_a_task_that_fails_half_way_leaves_the_old_table(spark, path):
    broken = rows(spark, NEW).withColumn(
        "merch_name", F.when(F.col("balance_date") == day(7), F.raise_error(F.lit("lost")).cast("string")).otherwise("x")
    )
    with pytest.raises(Exception, match="lost"):
        sink.replace_window(broken.repartition(3, "balance_date"), path, day(5), day(8))
    assert stored(spark, path) == as_stored(OLD)
    sink.replace_window(rows(spark, NEW), path, day(5), day(8))
    assert stored(spark, path) == as_stored([(2, 1), *NEW])


def test_a_process_killed_before_the_commit_leaves_the_old_table(spark, path):
    """The writing process ends itself the hard way once all its data is there."""
    program = f"""
        import os
        from pyspark.sql import SparkSession
        from ledgerline.sources import sink
        from tests.books import day
        from tests.test_snapshots import NEW, rows
        spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
        sink.replace_window(rows(spark, NEW), {path!r}, day(5), day(8), create=lambda *_: os._exit(9))
    """
    ended = subprocess.run([sys.executable, "-c", textwrap.dedent(program)], cwd=Path(__file__).parents[1], capture_output=True, timeout=300)
    assert ended.returncode == 9
    assert len(list(Path(path, "data").iterdir())) == 2
    assert stored(spark, path) == as_stored(OLD)


def test_of_two_writers_one_wins(spark, path):
    def late(file, content):
        """Another run starts and ends while this one is about to commit."""
        sink.replace_window(rows(spark, [(6, 3)]), path, day(5), day(8))
        return snapshots.create_if_absent(file, content)

    with pytest.raises(snapshots.Conflict):
        sink.replace_window(rows(spark, NEW), path, day(5), day(8), create=late)
    assert stored(spark, path) == as_stored([(2, 1), (6, 3)])
    assert snapshots.versions(path) == [1, 2]


def test_of_many_creators_one_wins(tmp_path):
    file = str(tmp_path / "v" / "1.json")
    with ThreadPoolExecutor(16) as pool:
        won = list(pool.map(lambda i: snapshots.create_if_absent(file, b"%d" % i), range(64)))
    assert won.count(True) == 1
    assert Path(file).read_bytes() == b"%d" % won.index(True)
    assert [f.name for f in Path(file).parent.iterdir()] == ["1.json"]


def test_readers_keep_their_version_and_list_only_their_dates(spark, path):
    before = sink.read_report(spark, path)
    sink.replace_window(rows(spark, NEW), path, day(5), day(8))
    assert sorted((r.balance_date, r.account_id) for r in before.collect()) == as_stored(OLD)
    assert sorted((r.balance_date, r.account_id) for r in sink.read_report(spark, path, version=1).collect()) == as_stored(OLD)
    some = sink.read_report(spark, path, day(6), day(6))
    assert [(r.balance_date, r.account_id) for r in some.collect()] == as_stored([(6, 2)])
    assert len(some.inputFiles()) == 1


def test_dates_outside_the_window_keep_their_files(spark, path):
    files = set(sink.read_report(spark, path, day(2), day(2)).inputFiles())
    sink.replace_window(rows(spark, NEW), path, day(5), day(8))
    assert set(sink.read_report(spark, path, day(2), day(2)).inputFiles()) == files


def test_an_empty_report_makes_no_version(spark, path):
    sink.replace_window(rows(spark, NEW).limit(0), path, day(5), day(8))
    assert snapshots.versions(path) == [1] and stored(spark, path) == as_stored(OLD)


def test_old_versions_go_with_what_only_they_had(spark, path):
    for _ in range(2):
        sink.replace_window(rows(spark, NEW), path, day(5), day(8))
    assert len(snapshots.drop_old_versions(path, keep=1)) == 6
    assert snapshots.versions(path) == [3] and stored(spark, path) == as_stored([(2, 1), *NEW])
    assert snapshots.drop_old_versions(path, keep=1) == []
    with pytest.raises(ValueError):
        snapshots.drop_old_versions(path, keep=0)


def test_no_table_reads_as_empty_and_a_cluster_needs_the_file_system(spark, tmp_path):
    assert sink.read_report(spark, str(tmp_path / "none")).isEmpty()
    with pytest.raises(ValueError, match="file system"):
        snapshots.check_location("/report", "yarn")
    snapshots.check_location("hdfs://name/report", "yarn")


def test_paths_with_a_scheme(spark, tmp_path):
    path = f"file:{tmp_path}/report"
    sink.replace_window(rows(spark, OLD), path, day(1), day(8))
    assert stored(spark, path) == as_stored(OLD) == stored(spark, f"file://{tmp_path}/report")
