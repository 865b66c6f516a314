"""Ranges run part by part: the same rows, and no shuffle left on disk behind a write."""

import os
import time

import pytest
from pyspark.sql import functions as F

from harness import queries
from harness.compare import difference
from harness.oracle import ORACLE
from trailmeter.sources import days

pytestmark = pytest.mark.usefixtures("compiled_plans")

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def shuffle_files(spark):
    """Names of the shuffle files on disk."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = files.mkString("\n").split("\n")
    return {os.path.basename(name) for name in names if "/shuffle_" in name}


def left_behind(spark, before):
    """Shuffle files that are still there; they go in the background."""
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            break
        time.sleep(0.1)
    return left


def test_parts_make_up_the_range(spark):
    counts = {"2024-01-02": 3, "2024-01-03": 4, "2024-01-07": 9, "2024-01-08": 1, "2024-02-01": 2}
    rows = spark.createDataFrame([(day,) for day, n in counts.items() for _ in range(n)], "dt string")
    parts = days.day_parts(rows, 7, "2024-01-01", "2024-03-01")
    # A day of more rows than that is a part of its own; days without rows belong to the part before.
    assert parts == [
        ("2024-01-01", "2024-01-06"), ("2024-01-07", "2024-01-07"), ("2024-01-08", "2024-03-01")
    ]
    assert days.day_parts(rows, 100, "2024-01-01", "2024-03-01") == [("2024-01-01", "2024-03-01")]
    assert days.day_parts(rows.where("false"), 7, "2024-01-01") == [("2024-01-01", "2024-01-01")]
    # Only days of the range count.
    assert days.day_parts(rows, 7, "2024-01-08", "2024-03-01") == [("2024-01-08", "2024-03-01")]


def test_a_write_leaves_no_shuffle_behind(spark, tmp_path):
    before = shuffle_files(spark)
    day = F.concat(F.lit("2024-01-0"), F.col("id") % 3 + 1)
    rows = spark.range(1000).groupBy(day.alias("dt"), F.col("id") % 100).agg(F.count(F.lit(1)).alias("n"))
    days.write_days(rows, str(tmp_path / "t"))
    assert not left_behind(spark, before)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 300


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_versions_and_parts_are_written_one_after_the_other(spark, monkeypatch):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    monkeypatch.setattr(queries, "DETAIL_EVENTS", events // 2)
    monkeypatch.setattr(queries, "ROLLUP_ROWS", events // 3)
    written, write = [], queries.write_days

    def watched(rows, path, *rest):
        before = shuffle_files(spark)
        write(rows, path, *rest)
        assert not left_behind(spark, before)
        found = spark.read.parquet(path).select("dt", "dp").distinct()
        written.append((os.path.basename(path).split("-")[0], found.count()))

    monkeypatch.setattr(queries, "write_days", watched)
    result = queries.rollup_merged(spark, SF_DIR)
    # Every write adds days of one version to the ones before.
    for kind in ("detail", "rollup"):
        sizes = [n for name, n in written if name == kind]
        assert len(sizes) >= 4 and sizes == sorted(set(sizes))
    assert difference(result, SF_DIR, ORACLE["rollup_merged"]) is None


EXPORTS = ["export_normal", "export_history"]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", EXPORTS)
def test_exports_read_a_rollup_stored_once_in_parts(spark, monkeypatch, name):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    monkeypatch.setattr(queries, "ROLLUP_ROWS", events // 3)
    written, write = [], queries.write_days

    def watched(rows, path, *rest):
        before = shuffle_files(spark)
        write(rows, path, *rest)
        assert not left_behind(spark, before)
        written.append(os.path.basename(path))

    monkeypatch.setattr(queries, "write_days", watched)
    result = queries.QUERIES[name](spark, SF_DIR)
    rollups = [path for path in written if path.startswith("rollup-")]
    assert len(rollups) >= 4 and len(set(rollups)) == 1
    assert difference(result, SF_DIR, ORACLE[name]) is None
