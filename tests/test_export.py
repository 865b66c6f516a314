import pytest
from pyspark.sql import functions as F

from trailmeter import constants as C
from trailmeter.plans import export
from trailmeter.schemas import ROLLUP

DAY = "2024-01-01"


@pytest.fixture
def rollup(make):
    base = {"dt": DAY, "tp": "day", "platform": "APP", "lvl": "0", "uv": 5, "tc_user_visits": 9}
    return lambda *changes: make([{**base, **c} for c in changes], ROLLUP)


def test_settled_visitors_are_masked_in_normal_mode_only(rollup):
    df = rollup({"dp": "stable"}, {"dp": "snapshot"}, {"dp": "stable", "tp": "week"})
    normal = {r.dp: (r.uv, r.tc_user_visits) for r in export.export_rows(df, DAY).collect()}
    assert normal == {"stable": (0, 0), "snapshot": (5, 9)}
    history = export.export_rows(df, DAY, pattern="history").collect()
    assert {(r.uv, r.tc_user_visits) for r in history} == {(5, 9)} and len(history) == 2


def test_no_nulls_leave(rollup):
    (row,) = export.export_rows(rollup({"dp": "stable", "uv": None}), DAY).collect()
    assert None not in tuple(row)
    assert (row.tc_visit_chan, row.deal_after_prefr_amount_1_toc_t2) == ("", 0.0)
    assert "tp" not in row.asDict() and 1 <= row.hash_key_for_shard <= C.SHARDS


def test_unknown_pattern(rollup):
    with pytest.raises(ValueError):
        export.export_rows(rollup({}), DAY, pattern="weekly")


def test_files_replace_their_days_and_are_sorted(rollup, spark, tmp_path):
    path = str(tmp_path / "out")
    many = [{"dp": "stable", "lvl": str(n % 8), "tc_visit_chan": f"c{n % 5}"} for n in range(200)]
    export.export_files(rollup(*many, {"dp": "stable", "dt": "2024-01-02"}), path, DAY, "2024-01-02")
    export.export_files(rollup(*many[:50]), path, DAY)
    found = spark.read.parquet(path)
    days = found.groupBy(F.col("dt").cast("string")).count().collect()
    assert {tuple(r) for r in days} == {(DAY, 50), ("2024-01-02", 1)}
    for file in found.inputFiles():
        keys = [tuple(r) for r in spark.read.parquet(file).select(*C.EXPORT_SORT).collect()]
        assert keys == sorted(keys)
    export.export_files(rollup({"dp": "stable", "tp": "week"}), path, DAY)
    assert [r.lvl for r in spark.read.parquet(path).collect()] == ["0"]


def test_files_hold_ranges_of_shards(rollup, spark, tmp_path):
    path = str(tmp_path / "out")
    many = [{"dp": "stable", "lvl": str(n % 8), "tc_visit_chan": f"c{n}"} for n in range(300)]
    days = [{**row, "dt": day} for day in (DAY, "2024-01-02") for row in many]
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        manifest = export.export_shards(rollup(*days), path, DAY, "2024-01-02")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    files = sorted(manifest.collect(), key=lambda r: (r.dt, r.min_shard))
    assert sum(r.rows for r in files) == 600 and len(files) >= 8
    for a, b in zip(files, files[1:]):
        assert a.dt < b.dt or a.max_shard < b.min_shard
    one = files[1]
    found = export.files_of_shards(manifest.where(F.col("dt") == one.dt), one.min_shard, one.max_shard)
    assert found == [one.file]
    rows = spark.read.parquet(one.file).agg(F.min(export.SHARD), F.max(export.SHARD)).first()
    assert tuple(rows) == (one.min_shard, one.max_shard)


def test_ranges_replace_their_days(rollup, spark, tmp_path):
    path = str(tmp_path / "out")
    export.export_shards(rollup({"dp": "stable"}, {"dp": "stable", "dt": "2024-01-02"}), path, DAY, "2024-01-02")
    left = export.export_shards(rollup({"dp": "snapshot"}, {"dp": "stable", "tp": "week"}), path, DAY, "2024-01-02")
    assert [(r.dt, r.rows) for r in left.collect()] == [(DAY, 1)]
