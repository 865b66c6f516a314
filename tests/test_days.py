import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from trailmeter.sources import days

SCHEMA = "id int, dt string, tp string, dp string"


@pytest.mark.parametrize("bad", ["2024-02-30", "20240101", "2024-1-1", "yesterday", ""])
def test_bad_days_are_refused(bad):
    with pytest.raises(ValueError):
        days.parse_day(bad)


def test_range_must_not_run_backwards():
    with pytest.raises(ValueError):
        days.parse_range("2024-01-02", "2024-01-01")


def test_read_days_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = [(n, f"2024-01-0{n}", "day", "x") for n in range(1, 6)]
    spark.createDataFrame(rows, SCHEMA).write.partitionBy("dt").parquet(path)
    schema = spark.createDataFrame([], SCHEMA).schema
    table = days.read_table(spark, path, schema)
    assert table.schema["dt"].dataType == StringType()
    found = days.read_days(table, "2024-01-02", "2024-01-03")
    assert sorted(r.id for r in found.collect()) == [2, 3]
    lagged = days.read_days(table, "2024-01-02", "2024-01-03", lag=1)
    assert sorted(r.id for r in lagged.collect()) == [1, 2]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_only_the_asked_days_are_listed(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(30).select(
        F.col("id").cast("int"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))
        .cast("string").alias("dt")
    )
    rows.repartition(1).write.partitionBy("dt").parquet(path)
    schema = "id int, dt string"
    one = days.read_table(spark, path, schema, days.days_of("2024-01-05", None))
    assert [tuple(r) for r in one.collect()] == [(4, "2024-01-05")] and len(one.inputFiles()) == 1
    lagged = days.read_table(spark, path, schema, days.days_of("2024-01-01", "2024-01-02", lag=1))
    assert sorted(r.id for r in lagged.collect()) == [0, 1]
    # No day found, or another layout: the whole table, for the day filter to cut.
    none = days.read_table(spark, path, schema, ["2025-01-01"])
    assert days.read_days(none, "2025-01-01").count() == 0
    other = str(tmp_path / "o")
    spark.read.schema(schema).parquet(path).withColumn("tp", F.lit(1)).write.partitionBy("tp", "dt").parquet(other)
    assert days.read_table(spark, other, f"{schema}, tp int", ["2024-01-05"]).count() == 30


def test_quarters_of_a_range():
    assert days.quarters_of("2023-12-31", "2024-04-01") == ["2023-10-01", "2024-01-01", "2024-04-01"]


def test_lagged_day_crosses_a_month(spark):
    df = spark.createDataFrame([("2024-02-29",)], "dt string")
    assert df.select(days.lagged_day(1)).first()[0] == "2024-03-01"


def test_quarters_follow_each_row(spark):
    rows = [
        ("2024-01-01", "2024-03-31"),
        ("2024-04-01", "2024-04-01"),
        ("2024-01-01", "2024-04-01"),  # in the wrong quarter
        ("2024-01-01", "2024-03-30"),  # outside the range
    ]
    df = spark.createDataFrame(rows, "dt string, day string")
    found = days.read_quarters(df, "2024-03-31", "2024-04-01", "day").collect()
    assert {tuple(r) for r in found} == set(rows[:2])


def test_versions_of_a_day_survive_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    parts = ("dt", "tp", "dp")

    def write(*rows):
        days.write_days(spark.createDataFrame(list(rows), SCHEMA), path, parts)

    write((1, "2024-01-01", "day", "stable"), (2, "2024-01-02", "day", "stable"))
    write((3, "2024-01-01", "day", "snapshot"))
    write((4, "2024-01-01", "day", "snapshot"))
    found = spark.read.schema(SCHEMA).parquet(path).select("id", "dt", "dp").collect()
    assert {tuple(r) for r in found} == {
        (1, "2024-01-01", "stable"),
        (2, "2024-01-02", "stable"),
        (4, "2024-01-01", "snapshot"),
    }


def test_clear_empties_days_of_the_range_only(spark, tmp_path):
    path = str(tmp_path / "t")

    def write(rows, clear):
        days.write_days(spark.createDataFrame(rows, "id int, dt string"), path, clear=clear)

    write([(n, f"2024-01-0{n}") for n in (1, 2, 3)], ("2024-01-01", "2024-01-03"))
    write([(20, "2024-01-01")], ("2024-01-01", "2024-01-02"))
    found = spark.read.schema("id int, dt string").parquet(path).collect()
    assert {tuple(r) for r in found} == {(20, "2024-01-01"), (3, "2024-01-03")}
    with pytest.raises(ValueError):
        days.write_days(spark.createDataFrame([], SCHEMA), path, ("dt", "tp"), clear=("a", "b"))


def test_write_puts_session_settings_back(spark, tmp_path):
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key, None)
    df = spark.range(3).select(F.col("id"), F.lit("2024-01-01").alias("dt"))
    days.write_days(df, str(tmp_path / "t"))
    assert spark.conf.get(key, None) == before


def test_a_big_day_is_split_over_tasks(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(200_000, numPartitions=8).select(
        F.md5(F.col("id").cast("string")).alias("text"), F.lit("2024-01-01").alias("dt")
    )
    key = "trailmeter.sources.days.FILE_BYTES"
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(key, 1_000_000)
        days.write_days(df, path)
    assert len(spark.read.parquet(path).inputFiles()) > 2
    assert spark.read.parquet(path).count() == 200_000


def test_joins_behind_a_write_keep_small_tasks(spark, tmp_path):
    """One size holds for all shuffles of a write, so it must not be as large as a file."""
    path = str(tmp_path / "t")
    text = F.md5(F.col("id").cast("string"))
    df = spark.range(100_000, numPartitions=8).groupBy(text.alias("text")).agg(F.count("*").alias("n"))
    df = df.select("*", F.spark_partition_id().alias("task"), F.lit("2024-01-01").alias("dt"))
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(key, "1m")
    try:
        days.write_days(df, path)
    finally:
        spark.conf.unset(key)
    assert spark.read.parquet(path).select("task").distinct().count() > 1
    assert days.TASK_BYTES <= 64_000_000 < days.FILE_BYTES
