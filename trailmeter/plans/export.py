"""Export of the rollup to a table partitioned by day, with a shard key in each row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmeter import constants as C
from trailmeter.functions.keys import shard_key
from trailmeter.schemas import ROLLUP_COLUMNS
from trailmeter.sources.days import days_of, read_days, read_table, write_days

NORMAL, HISTORY = "normal", "history"
COLUMNS = ["dt", *[name for name in ROLLUP_COLUMNS if name not in ("dt", "tp")]]
SHARD = "hash_key_for_shard"


def export_rows(
    rollup: DataFrame,
    start: str,
    end: str | None = None,
    pattern: str = NORMAL,
    shards: int = C.SHARDS,
) -> DataFrame:
    """The exported columns with a shard key and without NULLs.

    ``normal`` sets visitors and visits of the settled version to 0, because consumers add up both
    versions of a day. ``history`` days have the settled version alone and keep them.
    """
    if pattern not in (NORMAL, HISTORY):
        raise ValueError(f"pattern must be {NORMAL!r} or {HISTORY!r}, not {pattern!r}")
    rows = read_days(rollup, start, end).where(F.col("tp") == C.DAY)
    if pattern == NORMAL:
        settled = F.col("dp") == C.STABLE
        for name in ("uv", "tc_user_visits"):
            rows = rows.withColumn(name, F.when(settled, F.lit(0)).otherwise(F.col(name)))
    keys = ["dt", "dp", *C.EXPORT_SORT, *C.ROLLUP_DIMENSIONS, "path_user_visit_freq"]
    key = shard_key(*[F.col(name) for name in dict.fromkeys(keys)], shards=shards)
    return rows.select(*COLUMNS, key.alias(SHARD)).fillna("").fillna(0)


def export_files(
    rollup: DataFrame,
    path: str,
    start: str,
    end: str | None = None,
    pattern: str = NORMAL,
) -> None:
    """Replace the exported days, in files of up to 64 MB of shuffled rows, each sorted by the store's key.

    A day takes as many tasks as its bytes ask for. The day is the only partition column: with a part
    as a second one, a rerun would leave behind the parts it has no rows for. Days of the range
    without rows end up empty.
    """
    write_days(
        export_rows(rollup, start, end, pattern), path, clear=(start, end or start), sort=C.EXPORT_SORT
    )


def export_shards(
    rollup: DataFrame,
    path: str,
    start: str,
    end: str | None = None,
    pattern: str = NORMAL,
) -> DataFrame:
    """Replace the exported days like ``export_files``, but with one range of shard keys in each file,
    and return the manifest: the loader of a shard opens the files whose range holds it."""
    rows = export_rows(rollup, start, end, pattern)
    write_days(rows, path, clear=(start, end or start), sort=C.EXPORT_SORT, ranges=[SHARD])
    return shard_manifest(rollup.sparkSession, path, start, end)


def shard_manifest(
    spark: SparkSession, path: str, start: str, end: str | None = None
) -> DataFrame:
    """(dt, file, rows, min_shard, max_shard) of the files of some days; only one column is read."""
    stored = read_table(spark, path, f"{SHARD} int, dt string", days_of(start, end))
    return (
        read_days(stored, start, end)
        .groupBy("dt", F.input_file_name().alias("file"))
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.min(SHARD).alias("min_shard"),
            F.max(SHARD).alias("max_shard"),
        )
    )


def files_of_shards(manifest: DataFrame, first: int, last: int) -> list[str]:
    """The files that hold any of the shards ``first`` to ``last``."""
    hit = (F.col("min_shard") <= last) & (F.col("max_shard") >= first)
    return sorted(r["file"] for r in manifest.where(hit).select("file").collect())


def export_jdbc(
    rollup: DataFrame,
    url: str,
    table: str,
    start: str,
    end: str | None = None,
    pattern: str = NORMAL,
    properties: dict[str, str] | None = None,
    writers: int = C.EXPORT_WRITERS,
) -> None:
    """Append the export over JDBC in large batches, with a limited number of connections.

    Remove the old rows of the days first: a JDBC append cannot replace them.
    """
    (
        export_rows(rollup, start, end, pattern)
        .repartition(writers, SHARD)
        .sortWithinPartitions("dt", *C.EXPORT_SORT)
        .write.mode("append")
        .option("batchsize", C.EXPORT_BATCH_ROWS)
        .option("numPartitions", writers)
        .jdbc(url, table, properties=properties or {})
    )
