"""Day-partitioned tables: scans by day, range and quarter, and overwrites by partition."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trailmeter.constants import FILE_BYTES
from trailmeter.session import settings

# Bytes of shuffled rows that one task of a write takes, if the session names no size of its own.
TASK_BYTES = 64_000_000
TASK_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
# Removes the shuffle files of a query when it has ended, not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def parse_day(text: str) -> date:
    """A yyyy-MM-dd day; anything else is an error."""
    day = date.fromisoformat(text)
    if day.isoformat() != text:
        raise ValueError(f"not a yyyy-MM-dd day: {text!r}")
    return day


def parse_range(start: str, end: str | None) -> tuple[date, date]:
    first, last = parse_day(start), parse_day(end or start)
    if last < first:
        raise ValueError(f"range ends before it starts: {start}..{end}")
    return first, last


def read_table(
    spark: SparkSession, path: str, schema: StructType | str, days: Iterable[str] | None = None
) -> DataFrame:
    """Parquet with an explicit schema: no inference pass, and ``dt`` stays a string.

    With ``days`` only the folders of these days are listed, if ``dt`` is the outermost partition
    column. A table laid out otherwise, or without any of the days, is listed whole.
    """
    reader = spark.read.schema(schema).option("basePath", path)
    if days is not None:
        folders = ",".join(f"dt={day}" for day in sorted(set(days)))
        try:
            return reader.parquet(f"{path.rstrip('/')}/{{{folders}}}")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
    return reader.parquet(path)


def days_of(start: str, end: str | None, lag: int = 0) -> list[str]:
    """The days of a range and of the ``lag`` days before it."""
    first, last = parse_range(start, end)
    first -= timedelta(days=lag)
    return [(first + timedelta(days=n)).isoformat() for n in range((last - first).days + 1)]


def quarters_of(start: str, end: str | None) -> list[str]:
    """The first days of the quarters that a range touches."""
    return sorted({_quarter_first(parse_day(day)) for day in days_of(start, end)})


def read_days(df: DataFrame, start: str, end: str | None = None, lag: int = 0) -> DataFrame:
    """Rows of ``start``..``end``, or of the days ``lag`` days before those.

    Both limits are literals on the partition column, so other days are never opened; ``read_table``
    with its ``days`` does not list them either.
    """
    first, last = (d - timedelta(days=lag) for d in parse_range(start, end))
    return df.where(F.col("dt").between(first.isoformat(), last.isoformat()))


def lagged_day(lag: int, dt: str = "dt") -> Column:
    """The day a row of a lagged table belongs to."""
    return F.date_add(F.col(dt).cast("date"), lag).cast("string")


def quarter_start(day: Column) -> Column:
    return F.trunc(day.cast("date"), "quarter").cast("string")


def _quarter_first(day: date) -> str:
    return day.replace(month=(day.month - 1) // 3 * 3 + 1, day=1).isoformat()


def day_parts(
    rows: DataFrame, most: int, start: str, end: str | None = None
) -> list[tuple[str, str]]:
    """Ranges of days that follow each other and make up the whole range, each with ``most`` of ``rows``
    at most, or one day with rows.

    All shuffles of a job lie on disk until it ends. A range that is run part by part, one after the other,
    needs the disk of its largest part. The driver sees one number for each day.
    """
    first, last = parse_range(start, end)
    counts = read_days(rows, start, end).groupBy("dt").count().collect()
    begins, held = [first], 0
    for day, n in sorted(map(tuple, counts)):
        if held and held + n > most:
            begins.append(parse_day(day))
            held = 0
        held += n
    ends = [day - timedelta(days=1) for day in begins[1:]] + [last]
    return [(a.isoformat(), b.isoformat()) for a, b in zip(begins, ends, strict=True)]


def read_quarters(df: DataFrame, start: str, end: str | None, row_day: str) -> DataFrame:
    """Rows of ``start``..``end`` from a table partitioned by quarter start.

    Each row must lie in the quarter of its own day, also when the range crosses a quarter.
    """
    first, last = parse_range(start, end)
    partitions = F.col("dt").between(_quarter_first(first), _quarter_first(last))
    own_day = F.col(row_day)
    days = own_day.between(first.isoformat(), last.isoformat())
    return df.where(partitions & days & (F.col("dt") == quarter_start(own_day)))


def write_days(
    df: DataFrame,
    path: str,
    partitions: tuple[str, ...] = ("dt",),
    clear: tuple[str, str] | None = None,
    sort: Sequence[str] = (),
    ranges: Sequence[str] = (),
) -> None:
    """Overwrite the partitions that ``df`` has rows for; all others stay.

    The rebalance step joins small partitions and splits a big one over several tasks, where a
    repartition by ``dt`` would send a whole day to one. ``sort`` orders the rows of each file.

    Spark has one size for all shuffles of a query, so the one asked for here is also that of every join
    and window behind ``df``. Their rows take ten to twenty times their shuffled bytes while a task
    sorts them: so the size is that of a task, 64 MB, and not that of a file.

    With ``ranges`` each file holds a range of these columns that no other file of its partition
    overlaps, so a reader of a few values opens few files; neighbouring ranges are joined up to that size.

    The shuffles behind ``df`` are removed as soon as its rows are written, so jobs that follow each other
    do not add up on disk.

    ``clear=(start, end)`` also empties days of that range without any row, as an overwrite of a
    single static partition does. That is only possible with ``dt`` as the one partition column. It
    is a second step: if the job dies before it, such days keep their old rows until the next run.
    """
    spark = df.sparkSession
    days = None
    rows = df.repartitionByRange(*partitions, *ranges) if ranges else df.hint("rebalance", *partitions)
    if sort or ranges:
        rows = rows.sortWithinPartitions(*partitions, *ranges, *sort)
    if clear:
        if tuple(partitions) != ("dt",):
            raise ValueError("clear needs dt as the only partition column")
        days = Observation()
        known = F.to_json(F.sort_array(F.collect_set("dt")))
        # Above the sort: an empty input would take the metrics with it.
        rows = rows.observe(days, known.alias("written"))
    # The days are literals on every scan already; pruning by a join's keys only adds scans.
    sizes = {"spark.sql.optimizer.dynamicPartitionPruning.enabled": "false", CLEANUP: "true"}
    if spark.conf.get(TASK_SIZE, None) is None:
        sizes[TASK_SIZE] = str(min(TASK_BYTES, FILE_BYTES))
    if ranges:
        # Days stay whole without this; ranges would become as many files as there are cores.
        sizes["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "false"
    with settings(spark, sizes):
        (
            rows.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(*partitions)
            .parquet(path)
        )
    if days is not None:
        stored = read_days(read_table(spark, path, "dt string", days_of(*clear)), *clear)
        written = days.get["written"]
        empty = spark.createDataFrame([], StructType([f for f in df.schema if f.name != "dt"]))
        # One small write per stored day that this run had no rows for.
        for (day,) in stored.select("dt").distinct().collect():
            if f'"{day}"' not in written:
                empty.write.mode("overwrite").parquet(f"{path}/dt={day}")
