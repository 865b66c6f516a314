"""What several operators share: the shared scratch folder, stored frames, distributed ranks."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def scratch_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session, where
    all is one machine, gets a folder of its own when that is unset."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local[") and context.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="trailmeter-")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


#: Removes the shuffle files of a query when it has ended, not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_collecting: list[list[str]] = []


def stored(df: DataFrame) -> DataFrame:
    """Write a frame as Parquet to the shared folder and read it back: the lineage ends here, so a
    lost executor costs no recomputation of what is stored, and the shuffles behind it are removed."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    for paths in _collecting:
        paths.append(path)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def collected() -> Iterator[list[str]]:
    """The folders that stored() makes meanwhile."""
    paths: list[str] = []
    _collecting.append(paths)
    try:
        yield paths
    finally:
        # Not by remove(), which takes the first list that is equal, as an outer one may be.
        _collecting[:] = [other for other in _collecting if other is not paths]


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder that stored() made and that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table. Python workers are told where this package lies, for sessions that were started
    from another folder; a cluster has the package installed."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [root, *known]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ranked(
    df: DataFrame, keys: list[str], order: list[Column], name: str, chunk: Column, chunks: int
) -> DataFrame:
    """Number the rows of each key from 0, gapless, without bringing a key's rows into one task.

    chunk: a column of 0 to chunks - 1 that spreads a key's rows; rows are numbered chunk by chunk,
    inside a chunk by order (which must be total to be the same after a lost task). Only the counts of
    a key's chunks meet in one window.
    """
    cut = df.withColumn("_chunk", chunk)
    sizes = cut.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)],
        F.col("_chunk").alias("_c"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
    )
    inside = Window.partitionBy(*keys, "_chunk").orderBy(*order)
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    rank = (F.col("_before") + F.row_number().over(inside) - 1).cast("long")
    return (
        cut.join(sizes, [*same, F.col("_chunk") == F.col("_c")])
        .withColumn(name, rank)
        .drop("_chunk", "_c", "_before", *[f"_k{i}" for i in range(len(keys))])
    )


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the ends of links (a, b): the smallest id that can be reached.

    Every round takes the smallest label of the neighbours and then the label of one's label, so
    rounds grow with the logarithm of a chain. Labels are stored after each round; a hub's many links
    meet only in a minimum, which is taken before the shuffle.
    """
    both = stored(
        links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    )
    label = stored(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("l")).select("a", "l"))
    while True:
        near = (
            both.join(label.select(F.col("a").alias("b"), "l"), "b")
            .groupBy("a")
            .agg(F.min("l").alias("near"))
        )
        met = label.join(near, "a").select("a", F.col("l").alias("old"), F.least("l", "near").alias("l"))
        jump = label.select(F.col("a").alias("l"), F.col("l").alias("far"))
        new = stored(met.join(jump, "l", "left").select("a", "old", F.least("l", "far").alias("l")))
        if new.where("l <> old").isEmpty():
            return new.select(F.col("a").alias("node"), F.col("l").alias("component"))
        label = new.select("a", "l")
