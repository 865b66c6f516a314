"""Session settings the jobs are written for."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import SparkSession

from trailmeter.constants import FILE_BYTES

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Several joins on one key follow each other; split a hot key there as well.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.files.maxPartitionBytes": str(FILE_BYTES),
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The days are literals on every scan already; pruning by a join's keys only adds scans.
    "spark.sql.optimizer.dynamicPartitionPruning.enabled": "false",
    # Keeping the Python call site of every expression makes plans slow to build.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # A second copy of a write task may leave rows behind in a sink that only appends.
    "spark.speculation": "false",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]):
    """Run one action under other runtime settings, then put the old ones back."""
    old = {key: spark.conf.get(key, None) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in old.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
