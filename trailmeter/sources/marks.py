"""Commit markers: which days of a job are done, and from which input files.

A marker is an empty file whose name holds the day and a fingerprint of what the day was made from: the
paths, sizes and times of the input files of that day, and the job's options. A day whose inputs changed
has another fingerprint, so it is not taken for done.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Mapping

from pyspark.sql import SparkSession

# Spark does not read folders whose names begin with an underscore.
FOLDER = "_done"


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def _described(spark: SparkSession, path: str) -> list[str]:
    """Name, size and time of each data file below a folder; nothing if there is no such folder."""
    where, files = _files(spark, path)
    if not files.exists(where):
        return []
    found, every = [], files.listFiles(where, True)
    while every.hasNext():
        status = every.next()
        name = status.getPath().toString()
        if not status.getPath().getName().startswith(("_", ".")):
            found.append(f"{name} {status.getLen()} {status.getModificationTime()}")
    return sorted(found)


def fingerprint(
    spark: SparkSession, tables: Iterable[str], days: Iterable[str], options: Mapping[str, object]
) -> str:
    """One text for the files of some day folders of tables, and for options. A table that has no folder
    by day counts with all its files."""
    wanted, lines = sorted(set(days)), [f"{k}={options[k]!r}" for k in sorted(options)]
    for table in sorted(tables):
        where, files = _files(spark, table)
        names = [s.getPath().getName() for s in files.listStatus(where)] if files.exists(where) else []
        by_day = any(name.startswith("dt=") for name in names)
        folders = [f"{table}/dt={day}" for day in wanted] if by_day else [table]
        lines += [line for folder in folders for line in _described(spark, folder)]
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:32]


def is_done(spark: SparkSession, out: str, day: str, mark: str) -> bool:
    where, files = _files(spark, f"{out}/{FOLDER}/{day}.{mark}")
    return files.exists(where)


def set_done(spark: SparkSession, out: str, day: str, mark: str) -> None:
    """Mark a day; markers of the same day from other inputs go, as their rows were replaced."""
    folder, files = _files(spark, f"{out}/{FOLDER}")
    if files.exists(folder):
        for status in files.listStatus(folder):
            name = status.getPath().getName()
            if name.startswith(f"{day}.") and name != f"{day}.{mark}":
                files.delete(status.getPath(), False)
    where, files = _files(spark, f"{out}/{FOLDER}/{day}.{mark}")
    files.create(where, True).close()
