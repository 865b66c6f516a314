"""Joins that keep missing keys from piling up in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def left_join_missing_aside(
    left: DataFrame,
    right: DataFrame,
    key: str,
    also: list[str] = (),
    empty_is_missing: bool = True,
) -> DataFrame:
    """``left LEFT JOIN right`` on ``key`` and the columns ``also``; missing keys match nothing.

    A plain join sends every row without a key to one task. Here such a row gets a stand-in made
    from a hash of the row, so these rows spread over all tasks. Unlike a random stand-in it is the
    same when a lost task runs again. Whether a row has a key is part of the join condition, so no
    value of a key is set apart. Left rows that are equal in all columns share a stand-in: make them
    distinct first if there can be many. The left side is read once, and a right side that is grouped
    by ``also`` and ``key`` needs no second shuffle.
    """
    value = F.nullif(F.col(key), F.lit("")) if empty_is_missing else F.col(key)
    stand_in = F.xxhash64(*left.columns).cast("string")
    keyed = left.withColumns({"_key": F.coalesce(value, stand_in), "_known": value.isNotNull()})
    names = {name: f"_right_{name}" for name in [*also, key]}
    known = right.where(value.isNotNull()).withColumnsRenamed(names)
    same = [F.col(name) == F.col(names[name]) for name in also]
    on = [*same, F.col("_key") == F.col(names[key]), F.col("_known")]
    return keyed.join(known, on, "left").drop("_key", "_known", *names.values())


def unique_per_key(df: DataFrame, keys: dict[str, Column], **picks: Column) -> DataFrame:
    """One row per key before a join, so the join cannot fan out."""
    named = [column.alias(name) for name, column in keys.items()]
    return df.groupBy(*named).agg(*[column.alias(name) for name, column in picks.items()])


def merge_by_key(frames: list[DataFrame], keys: list[str], **picks: Column) -> DataFrame:
    """Combine several sources that share a key with one shuffle, where a row of joins needs many.

    Columns that a source lacks are NULL, which max, min and sum ignore.
    """
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return unique_per_key(union, {name: F.col(name) for name in keys}, **picks)


def flag_members(left: DataFrame, members: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """Left join to a distinct key set used only as an existence flag (never NULL)."""
    found = members.select(*keys).distinct().withColumn(flag, F.lit(True))
    return left.join(found, keys, "left").withColumn(flag, F.col(flag).isNotNull())
