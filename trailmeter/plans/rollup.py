"""Rollup of the user detail over seven grouping sets, and one cut by path."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmeter import constants as C
from trailmeter.functions.keys import identity
from trailmeter.functions.labels import channel_count_label, level_of
from trailmeter.schemas import ROLLUP_COLUMNS
from trailmeter.sources.days import read_days

DIMENSIONS = C.ROLLUP_DIMENSIONS
PATH = ["path_user_visit_freq", "visit_chan_cate2_cds_with_times"]
PATH_DIMENSIONS = [
    "user_life_cycle_type",
    "user_buycycle",
    "user_visitcycle",
    "is_visit_multi_chan",
    *PATH,
]
# Measures of a facet row, before they are named for a version.
VISITS, BEFORE, AMOUNT, DEVICES = "tc_user_visits", "before", "amount", "uv"
SUMS = [DEVICES, VISITS, BEFORE, AMOUNT]
USERS, ORDERS = "users", "orders"
# Detail rows a task takes at most, before each becomes three facet rows, and before the plain distinct
# counts make up to 28 rows of each of those.
FACET_ROWS, PLAIN_ROWS = 500_000, 100_000
VERSIONED = {
    BEFORE: "tc_user_visits_before_deal",
    USERS: "deal_user_num_toc",
    ORDERS: "deal_order_num_toc",
    AMOUNT: "deal_after_prefr_amount_1_toc",
}


def _stored_version(version: str) -> str:
    """The name under which the detail keeps a version."""
    if version not in (C.STABLE, C.SNAPSHOT, "history"):
        raise ValueError(f"unknown version {version!r}")
    return C.STABLE if version == "history" else version


def _detail_rows(
    detail: DataFrame, start: str, end: str | None, version: str, empty_account_is_missing: bool
) -> DataFrame:
    version = _stored_version(version)
    rows = read_days(detail, start, end).where(
        (F.col("platform") == C.APP) & (F.col("tp") == C.DAY) & (F.col("dp") == version)
    )
    user = identity(
        F.col("unif_user_log_acct"), F.col("browser_uniq_id"), empty_account_is_missing
    )
    return rows.withColumn("user_id", user)


def _dealt(rows: DataFrame, n: int, most: int, *keys: str) -> DataFrame:
    """Rows dealt by keys over tasks, one for each ``most`` of n rows.

    Spark sizes tasks by bytes as they are stored. A row of ids and few labels takes fifteen bytes there and
    many hundreds while it is sorted or counted, so tasks of those sizes grow to gigabytes.
    """
    return rows.repartition(max(1, math.ceil(n / most)), *keys)


def _user_dimensions(by_path: bool) -> list[Column]:
    plain = ["user_visitcycle", "user_buycycle", "user_life_cycle_type"]
    if not by_path:
        plain += ["tc_visit_chan", "user_visit_freq"]
    number = F.max("tc_visit_chan_num")
    return [F.max(name).alias(name) for name in plain] + [
        channel_count_label(number).alias("is_visit_multi_chan")
    ]


def facets(
    detail: DataFrame, start: str, end: str | None, version: str, by_path: bool = False,
    empty_account_is_missing: bool = True,
) -> DataFrame:
    """The order, visitor and visit facets in one scan.

    They are three groupings of the same rows: by user and order, by device, and by user. Each gets
    the largest value of its dimensions, and fills only the measures it stands for. With ``by_path``
    the path and its frequency label join every grouping. The detail's rows are counted first, so it
    should be a stored one; only if they are too many for each core they are dealt anew.
    """
    rows = _detail_rows(detail, start, end, version, empty_account_is_missing)
    n = rows.count()
    if n > FACET_ROWS * detail.sparkSession.sparkContext.defaultParallelism:
        # The login is no key of a grouping, but all that tells rows without any id apart.
        ids = ["user_id", "browser_uniq_id", "user_log_acct", "parent_sale_ord_id"]
        rows = _dealt(rows, n, FACET_ROWS, "dt", *ids)
    path = PATH if by_path else []
    sets = [
        ["dt", "user_id", "parent_sale_ord_id", *path],
        ["dt", "browser_uniq_id", *path],
        ["dt", "user_id", *path],
    ]
    keys = ["dt", "user_id", "browser_uniq_id", "parent_sale_ord_id", *path]
    # The two bits of device and order tell the facets apart.
    bits = F.grouping("browser_uniq_id") * 2 + F.grouping("parent_sale_ord_id")
    grouped = rows.groupingSets([[F.col(k) for k in s] for s in sets], *[F.col(k) for k in keys])
    wide = grouped.agg(
        bits.alias("_facet"),
        *_user_dimensions(by_path),
        F.min("attr").alias("_attr"),
        F.max("tc_visit_times").alias("_visits"),
        F.max("tc_user_visits_before_deal").alias("_before"),
        F.max("tc_deal_after_prefr_amount_1").alias("_amount"),
    )
    order, visitor = F.col("_facet") == 2, F.col("_facet") == 1
    visit = F.col("_facet") == 3
    dimensions = PATH_DIMENSIONS if by_path else DIMENSIONS
    zero = F.lit(0).cast("bigint")
    return wide.where(~visitor | (F.col("browser_uniq_id") != "")).select(
        "dt",
        *dimensions,
        F.when(visitor, F.lit(1)).otherwise(0).cast("bigint").alias(DEVICES),
        F.when(visit, F.col("_visits")).otherwise(zero).alias(VISITS),
        F.when(order, F.col("_before")).otherwise(F.lit(0)).cast("bigint").alias(BEFORE),
        F.when(order, F.col("_amount")).otherwise(F.lit(0)).cast(C.MONEY_SUM).alias(AMOUNT),
        F.when(order & (F.col("_attr") == "order"), F.col("user_id")).alias("_user"),
        F.when(order, F.nullif("parent_sale_ord_id", F.lit(""))).alias("_order"),
    )


def facets_by_union(
    detail: DataFrame, start: str, end: str | None, version: str, by_path: bool = False,
    empty_account_is_missing: bool = True,
) -> DataFrame:
    """The same facets as three aggregates over three scans: the form the fused one is checked by."""
    rows = _detail_rows(detail, start, end, version, empty_account_is_missing)
    path = PATH if by_path else []

    def grouped(source: DataFrame, *keys: str, **measures: Column) -> DataFrame:
        return source.groupBy("dt", *keys, *path).agg(
            *_user_dimensions(by_path), *[m.alias(name) for name, m in measures.items()]
        )

    no_visits = {VISITS: F.lit(0).cast("bigint")}
    no_deals = {BEFORE: F.lit(0).cast("bigint"), AMOUNT: F.lit(0).cast(C.MONEY_SUM)}
    order = grouped(
        rows,
        "user_id",
        "parent_sale_ord_id",
        _attr=F.min("attr"),
        **{
            BEFORE: F.max("tc_user_visits_before_deal").cast("bigint"),
            AMOUNT: F.max("tc_deal_after_prefr_amount_1"),
        },
    ).withColumns(no_visits)
    visitor = grouped(rows.where(F.col("browser_uniq_id") != ""), "browser_uniq_id")
    visit = grouped(rows, "user_id", **{VISITS: F.max("tc_visit_times")})
    frames = [order, visitor.withColumns({**no_visits, **no_deals}), visit.withColumns(no_deals)]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _version_columns(df: DataFrame, version: str) -> DataFrame:
    """Snapshot measures go to the ``t1`` columns and settled ones to ``t2``; the others are 0."""
    version = _stored_version(version)
    used, unused = ("t1", "t2") if version == C.SNAPSHOT else ("t2", "t1")
    columns = {}
    for name, base in VERSIONED.items():
        kind = "double" if name == AMOUNT else "bigint"
        columns[f"{base}_{used}"] = F.col(name).cast(kind)
        columns[f"{base}_{unused}"] = F.lit(0).cast(kind)
    # A column the cut does not group by is NULL.
    for name in [*DIMENSIONS, *PATH]:
        if name not in df.columns:
            columns[name] = F.lit(None).cast("string")
    columns.update(platform=F.lit(C.APP), tp=F.lit(C.DAY), dp=F.lit(version))
    return df.withColumns(columns).select(*ROLLUP_COLUMNS)


def _sums() -> list[Column]:
    return [F.sum(name).alias(name) for name in SUMS]


def _by_id(rows: DataFrame, dimensions: list[str]) -> DataFrame:
    """Facet rows added up per group, kind of id and id.

    An order row goes on twice: as its order, with the sums, and as its user, with none. Rows of the
    other facets have no id, so they shrink to one row per group here.
    """
    sums = [F.col(name) for name in SUMS]
    nothing = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in SUMS]
    as_order = F.struct(F.lit(ORDERS).alias("_kind"), F.col("_order").alias("_id"), *sums)
    as_user = F.struct(F.lit(USERS).alias("_kind"), F.col("_user").alias("_id"), *nothing)
    return (
        rows.select("dt", *dimensions, F.inline(F.array(as_order, as_user)))
        .where((F.col("_kind") == ORDERS) | F.col("_id").isNotNull())
        .groupBy("dt", *dimensions, "_kind", "_id")
        .agg(*_sums())
    )


def _counts() -> list[Column]:
    """After a grouping by id each distinct id is one row, so a plain count is exact."""
    known = F.col("_id").isNotNull()
    return [F.count_if(known & (F.col("_kind") == kind)).alias(kind) for kind in (USERS, ORDERS)]


def _by_level(df: DataFrame, *also: str):
    sets = [["dt", *also, *kept] for kept in C.ROLLUP_LEVELS.values()]
    columns = ["dt", *also, *DIMENSIONS]
    return df.groupingSets(
        [[F.col(name) for name in s] for s in sets], *[F.col(name) for name in columns]
    )


def _level(*also: str) -> Column:
    # Day and kind are in every set, so their bits are 0 and only the dimensions count.
    return level_of(F.grouping_id("dt", *also, *DIMENSIONS)).alias("lvl")


def rollup_levels(
    detail: DataFrame, start: str, end: str | None = None, version: str = C.STABLE,
    empty_account_is_missing: bool = True,
) -> DataFrame:
    """Levels 0-5 and 7.

    The grouping sets expand one row per group and id. Grouped again by id, every distinct user and
    order is one row, so the last step counts rows and needs no distinct aggregate. No step groups
    by a level alone before its rows are combined on the map side.
    """
    return levels_of(facets(detail, start, end, version, False, empty_account_is_missing), version)


def levels_of(rows: DataFrame, version: str) -> DataFrame:
    """Levels 0-5 and 7 of facet rows."""
    finest = _by_id(rows, DIMENSIONS)
    per_id = _by_level(finest, "_kind", "_id").agg(_level("_kind", "_id"), *_sums())
    levels = per_id.groupBy("dt", "lvl", *DIMENSIONS).agg(*_sums(), *_counts())
    return _version_columns(levels, version)


def rollup_levels_plain(
    detail: DataFrame, start: str, end: str | None = None, version: str = C.STABLE,
    empty_account_is_missing: bool = True,
) -> DataFrame:
    """Levels 0-5 and 7 as one grouping-sets query with distinct counts over the facet union."""
    rows = _plain_rows(detail, start, end, version, False, empty_account_is_missing)
    levels = _by_level(rows).agg(_level(), *_plain_measures())
    return _version_columns(levels, version)


def _plain_rows(
    detail: DataFrame, start: str, end: str | None, version: str, by_path: bool,
    empty_account_is_missing: bool,
) -> DataFrame:
    """The facet union, dealt over as many tasks as the detail's rows ask for: each facet row becomes one
    for each grouping set and distinct count before anything is combined."""
    rows = facets_by_union(detail, start, end, version, by_path, empty_account_is_missing)
    n = _detail_rows(detail, start, end, version, empty_account_is_missing).count()
    return _dealt(rows, n, PLAIN_ROWS, *rows.columns)


def _plain_measures() -> list[Column]:
    return [
        F.count_distinct("browser_uniq_id").alias(DEVICES),
        *[F.sum(name).alias(name) for name in (VISITS, BEFORE, AMOUNT)],
        F.count_distinct(F.when(F.col("_attr") == "order", F.col("user_id"))).alias(USERS),
        F.count_distinct(F.nullif("parent_sale_ord_id", F.lit(""))).alias(ORDERS),
    ]


def rollup_paths(
    detail: DataFrame, start: str, end: str | None = None, version: str = C.STABLE,
    empty_account_is_missing: bool = True,
) -> DataFrame:
    """Level 6: by path, path frequency and user tags. Visits are those of the user's whole day."""
    return paths_of(facets(detail, start, end, version, True, empty_account_is_missing), version)


def paths_of(rows: DataFrame, version: str) -> DataFrame:
    """Level 6 of facet rows that have the path."""
    per_id = _by_id(rows, PATH_DIMENSIONS)
    paths = per_id.groupBy("dt", *PATH_DIMENSIONS).agg(*_sums(), *_counts())
    return _version_columns(paths.withColumn("lvl", F.lit(C.PATH_LEVEL)), version)


def rollup_paths_plain(
    detail: DataFrame, start: str, end: str | None = None, version: str = C.STABLE,
    empty_account_is_missing: bool = True,
) -> DataFrame:
    rows = _plain_rows(detail, start, end, version, True, empty_account_is_missing)
    paths = rows.groupBy("dt", *PATH_DIMENSIONS).agg(*_plain_measures())
    return _version_columns(paths.withColumn("lvl", F.lit(C.PATH_LEVEL)), version)


def rollup(
    detail: DataFrame, start: str, end: str | None = None, version: str = C.STABLE,
    empty_account_is_missing: bool = True,
) -> DataFrame:
    """All levels of one version."""
    return rollup_levels(detail, start, end, version, empty_account_is_missing).unionByName(
        rollup_paths(detail, start, end, version, empty_account_is_missing)
    )
