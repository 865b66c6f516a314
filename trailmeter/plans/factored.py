"""The user detail without its pairs: identities on one side, paths on the other.

The detail repeats each path of a user for each identity of that user. If the empty account counts as an
account, all users without one are a single user, and the pairs grow with the square of their number. Here
the two sides stay apart, so a user with n identities and m paths is n + m rows. The rollup takes the
largest value of each label per user, order or device, and reads both sides without pairing them.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmeter import constants as C
from trailmeter.functions.labels import channel_count_label, frequency_label
from trailmeter.plans.rollup import (
    AMOUNT,
    BEFORE,
    DEVICES,
    DIMENSIONS,
    PATH,
    PATH_DIMENSIONS,
    VISITS,
    levels_of,
    paths_of,
)
from trailmeter.plans.user_detail import (
    IDENTITY,
    USER,
    UserTags,
    described,
    members,
    unified_events,
    user_paths,
)
from trailmeter.sources.days import read_table, write_days

PARTS = ["dt", "tp", "dp"]
MEMBER_COLUMNS = [
    "platform", "user_id", *IDENTITY[1:], "attr", "user_life_cycle_type", "tc_visit_chan",
    "tc_visit_chan_num", "user_visit_freq", "tc_visit_times", "user_visitcycle", "user_buycycle",
]
PATH_COLUMNS = [
    "user_id", "parent_sale_ord_id", "visit_chan_cate2_cds_with_times",
    "tc_user_visits_before_deal", "tc_deal_after_prefr_amount_1", "path_user_visit_freq",
]
# Labels of which a user, an order or a device takes the largest value.
PLAIN = ["user_visitcycle", "user_buycycle", "user_life_cycle_type"]
LABELS = [*PLAIN, "tc_visit_chan", "user_visit_freq", "tc_visit_chan_num"]
PATH_LABELS = [*PLAIN, "tc_visit_chan_num"]


@dataclass(frozen=True)
class FactoredDetail:
    """``members``: one row per identity. ``paths``: one row per path of a user, for users with an id."""

    members: DataFrame
    paths: DataFrame


def factored_detail(
    visits: DataFrame,
    order_facts: DataFrame,
    tags: UserTags,
    start: str,
    end: str | None = None,
    version: str = C.STABLE,
    empty_account_is_missing: bool = False,
    distinct_visits: bool = False,
    cumulative: bool = False,
) -> FactoredDetail:
    """Both sides of the detail; as the sources have it, the empty account is one user."""
    if version not in (C.STABLE, C.HISTORY, C.SNAPSHOT):
        raise ValueError(f"unknown version: {version!r}")
    events = unified_events(visits, order_facts, start, end, empty_account_is_missing)
    people = described(members(events, tags, start, end), version)
    paths = user_paths(events, distinct_visits, cumulative)
    paths = paths.withColumn("path_user_visit_freq", frequency_label(F.col("all_times")))
    parts = {"tp": F.lit(C.DAY), "dp": F.lit(C.SNAPSHOT if version == C.SNAPSHOT else C.STABLE)}
    return FactoredDetail(
        people.select(*MEMBER_COLUMNS, *PARTS), paths.withColumns(parts).select(*PATH_COLUMNS, *PARTS)
    )


def expanded(detail: FactoredDetail) -> DataFrame:
    """The rows of the plain detail: every identity with every path of its user. For few identities."""
    return _on_user(detail.members, detail.paths, ["user_id", *PARTS])


def _on_user(people: DataFrame, paths: DataFrame, keys: list[str]) -> DataFrame:
    """``people`` with the paths of their user; one without an id has the label of no visit."""
    names = {name: f"_of_{name}" for name in keys}
    same = [F.col(name) == F.col(other) for name, other in names.items()]
    joined = people.join(paths.withColumnsRenamed(names), same, "left")
    none = F.col("_of_user_id").isNull()
    label = F.when(none, frequency_label(F.lit(None).cast("bigint"))).otherwise(F.col(PATH[0]))
    return joined.withColumn(PATH[0], label).drop(*names.values())


def stacked(detail: FactoredDetail) -> DataFrame:
    """Both sides as one set of rows; ``side`` tells them apart."""
    people = detail.members.withColumn("side", F.lit("member"))
    paths = detail.paths.withColumn("side", F.lit("path"))
    return people.unionByName(paths, allowMissingColumns=True)


def write_factored(detail: FactoredDetail, path: str) -> None:
    """Each side replaces its own days and versions."""
    write_days(detail.members, f"{path}/members", tuple(PARTS))
    write_days(detail.paths, f"{path}/paths", tuple(PARTS))


def read_factored(spark: SparkSession, path: str) -> FactoredDetail:
    people = read_table(spark, f"{path}/members", MEMBER_SCHEMA)
    return FactoredDetail(people, read_table(spark, f"{path}/paths", PATH_SCHEMA))


_NUMBERS = {
    "tc_visit_chan_num": "int",
    "tc_visit_times": "bigint",
    "tc_user_visits_before_deal": "int",
    "tc_deal_after_prefr_amount_1": C.MONEY_SUM,
}
MEMBER_SCHEMA = ", ".join(f"{c} {_NUMBERS.get(c, 'string')}" for c in [*MEMBER_COLUMNS, *PARTS])
PATH_SCHEMA = ", ".join(f"{c} {_NUMBERS.get(c, 'string')}" for c in [*PATH_COLUMNS, *PARTS])


def _largest(names: list[str]) -> list[Column]:
    return [F.max(name).alias(name) for name in names]


def _both(a: str, b: str, names: list[str]) -> list[Column]:
    """The larger of two labels, as MAX over both rows has it: a NULL loses."""
    return [F.greatest(F.col(f"{a}.{n}"), F.col(f"{b}.{n}")).alias(n) for n in names]


def _with_label(rows: DataFrame) -> DataFrame:
    return rows.withColumn("is_visit_multi_chan", channel_count_label(F.col("tc_visit_chan_num")))


def _of_users(people: DataFrame, paths: DataFrame, by_path: bool) -> tuple[DataFrame, DataFrame]:
    """The order and visit facets. A user's labels are the same on all its pairs, so they are taken
    once per user; users without an id have no path and are one group, as NULL is."""
    users = people.groupBy(*USER).agg(
        *_largest(LABELS), F.min("attr").alias("attr"), F.max("tc_visit_times").alias("_visits")
    )
    pairs = _on_user(users, paths, USER)
    path = PATH if by_path else []
    plain = [F.first(c).alias(c) for c in [*LABELS, "attr", "_visits"]]
    orders = pairs.groupBy(*USER, "parent_sale_ord_id", *path).agg(
        *plain,
        F.max("tc_user_visits_before_deal").alias("_before"),
        F.max("tc_deal_after_prefr_amount_1").alias("_amount"),
    )
    visits = pairs.groupBy(*USER, *path).agg(*plain) if by_path else users
    return orders, visits


def _of_devices(people: DataFrame) -> DataFrame:
    """The visitor facet without paths: identities alone decide."""
    seen = people.where(F.col("browser_uniq_id") != "")
    return seen.groupBy("dt", "browser_uniq_id").agg(*_largest(LABELS)).withColumn(DEVICES, F.lit(1))


def _of_devices_by_path(people: DataFrame, paths: DataFrame) -> DataFrame:
    """The visitor facet by path, as numbers of devices per group of labels and path.

    A device of one user is seen on each path of that user with the same labels, so devices are counted
    by user and labels before they meet the paths. A device of several users is counted like that for
    the one with the most paths; each other user's paths are corrected one by one: the device is added
    with the labels of all its users that have the path, and taken off the first user's count if that
    one has the path too.
    """
    seen = people.where(F.col("browser_uniq_id") != "")
    labels = F.struct(*PATH_LABELS)
    per_user = seen.groupBy("dt", "browser_uniq_id", "user_id").agg(*_largest(PATH_LABELS))
    per_user = per_user.select("dt", "browser_uniq_id", "user_id", labels.alias("own"))
    distinct = paths.select(*USER, *PATH).distinct()
    number = distinct.groupBy(*USER).agg(F.count(F.lit(1)).alias("_paths"))
    ranked = per_user.join(number, USER, "left")
    rank = F.struct(F.coalesce("_paths", F.lit(0)).alias("n"), F.col("user_id").alias("user_id"))
    first = ranked.groupBy("dt", "browser_uniq_id").agg(F.max(rank).alias("_first"))
    first = first.select("dt", "browser_uniq_id", F.col("_first.user_id").alias("_main"))
    ranked = ranked.drop("_paths").join(first, ["dt", "browser_uniq_id"])
    main = ranked.where(F.col("user_id") == F.col("_main"))
    counted = main.groupBy(*USER, "own").agg(F.count(F.lit(1)).alias(DEVICES)).join(distinct, USER)
    counted = counted.select("dt", F.col("own").alias("labels"), *PATH, DEVICES)
    others = ranked.where(F.col("user_id") != F.col("_main")).join(distinct, USER)
    others = others.groupBy("dt", "browser_uniq_id", F.col("_main").alias("user_id"), *PATH).agg(
        *[F.max(F.col(f"own.{c}")).alias(c) for c in PATH_LABELS]
    )
    others = others.select("dt", "browser_uniq_id", "user_id", *PATH, labels.alias("other"))
    has = distinct.withColumn("_has", F.lit(True))
    fixed = others.join(main.drop("_main"), ["dt", "browser_uniq_id", "user_id"])
    fixed = fixed.join(has, [*USER, *PATH], "left").withColumn("_has", F.col("_has").isNotNull())
    joint = F.when(F.col("_has"), F.struct(*_both("own", "other", PATH_LABELS))).otherwise(F.col("other"))
    change = F.array(
        F.struct(joint.alias("labels"), F.lit(1).alias(DEVICES)),
        F.struct(F.col("own").alias("labels"), F.when(F.col("_has"), -1).otherwise(0).alias(DEVICES)),
    )
    fixed = fixed.select("dt", *PATH, F.inline(change))
    both = counted.unionByName(fixed).groupBy("dt", "labels", *PATH).agg(F.sum(DEVICES).alias(DEVICES))
    # Groups whose last device was taken off are no groups.
    return both.where(F.col(DEVICES) > 0).select("dt", "labels.*", *PATH, DEVICES)


def factored_facets(
    detail: FactoredDetail, start: str, end: str | None, version: str, by_path: bool = False
) -> DataFrame:
    """The facet rows of ``rollup.facets``, from both sides of the detail; devices are counted."""
    kept = C.SNAPSHOT if version == C.SNAPSHOT else C.STABLE
    chosen = (F.col("tp") == C.DAY) & (F.col("dp") == kept) & F.col("dt").between(start, end or start)
    people = detail.members.where(chosen & (F.col("platform") == C.APP))
    paths = detail.paths.where(chosen)
    orders, visits = _of_users(people, paths, by_path)
    devices = _of_devices_by_path(people, paths) if by_path else _of_devices(people)
    zero = F.lit(0).cast("bigint")
    money = F.lit(0).cast(C.MONEY_SUM)
    none = F.lit(None).cast("string")
    is_order = F.col("attr") == "order"
    order_id = F.nullif(F.col("parent_sale_ord_id"), F.lit(""))

    def facet(rows: DataFrame, devices=zero, visits=zero, before=zero, amount=money, user=none, order=none):
        return _with_label(rows).select(
            "dt",
            *(PATH_DIMENSIONS if by_path else DIMENSIONS),
            devices.cast("bigint").alias(DEVICES),
            visits.cast("bigint").alias(VISITS),
            before.cast("bigint").alias(BEFORE),
            amount.cast(C.MONEY_SUM).alias(AMOUNT),
            user.alias("_user"),
            order.alias("_order"),
        )

    buyer = F.when(is_order, F.col("user_id"))
    frames = [
        facet(orders, before=F.col("_before"), amount=F.col("_amount"), user=buyer, order=order_id),
        facet(devices, devices=F.col(DEVICES)),
        facet(visits, visits=F.col("_visits")),
    ]
    return reduce(DataFrame.unionByName, frames)


def rollup_factored(
    detail: FactoredDetail, start: str, end: str | None = None, version: str = C.STABLE
) -> DataFrame:
    """All levels of one version, equal to the rollup of the pairs with the empty account as a user."""
    levels = levels_of(factored_facets(detail, start, end, version), version)
    return levels.unionByName(paths_of(factored_facets(detail, start, end, version, True), version))
