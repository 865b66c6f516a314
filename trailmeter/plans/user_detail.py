"""Visit-path user detail: visits and orders of a day, their paths, and the user's tags."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trailmeter import constants as C
from trailmeter.functions.aggregates import channel_number, channel_set
from trailmeter.functions.keys import identity, normal_account
from trailmeter.functions.labels import (
    channel_label,
    first_known,
    frequency_label,
    lifecycle_label,
    ranked_channel,
)
from trailmeter.operators.joins import left_join_missing_aside, merge_by_key, unique_per_key
from trailmeter.operators.paths import (
    EventColumns,
    chunk_of,
    conversion_paths,
    number_segments,
)
from trailmeter.schemas import DETAIL_COLUMNS
from trailmeter.sources.days import lagged_day, read_days

VISIT, ORDER = "visit", "order"
USER = ["dt", "user_id"]
IDENTITY = ["dt", "unif_user_log_acct", "user_log_acct", "browser_uniq_id"]

EVENTS = EventColumns(
    keys=USER,
    time="event_time",
    # At equal times visits come before orders, then orders by their own keys.
    tie=["is_order", "parent_sale_ord_id", "user_log_acct"],
    is_order="is_order",
    channel="chan_second_cate_desc_bel",
    order_id="parent_sale_ord_id",
    amount="after_prefr_amount_1",
    visit_id="pv_id",
    visits_first=True,
)


@dataclass(frozen=True)
class UserTags:
    """The four tag tables: lifecycle, login status, account cycles, device cycles."""

    lifecycle: DataFrame
    status: DataFrame
    accounts: DataFrame
    devices: DataFrame


def unified_events(
    visits: DataFrame,
    order_facts: DataFrame,
    start: str,
    end: str | None = None,
    empty_account_is_missing: bool = True,
) -> DataFrame:
    """Visits and orders as one typed event table. Orders carry no device, channel or visit id."""
    seen = (
        read_days(visits, start, end)
        .where(F.col("platform") == C.APP)
        .select(
            *IDENTITY,
            "chan_second_cate_desc_bel",
            "pv_id",
            F.lit("").alias("parent_sale_ord_id"),
            F.col("request_tm").alias("event_time"),
            F.lit(0).cast(C.MONEY_SUM).alias("after_prefr_amount_1"),
            F.lit(VISIT).alias("attr"),
        )
    )
    events = seen.unionByName(
        order_facts.withColumn("attr", F.lit(ORDER)), allowMissingColumns=True
    )
    user = identity(
        F.col("unif_user_log_acct"), F.col("browser_uniq_id"), empty_account_is_missing
    )
    return events.withColumns(
        {
            "event_time": F.col("event_time").try_cast("timestamp_ntz"),
            "user_id": user,
            "is_order": F.col("attr") == ORDER,
        }
    )


def user_summary(events: DataFrame) -> DataFrame:
    """Per user and day: kind, distinct visits, channel label, number of channels, orders.

    Users without any id match nothing later on, so they are left out before the shuffle.
    """
    summary = (
        events.where(F.col("user_id").isNotNull())
        .groupBy(*USER)
        .agg(
            F.min("attr").alias("attr"),
            F.count_distinct("pv_id").alias("tc_visit_times"),
            channel_set(ranked_channel(F.col("chan_second_cate_desc_bel"))).alias("_label"),
            F.count_if("is_order").alias("_orders"),
        )
    )
    return summary.withColumns(
        {
            "tc_visit_chan_num": channel_number(F.col("_label")),
            "user_visit_freq": frequency_label(F.col("tc_visit_times")),
        }
    )


def event_sequence(events: DataFrame) -> DataFrame:
    """Each user's events with their segment. The list per user stays a set of rows."""
    known = events.where(F.col("user_id").isNotNull())
    return number_segments(known, EVENTS).drop("_orders")


def user_paths(
    events: DataFrame, distinct_visits: bool = False, cumulative: bool = False
) -> DataFrame:
    """Conversion paths of the users that have an id."""
    paths = conversion_paths(
        events.where(F.col("user_id").isNotNull()), EVENTS, distinct_visits, cumulative
    )
    return paths.select(
        *USER,
        F.col("chunk").alias("_chunk"),
        F.col("order_id").alias("parent_sale_ord_id"),
        F.col("path").alias("visit_chan_cate2_cds_with_times"),
        "all_times",
        F.col("before_first_order").cast("int").alias("tc_user_visits_before_deal"),
        F.col("amount").alias("tc_deal_after_prefr_amount_1"),
    )


def account_tags(tags: UserTags, start: str, end: str | None = None) -> DataFrame:
    """The three tag tables with an account key as one row per account and day they apply to.

    Only login status has the day itself; the other tags are those of the day before.
    """
    account = normal_account(F.col("unif_user_log_acct"))
    either = normal_account(F.coalesce("unif_user_log_acct", "user_log_acct"))
    before = lagged_day(1)
    lifecycle = read_days(tags.lifecycle, start, end, lag=1).select(
        before.alias("dt"), either.alias("_account"), "user_life_cycle_type"
    )
    status = read_days(tags.status, start, end).select(
        "dt", account.alias("_account"), "init_acct_status"
    )
    cycles = read_days(tags.accounts, start, end, lag=1).select(
        before.alias("dt"),
        account.alias("_account"),
        F.col("user_visitcycle_app").alias("_account_visits"),
        F.col("user_buycycle_all").alias("_account_buys"),
    )
    return merge_by_key(
        [lifecycle, status, cycles],
        ["dt", "_account"],
        user_life_cycle_type=F.max("user_life_cycle_type"),
        init_acct_status=F.min("init_acct_status"),
        _account_visits=F.max("_account_visits"),
        _account_buys=F.max("_account_buys"),
    )


def device_tags(tags: UserTags, start: str, end: str | None = None) -> DataFrame:
    return unique_per_key(
        read_days(tags.devices, start, end, lag=1),
        {"dt": lagged_day(1), "_device": F.col("browse_uniq_id")},
        _device_visits=F.max("user_visitcycle_app"),
        _device_buys=F.max("user_buycycle_all"),
    )


def tagged_identities(
    events: DataFrame, tags: UserTags, start: str, end: str | None = None
) -> DataFrame:
    """Distinct (account, login, device) per day with their tags: one row each, no fan-out."""
    identities = (
        events.select(*IDENTITY, "user_id")
        .distinct()
        .withColumns({"_account": F.col("unif_user_log_acct"), "_device": F.col("browser_uniq_id")})
    )
    tagged = left_join_missing_aside(
        identities, account_tags(tags, start, end), "_account", also=["dt"]
    )
    tagged = left_join_missing_aside(
        tagged, device_tags(tags, start, end), "_device", also=["dt"]
    )
    account = F.col("unif_user_log_acct")
    return tagged.select(
        *IDENTITY,
        "user_id",
        lifecycle_label(account, F.col("init_acct_status"), F.col("user_life_cycle_type")).alias(
            "user_life_cycle_type"
        ),
        first_known(
            F.col("_account_visits"), F.col("_device_visits"), default=C.NO_VISIT_CYCLE
        ).alias("user_visitcycle"),
        first_known(F.col("_account_buys"), F.col("_device_buys"), default=C.NO_BUY_CYCLE).alias(
            "user_buycycle"
        ),
    )


def members(
    events: DataFrame, tags: UserTags, start: str, end: str | None = None
) -> DataFrame:
    """Distinct identities per day with their tags and their user's summary."""
    return left_join_missing_aside(
        tagged_identities(events, tags, start, end),
        user_summary(events),
        "user_id",
        also=["dt"],
        empty_is_missing=False,
    )


def described(rows: DataFrame, version: str) -> DataFrame:
    """Add the labels and partition columns that follow from a version."""
    snapshot = version == C.SNAPSHOT
    other = C.OTHER_CHANNELS_SNAPSHOT if snapshot else C.OTHER_CHANNELS
    return rows.withColumns(
        {
            "platform": F.lit(C.APP),
            "tc_visit_chan": channel_label(F.col("tc_visit_chan_num"), F.col("_label"), other),
            "tp": F.lit(C.DAY),
            "dp": F.lit(C.SNAPSHOT if snapshot else C.STABLE),
        }
    )


def user_detail(
    visits: DataFrame,
    order_facts: DataFrame,
    tags: UserTags,
    start: str,
    end: str | None = None,
    version: str = C.STABLE,
    empty_account_is_missing: bool = True,
    distinct_visits: bool = False,
    cumulative: bool = False,
) -> DataFrame:
    """One row per identity and path of its user; a user without an id keeps one row without path.

    ``version`` is ``stable``, ``history`` (written as ``stable`` too) or ``snapshot``.
    With ``empty_account_is_missing=False`` all users whose account is '' are one user, and each of
    their identities gets each of their paths: the result grows with the square of their number.
    ``plans.factored`` keeps that reading without the pairs.
    """
    if version not in (C.STABLE, C.HISTORY, C.SNAPSHOT):
        raise ValueError(f"unknown version: {version!r}")
    events = unified_events(visits, order_facts, start, end, empty_account_is_missing)
    identities = members(events, tags, start, end)
    # Identities meet paths chunk by chunk, so a user with very many orders is several groups here.
    # Paths are laid out by chunk already. The last chunk may be empty; only chunk 0 never is.
    last_chunk = F.coalesce(chunk_of(F.col("_orders")), F.lit(0).cast("bigint"))
    chunks = F.explode(F.sequence(F.lit(0).cast("bigint"), last_chunk))
    detail = left_join_missing_aside(
        identities.withColumn("_chunk", chunks),
        user_paths(events, distinct_visits, cumulative),
        "user_id",
        also=["dt", "_chunk"],
        empty_is_missing=False,
    ).where((F.col("_chunk") == 0) | F.col("parent_sale_ord_id").isNotNull())
    labels = {"path_user_visit_freq": frequency_label(F.col("all_times"))}
    return described(detail, version).withColumns(labels).select(*DETAIL_COLUMNS)
