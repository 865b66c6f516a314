"""Click data-quality monitor: eight checks, merged to one row per day, traffic type and play mode.

There are two forms. The plain form runs every check on its own and merges the union. The fused form
reads the click fact twice (once for all counts, once for the match check) and the wide table once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trailmeter import constants as C
from trailmeter.functions.aggregates import money_sum_where
from trailmeter.functions.keys import click_item, click_session
from trailmeter.functions.labels import play_mode
from trailmeter.sources.days import read_days

KEYS = ["dt", "ad_traffic_type", "combine_play_type"]
CLICKS, WIDE = "clicks", "wide"


@dataclass(frozen=True)
class Check:
    """One grouped check: where it reads, which rows it keeps, and its measures.

    A measure takes the row filter and returns an aggregate over the rows that pass it.
    """

    name: str
    source: str
    keep: Callable[[], Column]
    measures: dict[str, Callable[[Column], Column]]


def _rows(keep: Column) -> Column:
    return F.count_if(keep)


def _rows_where(test: Callable[[], Column]) -> Callable[[Column], Column]:
    return lambda keep: F.count_if(keep & test())


def _money(column: str, test: Callable[[], Column] | None = None) -> Callable[[Column], Column]:
    # Without a test, NULL amounts alone give NULL, as a plain sum does.
    if test is None:
        return lambda keep: F.sum(F.when(keep, F.col(column).cast(C.MONEY))).cast("double")
    return lambda keep: F.when(
        F.count_if(keep) > 0, money_sum_where(keep & test(), F.col(column)).cast("double")
    )


def _off_site() -> Column:
    return F.col("loc") == C.OFF_SITE


def _billed(*partitions: str) -> Column:
    """The flag as a number: an empty or unreadable one is neither billed nor unbilled."""
    flag = F.col("is_bill").try_cast("int")
    return F.col("dp").isin(*partitions) & (flag != int(C.NOT_BILLED))


def _billed_as_text(*partitions: str) -> Column:
    """The flag as text, as the matching compares it."""
    return F.col("dp").isin(*partitions) & (F.col("is_bill") != C.NOT_BILLED)


def _performance() -> Column:
    return (F.col("sales_type") == C.PERFORMANCE_SALES) & (
        F.col("resource_type") == C.EXTERNAL_RESOURCE
    )


def _media() -> Column:
    return F.col("combine_play_type") == C.PLAY_MEDIA


def _is_cpc(column: str) -> Column:
    return F.lower(column) == C.CPC


def _event_type() -> Column:
    return F.col("event_type").try_cast("int")


def _matchable() -> Column:
    """Off-site rows of the delivery systems and business types that can be matched."""
    return (
        _off_site()
        & F.col("delivery_system_type").isin(C.DELIVERY_SYSTEMS)
        & F.col("business_type").isin(C.MATCH_BUSINESS_TYPES)
    )


EMPTY_PLACEMENT = Check(
    "empty_placement",
    CLICKS,
    _off_site,
    {
        "all_clicks": _rows,
        "placementid_isnull_clicks": _rows_where(lambda: F.col("placement_id") == ""),
    },
)
EMPTY_PLACEMENT_MONEY = Check(
    "empty_placement_money",
    WIDE,
    lambda: F.lit(True),
    {
        "consumption": _money("consumption"),
        "placementid_isnull_consumption": _money(
            "consumption", lambda: F.col("placement_id") == ""
        ),
    },
)
EMPTY_LAST_POSITION = Check(
    "empty_last_position",
    CLICKS,
    lambda: _billed(C.BILLED_PARTITION) & (F.col("loc") == C.LANDING_PAGE),
    {
        "repage_finance_clicks": _rows,
        "repage_last_placementid_isnull_finance_clicks": _rows_where(
            lambda: F.col("last_pos_id").isin("", "0")
        ),
    },
)
EMPTY_CLICK_ID = Check(
    "empty_click_id",
    CLICKS,
    lambda: _billed(C.BILLED_PARTITION) & _off_site(),
    {
        "finance_clicks": _rows,
        "clickid_isnull_finance_clicks": _rows_where(lambda: F.col("click_id") == ""),
    },
)
SUMMARY_CLICKS = Check(
    "summary_clicks",
    WIDE,
    lambda: _performance() & _media(),
    {"summary_finance_clicks": lambda keep: F.sum(F.when(keep, F.col("clicks")))},
)
DETAIL_CLICKS = Check(
    "detail_clicks",
    CLICKS,
    lambda: _billed(C.BILLED_PARTITION, C.SOCIAL_PARTITION) & _off_site() & _media(),
    {"detail_finance_clicks": _rows},
)
BILLED_TOTAL = Check(
    "billed_total",
    CLICKS,
    lambda: _billed(C.BILLED_PARTITION) & _off_site(),
    {"detail_rtb_clicks": _rows},
)
EVENT_SIDES = Check(
    "event_sides",
    CLICKS,
    lambda: F.col("dp").isin(C.BILLED_PARTITION, C.UNBILLED_PARTITION) & _off_site(),
    {
        "detail_s2s_clicks": _rows_where(lambda: ~_event_type().isin(C.CLIENT_EVENT_TYPES)),
        "detail_c2s_clicks": _rows_where(lambda: _event_type().isin(C.CLIENT_EVENT_TYPES)),
    },
)
SUMMARY_CPC = Check(
    "summary_cpc",
    WIDE,
    lambda: _is_cpc("ad_comsumption_type")
    & F.col("ad_business_type").isin(C.AUCTION_BUSINESS_TYPES)
    & _performance(),
    {"summary_cpc_consumption": _money("consumption")},
)
DETAIL_CPC = Check(
    "detail_cpc",
    CLICKS,
    lambda: _is_cpc("ad_billing_type")
    & (_billed(C.BILLED_PARTITION) | (F.col("dp") == C.SOCIAL_PARTITION))
    & _off_site(),
    {"detail_cpc_consumption": _money("total_price")},
)
GROUPED_CHECKS = [
    EMPTY_PLACEMENT,
    EMPTY_PLACEMENT_MONEY,
    EMPTY_LAST_POSITION,
    EMPTY_CLICK_ID,
    SUMMARY_CLICKS,
    DETAIL_CLICKS,
    BILLED_TOTAL,
    EVENT_SIDES,
    SUMMARY_CPC,
    DETAIL_CPC,
]
MATCHED = "matched"


def with_play_mode(df: DataFrame) -> DataFrame:
    return df.withColumn("combine_play_type", play_mode())


def run_check(check: Check, source: DataFrame) -> DataFrame:
    """One check on its own; a group exists only where a row passed the filter."""
    rows = with_play_mode(source).where(check.keep())
    every = F.lit(True)
    return rows.groupBy(*KEYS).agg(
        *[measure(every).alias(name) for name, measure in check.measures.items()]
    )


def _match_keys(clicks: DataFrame) -> DataFrame:
    return with_play_mode(clicks).withColumns({"_session": click_session(), "_item": click_item()})


def _usable(key: str, drop_empty: bool) -> Column:
    """NULL and '0' are no keys. '' is one, unless ``drop_empty``."""
    bad = ["0", ""] if drop_empty else ["0"]
    return F.col(key).isNotNull() & ~F.col(key).isin(bad)


def matched_clicks(clicks: DataFrame, drop_empty_keys: bool = False) -> DataFrame:
    """Client-side clicks with a billed click of the same session and item: as a semi join.

    Client rows are counted per key before the join, so a key that very many clicks share reaches
    the join as a few rows.
    """
    match = ["dt", "_session", "_item"]
    rows = _match_keys(clicks).where(
        _matchable() & _usable("_session", drop_empty_keys) & _usable("_item", drop_empty_keys)
    )
    client = rows.where(F.col("event_type").isin(*map(str, C.CLIENT_EVENT_TYPES)))
    counted = client.groupBy(*match, *KEYS[1:]).agg(F.count(F.lit(1)).alias("_rows"))
    billed = rows.where(_billed_as_text(C.BILLED_PARTITION)).select(*match).distinct()
    return (
        counted.join(billed, match, "left_semi")
        .groupBy(*KEYS)
        .agg(F.sum("_rows").alias("detail_rtb_join_c2s_clicks"))
    )


def matched_clicks_one_scan(clicks: DataFrame, drop_empty_keys: bool = False) -> DataFrame:
    """The same from one scan: count both sides per key, then look across the key's few rows.

    After the first aggregate a key has at most one row per traffic type and play mode, so the
    window stays small for every key.
    """
    match = ["dt", "_session", "_item"]
    is_client = F.col("event_type").isin(*map(str, C.CLIENT_EVENT_TYPES))
    is_billed = _billed_as_text(C.BILLED_PARTITION)
    rows = _match_keys(clicks).where(
        _matchable()
        & (is_client | is_billed)
        & _usable("_session", drop_empty_keys)
        & _usable("_item", drop_empty_keys)
    )
    counted = rows.groupBy(*match, *KEYS[1:]).agg(
        F.count_if(is_client).alias("_rows"), F.count_if(is_billed).alias("_billed")
    )
    billed_of_key = F.sum("_billed").over(Window.partitionBy(*match))
    return (
        counted.withColumn("_billed", billed_of_key)
        .where((F.col("_billed") > 0) & (F.col("_rows") > 0))
        .groupBy(*KEYS)
        .agg(F.sum("_rows").alias("detail_rtb_join_c2s_clicks"))
    )


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def summary_vs_detail_clicks(clicks: DataFrame, wide: DataFrame) -> DataFrame:
    """Billed clicks in the wide table and in the click fact, media play only, one row each."""
    return _union([run_check(SUMMARY_CLICKS, wide), run_check(DETAIL_CLICKS, clicks)])


def match_check(clicks: DataFrame, drop_empty_keys: bool = False) -> DataFrame:
    """Matched client-side clicks and all billed clicks, one row each."""
    matched = matched_clicks_one_scan(clicks, drop_empty_keys)
    return _union([matched, run_check(BILLED_TOTAL, clicks)])


def cpc_consumption(clicks: DataFrame, wide: DataFrame) -> DataFrame:
    """Cost-per-click consumption in the wide table and in the click fact, one row each."""
    return _union([run_check(SUMMARY_CPC, wide), run_check(DETAIL_CPC, clicks)])


def click_monitor_plain(
    clicks: DataFrame,
    wide: DataFrame,
    start: str,
    end: str | None = None,
    drop_empty_keys: bool = False,
) -> DataFrame:
    """Run each check, pad to one schema, keep the largest value per key with NULL as 0."""
    sources = {CLICKS: read_days(clicks, start, end), WIDE: read_days(wide, start, end)}
    frames = [run_check(check, sources[check.source]) for check in GROUPED_CHECKS]
    frames.append(matched_clicks(sources[CLICKS], drop_empty_keys))
    largest = [
        F.max(F.coalesce(F.col(name), F.lit(0))).cast("double").alias(name)
        for name in C.MONITOR_MEASURES
    ]
    return _union(frames).groupBy(*KEYS).agg(*largest)


def _present(name: str) -> str:
    return f"_rows_{name}"


def _all_checks(checks: list[Check], source: DataFrame) -> DataFrame:
    """All checks of one source in a single pass, with the number of rows each one kept."""
    aggregates = []
    for check in checks:
        # A NULL test fails, also where a measure adds a test of its own.
        keep = F.coalesce(check.keep(), F.lit(False))
        aggregates.append(F.count_if(keep).alias(_present(check.name)))
        aggregates += [measure(keep).alias(name) for name, measure in check.measures.items()]
    return with_play_mode(source).groupBy(*KEYS).agg(*aggregates)


def click_monitor(
    clicks: DataFrame,
    wide: DataFrame,
    start: str,
    end: str | None = None,
    drop_empty_keys: bool = False,
) -> DataFrame:
    """The merged monitor in its fused form; equal to :func:`click_monitor_plain`.

    The merge takes the larger of a measure and 0 as soon as another check has a row for the key,
    so the number of checks present is carried along to know when that happens.
    """
    clicks, wide = read_days(clicks, start, end), read_days(wide, start, end)
    matched = matched_clicks_one_scan(clicks, drop_empty_keys).withColumn(
        _present(MATCHED), F.lit(1)
    )
    frames = [
        _all_checks([c for c in GROUPED_CHECKS if c.source == CLICKS], clicks),
        _all_checks([c for c in GROUPED_CHECKS if c.source == WIDE], wide),
        matched,
    ]
    owner = {name: check.name for check in GROUPED_CHECKS for name in check.measures}
    owner["detail_rtb_join_c2s_clicks"] = MATCHED
    names = [check.name for check in GROUPED_CHECKS] + [MATCHED]
    one_row = (
        _union(frames)
        .groupBy(*KEYS)
        .agg(
            *[F.max(name).alias(name) for name in C.MONITOR_MEASURES],
            *[(F.max(_present(n)) > 0).cast("int").alias(_present(n)) for n in names],
        )
        .fillna(0)
    )
    present = reduce(lambda a, b: a + b, [F.col(_present(n)) for n in names])
    measures = []
    for name in C.MONITOR_MEASURES:
        others = F.col("_checks") > F.col(_present(owner[name]))
        value = F.col(name).cast("double")
        floored = F.when(others, F.greatest(value, F.lit(0.0))).otherwise(value)
        measures.append(floored.alias(name))
    return one_row.withColumn("_checks", present).where("_checks > 0").select(*KEYS, *measures)


def monitor_ratios(monitor: DataFrame) -> DataFrame:
    """Ratios and differences between the merged measures; a ratio over 0 is NULL."""
    ratios = {
        "repage_last_placementid_isnull_ratio": (
            "repage_last_placementid_isnull_finance_clicks",
            "repage_finance_clicks",
        ),
        "clickid_isnull_ratio": ("clickid_isnull_finance_clicks", "finance_clicks"),
        "rtb_join_c2s_ratio": ("detail_rtb_join_c2s_clicks", "detail_rtb_clicks"),
    }
    differences = {
        "finance_clicks_diff": ("summary_finance_clicks", "detail_finance_clicks"),
        "s2s_c2s_clicks_diff": ("detail_s2s_clicks", "detail_c2s_clicks"),
        "cpc_consumption_diff": ("summary_cpc_consumption", "detail_cpc_consumption"),
    }
    return monitor.select(
        *KEYS,
        *[F.try_divide(a, b).alias(name) for name, (a, b) in ratios.items()],
        *[(F.col(a) - F.col(b)).alias(name) for name, (a, b) in differences.items()],
    )
