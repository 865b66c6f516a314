"""Labels derived from one row."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from trailmeter import constants as C


def play_mode(group: str = "ad_traffic_group", kind: str = "ad_traffic_type",
              campaign: str = "campaign_type") -> Column:
    """Own, shared or media play; the first match wins and NULLs fall through to media."""
    group, kind, campaign = F.col(group), F.col(kind), F.col(campaign)
    own = group.isin(C.OWN_GROUPS) & ~kind.isin(C.SHARED_TYPES)
    mixed = kind.isin(C.MIXED_TYPES) & campaign.isin(C.MIXED_CAMPAIGNS)
    return (
        F.when(own, C.PLAY_OWN)
        .when(kind.isin(C.SHARED_TYPES) | mixed, C.PLAY_SHARED)
        .otherwise(C.PLAY_MEDIA)
    )


def frequency_label(times: Column) -> Column:
    """Visit-count bucket; no visits and an unknown count share one label."""
    times = F.coalesce(times, F.lit(0))
    return (
        F.when(times < 7, F.concat(times.cast("string"), F.lit(C.TIMES)))
        .when(times < 11, C.FREQ_7_TO_10)
        .otherwise(C.FREQ_OVER_10)
    )


def channel_count_label(number: Column) -> Column:
    """'1', '2', '3' or '>=4'; anything else is ''."""
    return (
        F.when(number > 3, ">=4")
        .when(number.isin(1, 2, 3), number.cast("string"))
        .otherwise("")
    )


def channel_label(number: Column, label: Column, other: str = C.OTHER_CHANNELS) -> Column:
    """Keep a label of up to four channels. An unknown number is 'other', not ''."""
    return F.when(number == 0, "").when(number <= 4, label).otherwise(other)


def ranked_channel(channel: Column, channels: list[str] = C.CHANNELS) -> Column:
    """Prefix a channel with its priority (``1-``...); a channel not listed becomes NULL."""
    rank = F.array_position(F.array(*map(F.lit, channels)), channel)
    return F.when(rank > 0, F.concat(rank.cast("string"), F.lit("-"), channel))


def unranked(label: Column) -> Column:
    """Take every priority prefix out of a label."""
    return F.regexp_replace(label, r"(\d)(-)", "")


def lifecycle_label(account: Column, status: Column, lifecycle: Column) -> Column:
    """An empty (not NULL) account without a value keeps its NULL."""
    unknown = (account != "") & (lifecycle.isNull() | (lifecycle == "-1"))
    return (
        F.when(account.isNull() | (status == "0"), C.NO_ACCOUNT)
        .when(unknown, C.UNKNOWN_LIFECYCLE)
        .otherwise(lifecycle)
    )


def first_known(*choices: Column, default: str) -> Column:
    return F.coalesce(*choices, F.lit(default))


def has_click_macro(term: Column) -> Column:
    """True where a tracking macro was never replaced."""
    return term.contains(C.CLICK_ID_MACRO)


def grouping_bits(grouping_id: Column) -> Column:
    """Grouping id as eight binary digits; 1 means rolled up."""
    return F.lpad(F.bin(grouping_id.cast("bigint")), 8, "0")


def level_bits(kept: list[str], dimensions: list[str] = C.ROLLUP_DIMENSIONS) -> str:
    """The grouping bits of the set that keeps ``kept``."""
    return "".join("0" if name in kept else "1" for name in dimensions).rjust(8, "0")


def level_of(grouping_id: Column) -> Column:
    bits = grouping_bits(grouping_id)
    pairs = [(level_bits(kept), level) for level, kept in C.ROLLUP_LEVELS.items()]
    (first, level), *rest = pairs
    return reduce(lambda case, p: case.when(bits == p[0], p[1]), rest, F.when(bits == first, level))
