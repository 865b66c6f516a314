"""Aggregate expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trailmeter.functions.keys import money
from trailmeter.functions.labels import unranked


def sum_where(keep: Column, value: Column) -> Column:
    """Rows that fail the test add 0, so the sum is 0 rather than NULL without a match."""
    return F.sum(F.when(keep, value).otherwise(F.lit(0)))


def money_sum(value: Column) -> Column:
    return F.sum(money(value))


def money_sum_where(keep: Column, value: Column) -> Column:
    return sum_where(keep, money(value))


def channel_set(ranked: Column) -> Column:
    """Distinct channels by priority, joined with ``+``, without their prefixes.

    The set holds at most one entry for each listed channel.
    """
    return unranked(F.concat_ws("+", F.sort_array(F.collect_set(ranked))))


def channel_number(label: Column) -> Column:
    pieces = F.size(F.split(label, r"\+"))
    return F.when(F.coalesce(label, F.lit("")) == "", F.lit(0)).otherwise(pieces)


