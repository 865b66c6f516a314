"""Running sums over groups of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _sum_before(df: DataFrame, keys: list[str], slots: list[str], value: str) -> DataFrame:
    """(keys, slots, _base, _total): what the earlier slots of a key add up to, and the whole key.

    Slots are nested, coarse ones first. At each level one window sees the slots of one slot above.
    With one level, keys that add up to 0 are left out.
    """
    before = None
    for level in range(1, len(slots) + 1):
        upper, slot = [*keys, *slots[: level - 1]], slots[level - 1]
        sums = df.groupBy(*upper, slot).agg(F.sum(value).alias("_sum"))
        pieces = Window.partitionBy(*upper)
        earlier = pieces.orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
        here = F.coalesce(F.sum("_sum").over(earlier), F.lit(0))
        if before is None:
            sums = sums.select(*upper, slot, here.alias("_base"), F.sum("_sum").over(pieces).alias("_total"))
            # With more levels to join, a filter here would only be turned into one more scan (pruning of
            # partitions by the keys it leaves).
            before = sums.where(F.col("_total") > 0) if len(slots) == 1 else sums
        else:
            sums = sums.select(*upper, slot, here.alias("_here")).join(before, upper)
            before = sums.withColumn("_base", F.col("_base") + F.col("_here")).drop("_here")
    return before


def running_sum_before(
    df: DataFrame,
    keys: list[str],
    slot: str | list[str],
    order: list,
    value: str,
    before: str,
    total: str | None = None,
) -> DataFrame:
    """Add the sum of ``value`` over all earlier rows of the same ``keys``.

    One window per key would put a whole key into one task. ``slot`` cuts each key into pieces that
    follow the order (all rows of a smaller slot come first): a window inside each piece counts its
    own rows, and windows over one row per piece give what the earlier pieces add up to. A list of
    nested slots, coarse ones first, keeps those windows short as well.
    ``value`` must not be negative or NULL.
    ``total`` optionally names a column for the sum over the whole key.
    """
    slots = [slot] if isinstance(slot, str) else list(slot)
    base = _sum_before(df, keys, slots, value)
    inside = (
        Window.partitionBy(*keys, *slots)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    joined = df.join(base, [*keys, *slots], "left")
    zero = F.lit(0).cast("bigint")
    result = joined.withColumn(
        before,
        F.coalesce(F.col("_base"), zero) + F.coalesce(F.sum(value).over(inside), zero),
    )
    if total:
        result = result.withColumn(total, F.coalesce(F.col("_total"), zero))
    return result.drop("_base", "_total")
