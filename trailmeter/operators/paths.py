"""Conversion paths: cut each user's day at its orders and describe the visits in between."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from trailmeter import constants as C
from trailmeter.operators.running import running_sum_before

# Segments of one user that one task numbers or compares together.
SEGMENT_CHUNK = 10_000
# The second of events without a time, before all others.
NO_TIME = -(1 << 50)
# Parts of the events of a crowded time, and the share of all events that makes one (one in HEAVY).
SPREAD, HEAVY = 256, 1000
# Kinds of rows while sums are carried on: what a segment is, visits, and sums to fill in.
WHAT, OWN, FILLED = 0, 1, 2


@dataclass(frozen=True)
class EventColumns:
    """Where to find things in an event table.

    ``time`` should be a TIMESTAMP_NTZ. ``tie`` orders events of equal time; together with the time
    it must leave no open choice that a path could show. ``visits_first`` says that ``tie`` puts the
    visits of one time before its orders.
    """

    keys: list[str]
    time: str
    tie: list[str]
    is_order: str
    channel: str
    order_id: str
    amount: str
    visit_id: str | None = None
    visits_first: bool = False


def chunk_of(segment: Column) -> Column:
    """Neighbouring segments share a chunk. Nearly every user has one chunk per day."""
    return F.floor(segment / SEGMENT_CHUNK)


def second_of(time: Column) -> Column:
    """Seconds since 1970 by the clock fields, so that no time zone rule can reverse two events."""
    time = time.cast("timestamp_ntz")
    days = F.unix_date(time.cast("date")).cast("bigint")
    second = days * 86_400 + F.hour(time) * 3_600 + F.minute(time) * 60 + F.second(time).cast("int")
    return F.coalesce(second, F.lit(NO_TIME))


def orders_before(events: DataFrame, cols: EventColumns) -> DataFrame:
    """(keys, _when, _before, _at, _events, _orders): one row per exact time of a user and day, with the
    orders before that time, the orders and events at it, and the orders of the whole day.

    Events are counted by exact time on the map side, so a time with any number of events is one row.
    Sums go up in three levels: a day has at most 1,351 parts of 64 seconds, a part 64 seconds, and a
    second a million exact times, so no window is longer than that, however many events a user has.
    All levels share one scan and shuffle, as none of their slots can be NULL.
    """
    time = F.col("_when")
    known = reduce(and_, [F.col(name).isNotNull() for name in cols.keys])
    counted = (
        events.where(known).groupBy(*cols.keys, F.col(cols.time).alias("_when"))
        .agg(F.count_if(F.col(cols.is_order)).alias("_at"), F.count(F.lit(1)).alias("_events"))
        .withColumn("_second", second_of(time))
        .withColumn("_minute", F.shiftright("_second", 6))
    )
    summed = running_sum_before(
        counted, cols.keys, ["_minute", "_second"], [time], "_at", "_before", "_orders"
    )
    return summed.drop("_minute", "_second")


def _at_time(events: DataFrame, times: DataFrame, cols: EventColumns, also: list) -> DataFrame:
    """``events`` left join ``times`` on the keys and the exact time, which may be missing."""
    names = {name: f"_of_{name}" for name in cols.keys}
    same = [F.col(name) == F.col(other) for name, other in names.items()]
    same += [F.col(cols.time).eqNullSafe(F.col("_when")), *also]
    joined = events.join(times.withColumnsRenamed(names), same, "left")
    return joined.drop("_when", *names.values())


def _numbered(
    events: DataFrame, before: DataFrame, cols: EventColumns, part: str | None = None
) -> DataFrame:
    """Look up what comes before each exact time, and count the orders at it in a window. ``part`` is a
    column of both sides that parts the events of a time that need no order among themselves."""
    also = []
    if part:
        before, also = before.withColumnRenamed(part, "_of_part"), [F.col(part) == F.col("_of_part")]
    inside = (
        Window.partitionBy(*cols.keys, cols.time, *([part] if part else []))
        .orderBy(*[F.col(name) for name in cols.tie])
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    is_order = F.coalesce(F.col(cols.is_order), F.lit(False))
    here = F.sum(is_order.cast("bigint")).over(inside)
    if cols.visits_first:
        # Visits come before the orders of their time, whatever their ties are.
        here = F.when(is_order, here)
    zero = F.lit(0).cast("bigint")
    return (
        _at_time(events, before, cols, also)
        .withColumn("seg", F.coalesce("_before", zero) + F.coalesce(here, zero))
        .withColumn("_orders", F.coalesce("_orders", zero))
        .drop("_before", "_at", "_events", "_of_part")
    )


def number_segments(events: DataFrame, cols: EventColumns) -> DataFrame:
    """Add ``seg`` (orders strictly before the event) and ``_orders`` (orders of that user and day).

    The events of one exact time are dealt over SPREAD parts if they are more than a HEAVY-th of all,
    so there are at most HEAVY such times and their list is small. Only events that have an order
    among themselves stay together: the orders of the time where visits come first, else all if one
    of them is an order.
    """
    before = orders_before(events, cols)
    every = before.agg(F.sum("_events").alias("_all"))
    crowd = F.col("_events") > F.greatest(F.lit(SPREAD), F.col("_all") / HEAVY)
    heavy = before.crossJoin(every).where(crowd).select(*cols.keys, "_when", F.col("_at").alias("_crowd"))
    is_order = F.coalesce(F.col(cols.is_order), F.lit(False))
    free = ~is_order if cols.visits_first else F.col("_crowd") == 0
    dealt = F.pmod(F.xxhash64(*events.columns), F.lit(SPREAD)) + 1
    zero = F.lit(0).cast("bigint")
    parted = _at_time(events, F.broadcast(heavy), cols, [])
    known = F.col("_crowd").isNotNull()
    parted = parted.withColumn("_part", F.when(known & free, dealt).otherwise(zero)).drop("_crowd")
    marked = heavy.withColumnsRenamed({n: f"_is_{n}" for n in [*cols.keys, "_when"]})
    same = [F.col(n) == F.col(f"_is_{n}") for n in cols.keys]
    same += [F.col("_when").eqNullSafe(F.col("_is__when"))]
    parts = F.when(F.col("_crowd").isNotNull(), F.sequence(zero, F.lit(SPREAD).cast("bigint")))
    spread = before.join(F.broadcast(marked), same, "left")
    spread = spread.withColumn("_part", F.explode(F.coalesce(parts, F.array(zero))))
    spread = spread.select(*before.columns, "_part")
    return _numbered(parted, spread, cols, "_part").drop("_part")


STEP_COLUMNS = {
    "time": "_time",
    "is_order": "_is_order",
    "channel": "_channel",
    "order_id": "_order_id",
    "amount": "_amount",
    "visit_id": "_visit_id",
}


def _steps(events: DataFrame, cols: EventColumns, distinct: bool) -> tuple[DataFrame, EventColumns]:
    """The events counted by exact time, and their columns: a row per order, and per channel (with
    ``distinct`` per visit id) of the visits. Where visits come first, those of one time and channel
    are one row before any shuffle, so they never pile up in a task."""
    is_order = F.coalesce(F.col(cols.is_order), F.lit(False))
    channel = F.when(~is_order, F.coalesce(F.col(cols.channel), F.lit("")))
    ties = [F.col(name) for name in cols.tie]
    if cols.visits_first:
        ties = [F.when(is_order, tie) for tie in ties]
    names = [f"_tie{i}" for i in range(len(ties))]
    group = {
        "_time": F.col(cols.time),
        "_is_order": is_order,
        "_order_id": F.when(is_order, F.col(cols.order_id)),
        "_amount": F.when(is_order, F.col(cols.amount)),
        **dict(zip(names, ties, strict=True)),
    }
    if distinct:
        group["_visit_id"] = F.when(~is_order, F.col(cols.visit_id))
        # The earliest visit of an id stands for it.
        first = F.min(F.struct(*[F.col(n).alias(f"t{i}") for i, n in enumerate(cols.tie)], channel.alias("c")))
        more = [first.alias("_first")]
    else:
        group["_channel"], more = channel, []
    grouped = events.groupBy(*cols.keys, *[c.alias(n) for n, c in group.items()])
    counted = grouped.agg(F.count(F.lit(1)).alias("_visits"), *more)
    if distinct:
        counted = counted.withColumn("_channel", F.col("_first.c"))
    # Orders that are alike in all columns are as many segments.
    copies = F.when(F.col("_is_order"), F.col("_visits")).otherwise(1)
    steps = counted.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), copies)))
    steps = steps.withColumn("_visits", F.when(F.col("_is_order"), 0).otherwise(F.col("_visits")))
    columns = {k: v for k, v in STEP_COLUMNS.items() if distinct or k != "visit_id"}
    return steps, EventColumns(
        keys=cols.keys, tie=[*names, "_copy"], visits_first=cols.visits_first, **columns
    )


def _visit_counts(events: DataFrame, cols: EventColumns, distinct: bool, cumulative: bool):
    """Rows (keys, seg, channel, order id): visits, first time, amount. Channel is NULL for orders."""
    steps, named = _steps(events, cols, distinct)
    rows = _numbered(steps, orders_before(events, cols), named)
    if distinct:
        # NULL ids are kept but count as no visit.
        visits = rows.where(~F.col("_is_order"))
        scope = cols.keys if cumulative else [*cols.keys, "seg"]
        first = F.min(F.struct("_time", "_first", "_channel", "seg", "_orders")).alias("_first")
        counted = (
            visits.where(F.col("_visit_id").isNotNull())
            .groupBy(*scope, "_visit_id")
            .agg(first)
            .select(
                *cols.keys,
                "_first.seg",
                "_first._orders",
                "_first._channel",
                "_first._time",
                F.lit(1).cast("bigint").alias("_visits"),
            )
        )
        # A segment stays even if none of its visits counts.
        empty = visits.select(*cols.keys, "seg", "_orders").distinct()
        orders = rows.where(F.col("_is_order")).drop("_visit_id", "_first")
        rows = orders.unionByName(counted, allowMissingColumns=True).unionByName(
            empty, allowMissingColumns=True
        )
    return rows.groupBy(*cols.keys, "seg", "_orders", "_channel", "_order_id").agg(
        F.coalesce(F.sum("_visits"), F.lit(0)).cast("bigint").alias("_visits"),
        F.min("_time").alias("_time"),
        F.sum("_amount").alias("_amount"),
        F.coalesce(F.bool_or("_is_order"), F.lit(False)).alias("_is_order"),
    )


def _accumulate(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Turn visits per segment and channel into visits of the day up to that segment.

    A chunk of segments is one row with the list of what they hold. What earlier chunks add up to, a
    map from channel to first time and visits, is carried on from chunk to chunk: a channel's sum
    holds from the chunk after it is seen until the next chunk that sees it. So a user's segments and
    channels meet inside one chunk only, and ``counts`` is read twice.
    """
    chunk = chunk_of(F.col("seg"))
    seen = counts.where(F.col("_visits") > 0).groupBy(*keys, chunk.alias("_chunk"), "_channel").agg(
        F.sum("_visits").alias("_visits"), F.min("_time").alias("_time"), F.max("_orders").alias("_orders")
    )
    order = Window.partitionBy(*keys, "_channel").orderBy("_chunk")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.coalesce(F.lead("_chunk").over(order), chunk_of(F.col("_orders")))
    carried = seen.select(
        *keys,
        F.col("_chunk").alias("_from"),
        last.alias("_last"),
        F.struct("_channel", F.min("_time").over(upto).alias("_time"), F.sum("_visits").over(upto).alias("_visits")).alias("_sum"),
    )
    after = F.col("_from") + 1
    holds = F.explode(F.when(after <= F.col("_last"), F.sequence(after, F.col("_last"))))
    carried = carried.select(*keys, holds.alias("_chunk"), "_sum")
    carried = carried.groupBy(*keys, "_chunk").agg(F.collect_list("_sum").alias("_carried"))
    step = F.struct("seg", "_orders", "_channel", "_order_id", "_visits", "_time", "_amount", "_is_order")
    held = counts.groupBy(*keys, chunk.alias("_chunk")).agg(F.collect_list(step).alias("_steps"))
    # Null-safe, so that no filter on one side makes its scan another than that of the other side.
    names = {name: f"_of{name}" for name in [*keys, "_chunk"]}
    same = [F.col(name).eqNullSafe(F.col(other)) for name, other in names.items()]
    both = held.join(carried.withColumnsRenamed(names), same, "left").drop(*names.values())
    types = {field.name: field.dataType for field in counts.schema}
    fields = ["seg", "_orders", "_channel", "_order_id", "_visits", "_time", "_amount", "_is_order"]

    def cell(kind: int, *taken: str, of: Column | None = None, **values: Column) -> Column:
        values |= {name: of[name] for name in taken}
        typed = [values.get(n, F.lit(None)).cast(types[n]).alias(n) for n in fields]
        return F.struct(F.lit(kind).alias("_kind"), *typed)

    def all_of(array: str, kind: int, *taken: str, **values: Column) -> Column:
        return F.transform(array, lambda x: cell(kind, *taken, of=x, **values))

    # What a segment is, what it holds, a cell for each segment and each channel known by the end of
    # the chunk (as many as its paths have elements), and what is carried into the chunk.
    what = all_of("_steps", WHAT, "seg", "_orders", "_order_id", "_amount", "_is_order", _visits=F.lit(0))
    own = all_of("_seen", OWN, "seg", "_channel", "_visits", "_time")
    before = all_of("_carried", OWN, "_channel", "_visits", "_time", seg=F.lit(-1))
    channels = F.array_union(F.col("_seen._channel"), F.col("_carried._channel"))
    cells = F.transform(
        F.array_distinct(F.col("_steps.seg")),
        lambda s: F.transform(channels, lambda c: cell(FILLED, seg=s, _channel=c, _visits=F.lit(0))),
    )
    both = both.withColumns(
        {
            "_seen": F.filter("_steps", lambda s: s["_visits"] > 0),
            "_carried": F.coalesce("_carried", F.array().cast(both.schema["_carried"].dataType)),
        }
    )
    rows = both.select(*keys, "_chunk", F.explode(F.concat(what, own, before, F.flatten(cells))).alias("_row"))
    line = Window.partitionBy(*keys, "_chunk", "_channel").orderBy("seg")
    upto = line.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    filled = F.col("_kind") == FILLED
    return (
        rows.select(*keys, "_chunk", "_row.*")
        .withColumn("_visits", F.when(filled, F.sum("_visits").over(upto)).otherwise(F.col("_visits")))
        .withColumn("_time", F.when(filled, F.min("_time").over(upto)).otherwise(F.col("_time")))
        .where(F.col("_kind") != OWN)
        .drop("_kind", "_chunk")
    )


def conversion_paths(
    events: DataFrame,
    cols: EventColumns,
    distinct_visits: bool = False,
    cumulative: bool = False,
) -> DataFrame:
    """One row per segment of a user's day.

    A segment ends with its order; visits after the last order form a last segment without one.
    Output: the keys, ``seg`` and its ``chunk``, ``order_id`` ('' without an order), ``amount``, ``path``
    (``channel|visits`` by first appearance, joined with ``>``), ``all_times`` (visits) and
    ``before_first_order`` (visits before the first order of the day, 0 without one).

    ``distinct_visits`` counts a visit id once; ``cumulative`` describes the day so far instead of
    the segment.
    """
    keys = cols.keys
    counts = _visit_counts(events, cols, distinct_visits, cumulative)
    if cumulative:
        counts = _accumulate(counts, keys)
    step = F.struct("_time", "_channel", "_visits")
    steps = F.array_sort(F.collect_list(F.when(F.col("_visits") > 0, step)))
    path = F.array_join(
        F.transform(steps, lambda s: F.concat(s["_channel"], F.lit("|"), s["_visits"])), ">"
    )
    segments = counts.groupBy(*keys, "seg").agg(
        F.coalesce(F.max("_order_id"), F.lit("")).alias("order_id"),
        F.coalesce(F.sum("_amount"), F.lit(0)).cast(C.MONEY_SUM).alias("amount"),
        path.alias("path"),
        F.sum("_visits").alias("all_times"),
        F.bool_or("_is_order").alias("_has_order"),
        F.max("_orders").alias("_orders"),
    )
    return _first_order_visits(segments, keys)


def _first_order_visits(segments: DataFrame, keys: list[str]) -> DataFrame:
    """Give every segment the visits of segment 0, if that one ends with an order.

    Segment 0 sends a copy of itself to each chunk of its user's segments. Nearly all users have one
    chunk, so there is no extra row, and no window holds more than a chunk and the copy.
    """
    first = F.col("seg") == 0
    last_chunk, own_chunk = chunk_of(F.col("_orders")), chunk_of(F.col("seg"))
    chunks = F.when(first, F.sequence(F.lit(0).cast("bigint"), last_chunk)).otherwise(
        F.array(own_chunk)
    )
    visits = F.when(first & F.col("_has_order"), F.col("all_times"))
    together = Window.partitionBy(*keys, "chunk")
    columns = ["order_id", "amount", "path", "all_times", "before_first_order"]
    return (
        segments.withColumn("chunk", F.explode(chunks))
        .withColumn("before_first_order", F.coalesce(F.max(visits).over(together), F.lit(0)))
        .where(own_chunk == F.col("chunk"))
        .select(*keys, "seg", "chunk", *columns)
    )
