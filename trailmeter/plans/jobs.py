"""The scheduled jobs: read tables, run one plan for a range of days, write the days.

A range is one Spark job with the day as a key of every join and group; only its partitions change.
``run_restartable`` runs it in parts that a rerun skips once they are done.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType

from trailmeter import constants as C
from trailmeter import schemas
from trailmeter.plans import export, monitor, orders, page_views, rollup, user_detail
from trailmeter.sources import marks
from trailmeter.sources.days import days_of, quarters_of, read_table, write_days

VERSION_PARTITIONS = ("dt", "tp", "dp")
SCHEMAS: dict[str, StructType] = {
    "clicks": schemas.CLICKS,
    "wide": schemas.WIDE,
    "page_views": schemas.PAGE_VIEWS,
    "visits": schemas.VISITS,
    "orders": schemas.ORDERS,
    "snapshot_orders": schemas.SNAPSHOT_ORDERS,
    "order_labels": schemas.ORDER_LABELS,
    "account_names": schemas.ACCOUNT_NAMES,
    "lifecycle_tags": schemas.LIFECYCLE_TAGS,
    "status_tags": schemas.STATUS_TAGS,
    "account_tags": schemas.ACCOUNT_TAGS,
    "device_tags": schemas.DEVICE_TAGS,
    "detail": schemas.DETAIL,
    "rollup": schemas.ROLLUP,
}
Paths = Mapping[str, str]
Job = Callable[..., None]


def _read(spark: SparkSession, paths: Paths, days: list[str], *roles: str):
    return [read_table(spark, paths[role], SCHEMAS[role], days) for role in roles]


def run_click_monitor(
    spark: SparkSession, paths: Paths, out: str, start: str, end: str | None = None
) -> None:
    clicks, wide = _read(spark, paths, days_of(start, end), "clicks", "wide")
    rows = monitor.click_monitor(clicks, wide, start, end)
    columns = [*monitor.KEYS[1:], *C.MONITOR_MEASURES, "dt"]
    write_days(rows.select(*columns), out, clear=(start, end or start))


def run_page_view_monitor(
    spark: SparkSession, paths: Paths, out: str, start: str, end: str | None = None
) -> None:
    (views,) = _read(spark, paths, days_of(start, end), "page_views")
    rows = page_views.page_view_monitor(views, start, end)
    write_days(rows, out, clear=(start, end or start))


def run_user_detail(
    spark: SparkSession,
    paths: Paths,
    out: str,
    start: str,
    end: str | None = None,
    version: str = C.STABLE,
    **options: bool,
) -> None:
    """``version``: ``stable``, ``history`` or ``snapshot``; each has its own order tables."""
    days = days_of(start, end)
    if version == C.SNAPSHOT:
        tables = _read(spark, paths, days, "snapshot_orders", "order_labels", "account_names")
        facts = orders.snapshot_order_facts(*tables, start, end)
    elif version == C.HISTORY:
        facts = orders.history_order_facts(
            *_read(spark, paths, quarters_of(start, end), "orders"), start, end
        )
    else:
        facts = orders.stable_order_facts(*_read(spark, paths, days, "orders"), start, end)
    (visits,) = _read(spark, paths, days, "visits")
    tags = user_detail.UserTags(
        *_read(
            spark,
            paths,
            days_of(start, end, lag=1),
            "lifecycle_tags",
            "status_tags",
            "account_tags",
            "device_tags",
        )
    )
    rows = user_detail.user_detail(visits, facts, tags, start, end, version, **options)
    write_days(rows, out, VERSION_PARTITIONS)


def run_monitor_ratios(
    spark: SparkSession, paths: Paths, out: str, start: str, end: str | None = None
) -> None:
    """The differences and rates of the click monitor, from the same tables."""
    clicks, wide = _read(spark, paths, days_of(start, end), "clicks", "wide")
    rows = monitor.monitor_ratios(monitor.click_monitor(clicks, wide, start, end))
    write_days(rows, out, clear=(start, end or start))


def run_rollup(
    spark: SparkSession,
    paths: Paths,
    out: str,
    start: str,
    end: str | None = None,
    version: str = C.STABLE,
    empty_account_is_missing: bool = True,
) -> None:
    (detail,) = _read(spark, paths, days_of(start, end), "detail")
    rows = rollup.rollup(detail, start, end, version, empty_account_is_missing)
    write_days(rows, out, VERSION_PARTITIONS)


def run_export(
    spark: SparkSession,
    paths: Paths,
    out: str,
    start: str,
    end: str | None = None,
    pattern: str = export.NORMAL,
) -> None:
    (rows,) = _read(spark, paths, days_of(start, end), "rollup")
    export.export_files(rows, out, start, end, pattern)


# What each job reads; tags are those of the day before, the history of orders lies in quarters.
INPUTS: dict[Job, tuple[str, ...]] = {
    run_click_monitor: ("clicks", "wide"),
    run_monitor_ratios: ("clicks", "wide"),
    run_page_view_monitor: ("page_views",),
    run_user_detail: (
        "visits", "orders", "snapshot_orders", "order_labels", "account_names", "lifecycle_tags",
        "status_tags", "account_tags", "device_tags",
    ),
    run_rollup: ("detail",),
    run_export: ("rollup",),
}


def run_restartable(
    job: Job,
    spark: SparkSession,
    paths: Paths,
    out: str,
    start: str,
    end: str | None = None,
    days_at_once: int = 1,
    **options,
) -> list[str]:
    """Run a job for a range in parts of some days, and mark each day once its part is written. Returns
    the days that were run.

    A rerun after a failure opens only the days without a marker, and those whose input files are not
    the ones they were made from. A day is marked after its rows are in place, so a part that dies is
    run again as a whole; it overwrites its own days only. Markers lie in the output folder, one set
    for each job and its options.
    """
    tables = [paths[role] for role in INPUTS[job] if role in paths]
    label = ".".join([job.__name__, *(f"{k}-{options[k]}" for k in sorted(options))])
    place = f"{out}/{marks.FOLDER}/{label}"
    days, open_days = days_of(start, end), []
    for day in days:
        read = [*days_of(day, day, lag=1), *quarters_of(day, day)]
        mark = marks.fingerprint(spark, tables, read, options)
        if not marks.is_done(spark, place, day, mark):
            open_days.append((day, mark))
    for part in _parts(open_days, days_at_once):
        job(spark, paths, out, part[0][0], part[-1][0], **options)
        for day, mark in part:
            marks.set_done(spark, place, day, mark)
    return [day for day, _ in open_days]


def _parts(days: list[tuple[str, str]], most: int) -> list[list[tuple[str, str]]]:
    """Neighbouring days, ``most`` of them at a time; a gap begins a new part."""
    parts: list[list[tuple[str, str]]] = []
    for day in days:
        last = parts[-1] if parts else []
        if last and len(last) < most and days_of(last[-1][0], day[0])[1:] == [day[0]]:
            last.append(day)
        else:
            parts.append([day])
    return parts
