"""One query per operator and pipeline, over whole tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harness import adapters as A
from harness.adapters import END, START
from trailmeter import constants as C
from trailmeter import schemas
from trailmeter.functions import aggregates, keys, labels
from trailmeter.operators.joins import left_join_missing_aside, unique_per_key
from trailmeter.operators.paths import EventColumns, conversion_paths
from trailmeter.plans import export, factored, monitor, orders, page_views, rollup, user_detail
from trailmeter.sources.days import day_parts, read_days, read_quarters, read_table, write_days

Query = Callable[[SparkSession, str], DataFrame]
# Events and detail rows that a part of the days takes at most. Their shuffles take about 700 and 900
# bytes each. Each part of the detail scans all events again, as these are not stored by day.
DETAIL_EVENTS, ROLLUP_ROWS = 10_000_000, 5_000_000


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder the cluster shares. Only a local session, where driver and executors
    are one machine, gets a folder of its own when none is set."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="trailmeter-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _clicks(spark, sf_dir):
    return read_days(A.clicks(spark, sf_dir), START, END)


def _wide(spark, sf_dir):
    return read_days(A.wide(spark, sf_dir), START, END)


def pv_monitor(spark, sf_dir):
    return page_views.page_view_monitor(A.page_views(spark, sf_dir), START, END)


def _check(check: monitor.Check) -> Query:
    source = _clicks if check.source == monitor.CLICKS else _wide
    return lambda spark, sf_dir: monitor.run_check(check, source(spark, sf_dir))


def monitor_m5(spark, sf_dir):
    return monitor.summary_vs_detail_clicks(_clicks(spark, sf_dir), _wide(spark, sf_dir))


def monitor_m6(spark, sf_dir):
    return monitor.match_check(_clicks(spark, sf_dir))


def monitor_m8(spark, sf_dir):
    return monitor.cpc_consumption(_clicks(spark, sf_dir), _wide(spark, sf_dir))


def monitor_merge(spark, sf_dir):
    return monitor.click_monitor_plain(A.clicks(spark, sf_dir), A.wide(spark, sf_dir), START, END)


def monitor_merge_fused(spark, sf_dir):
    return monitor.click_monitor(A.clicks(spark, sf_dir), A.wide(spark, sf_dir), START, END)


def monitor_ratios(spark, sf_dir):
    ratios = monitor.monitor_ratios(monitor_merge_fused(spark, sf_dir))
    names = [n for n in ratios.columns if n not in monitor.KEYS]
    return ratios.select(*monitor.KEYS, *[F.round(n, 6).alias(n) for n in names])


def play_mode(spark, sf_dir):
    return (
        monitor.with_play_mode(_clicks(spark, sf_dir))
        .groupBy("ad_traffic_type", "ad_traffic_group", "campaign_type", "combine_play_type")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def semi_match(spark, sf_dir):
    return monitor.matched_clicks_one_scan(_clicks(spark, sf_dir))


def semi_match_drop_empty(spark, sf_dir):
    return monitor.matched_clicks(_clicks(spark, sf_dir), drop_empty_keys=True)


def _user_days(spark, sf_dir):
    events = A.table(spark, sf_dir, "events")
    return events.groupBy("user_id", F.to_date("ts").cast("string").alias("dt")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_distinct("event_type").cast("int").alias("kinds"),
    )


def freq_label(spark, sf_dir):
    days = _user_days(spark, sf_dir)
    times = F.when(F.col("n") > 1, F.col("n") * 2 - 4)
    return days.select("user_id", "dt", "n", labels.frequency_label(times).alias("freq"))


def chan_count_label(spark, sf_dir):
    days = _user_days(spark, sf_dir)
    return days.select(
        "user_id", "dt", "kinds", labels.channel_count_label(F.col("kinds") - 1).alias("label")
    )


def chan_collapse(spark, sf_dir):
    number = F.when(F.col("n") != 3, F.col("n") - 1)
    label = F.concat(F.lit("set"), "n")
    return _user_days(spark, sf_dir).select(
        "user_id",
        "dt",
        "n",
        labels.channel_label(number, label).alias("label"),
        labels.channel_label(number, label, C.OTHER_CHANNELS_SNAPSHOT).alias("snapshot_label"),
    )


def lifecycle_label(spark, sf_dir):
    customer = A.table(spark, sf_dir, "customer")
    account = F.when(F.col("c_custkey") % 7 == 0, None).otherwise(
        F.when(F.col("c_custkey") % 11 == 0, "").otherwise(F.col("c_name"))
    )
    status = F.when(F.col("c_nationkey") % 10 == 0, "0").when(F.col("c_nationkey") % 10 < 8, "1")
    lifecycle = F.when(F.col("c_mktsegment") == "MACHINERY", "-1").when(
        F.col("c_mktsegment") != "FURNITURE", F.col("c_mktsegment")
    )
    return customer.select(
        "c_custkey", labels.lifecycle_label(account, status, lifecycle).alias("label")
    )


def _facts(df: DataFrame) -> DataFrame:
    return df.withColumn("after_prefr_amount_1", F.col("after_prefr_amount_1").cast("double"))


def order_facts_stable(spark, sf_dir):
    return _facts(orders.stable_order_facts(A.settled_orders(spark, sf_dir), START, END))


def order_facts_history(spark, sf_dir):
    quarters = A.settled_orders(spark, sf_dir, by_quarter=True)
    return _facts(orders.history_order_facts(quarters, START, END))


def order_facts_snapshot(spark, sf_dir):
    return _facts(
        orders.snapshot_order_facts(
            A.snapshot_orders(spark, sf_dir),
            A.order_labels(spark, sf_dir),
            A.account_names(spark, sf_dir),
            START,
            END,
        )
    )


def quarter_scan(spark, sf_dir):
    rows = read_quarters(
        A.settled_orders(spark, sf_dir, by_quarter=True), START, END, "sale_ord_dt"
    )
    return rows.groupBy("dt").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("sale_ord_dt").alias("first_day"),
        F.max("sale_ord_dt").alias("last_day"),
    )


def _events(spark, sf_dir):
    facts = _path_facts(spark, sf_dir, C.STABLE)
    return user_detail.unified_events(A.visits(spark, sf_dir), facts, START, END)


def _clock_text(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def unified_events(spark, sf_dir):
    ranked = labels.ranked_channel(F.col("chan_second_cate_desc_bel"))
    return _facts(_events(spark, sf_dir)).withColumns(
        {"ranked_channel": ranked, "event_time": _clock_text(F.col("event_time"))}
    )


def event_sequence(spark, sf_dir):
    numbered = user_detail.event_sequence(_events(spark, sf_dir))
    return numbered.groupBy("dt", "user_id", "seg", "attr").agg(
        F.count(F.lit(1)).alias("n"),
        _clock_text(F.min("event_time")).alias("first_time"),
        _clock_text(F.max("event_time")).alias("last_time"),
    )


def user_summary(spark, sf_dir):
    summary = user_detail.user_summary(_events(spark, sf_dir))
    return summary.withColumnsRenamed({"_label": "label", "_orders": "orders"})


def channel_label(spark, sf_dir):
    visits = A.visits(spark, sf_dir)
    ranked = labels.ranked_channel(F.col("chan_second_cate_desc_bel"))
    return visits.groupBy("dt", "user_log_acct").agg(
        aggregates.channel_set(ranked).alias("label")
    )


RAW_EVENTS = EventColumns(
    keys=["user_id", "day"],
    time="ts",
    tie=["event_id"],
    is_order="is_order",
    channel="event_type",
    order_id="order_id",
    amount="amount",
    visit_id="visit_id",
)


def _raw_paths(spark, sf_dir, **options):
    events = A.table(spark, sf_dir, "events").withColumns(
        {
            "day": F.to_date("ts"),
            "is_order": F.col("event_type") == "purchase",
            "order_id": F.col("event_id").cast("string"),
            "amount": keys.money(F.col("value")),
            "visit_id": F.when(F.col("event_id") % 9 != 0, F.floor(F.hour("ts") / 12)),
        }
    )
    paths = conversion_paths(events, RAW_EVENTS, **options)
    return paths.select(
        "user_id",
        F.col("day").cast("string").alias("day"),
        "seg",
        F.col("order_id").alias("ord"),
        F.col("amount").cast("double").alias("amt"),
        "path",
        "all_times",
        F.col("before_first_order").alias("bfo"),
    )


def conversion_path(spark, sf_dir):
    return _raw_paths(spark, sf_dir)


def conversion_path_distinct(spark, sf_dir):
    return _raw_paths(spark, sf_dir, distinct_visits=True)


def conversion_path_cumulative(spark, sf_dir):
    return _raw_paths(spark, sf_dir, cumulative=True)


def conversion_path_distinct_cumulative(spark, sf_dir):
    return _raw_paths(spark, sf_dir, distinct_visits=True, cumulative=True)


def null_skip_join(spark, sf_dir):
    left = A.table(spark, sf_dir, "events").select(
        "event_id",
        F.when(F.col("user_id") % 7 == 0, None)
        .otherwise(F.when(F.col("user_id") % 11 == 0, "").otherwise(F.concat(F.lit("u"), "user_id")))
        .alias("account"),
    )
    customer = A.table(spark, sf_dir, "customer")
    name = F.when(F.col("c_custkey") == 1, "").otherwise(F.concat(F.lit("u"), "c_custkey"))
    right = unique_per_key(customer, {"account": name}, segment=F.max("c_mktsegment"))
    kept = left.withColumn("key", F.col("account"))
    joined = left_join_missing_aside(kept, right.withColumnRenamed("account", "key"), "key")
    return joined.drop("key")


def _path_facts(spark, sf_dir, version, start=START, end=END):
    days = start, end
    if version == C.SNAPSHOT:
        return orders.snapshot_order_facts(
            A.path_snapshot_orders(spark, sf_dir, days),
            A.path_order_labels(spark, sf_dir, days),
            A.path_account_names(spark, sf_dir, days),
            start,
            end,
        )
    if version == C.HISTORY:
        quarters = A.path_orders(spark, sf_dir, by_quarter=True, days=days)
        return orders.history_order_facts(quarters, start, end)
    return orders.stable_order_facts(A.path_orders(spark, sf_dir, days=days), start, end)


def _detail(spark, sf_dir, version=C.STABLE, start=START, end=END, **options):
    return user_detail.user_detail(
        A.visits(spark, sf_dir, (start, end)),
        _path_facts(spark, sf_dir, version, start, end),
        A.tags(spark, sf_dir, (start, end)),
        start,
        end,
        version,
        **options,
    )


def _amount_as_double(df: DataFrame) -> DataFrame:
    name = "tc_deal_after_prefr_amount_1"
    return df.withColumn(name, F.col(name).cast("double"))


def detail_stable(spark, sf_dir):
    return _amount_as_double(_detail(spark, sf_dir))


def detail_snapshot(spark, sf_dir):
    return _amount_as_double(_detail(spark, sf_dir, C.SNAPSHOT))


def detail_history(spark, sf_dir):
    return _amount_as_double(_detail(spark, sf_dir, C.HISTORY))


def detail_empty_as_missing(spark, sf_dir):
    return _amount_as_double(_detail(spark, sf_dir, empty_account_is_missing=True))


def _factored(spark, sf_dir):
    return factored.factored_detail(
        A.visits(spark, sf_dir), _path_facts(spark, sf_dir, C.STABLE), A.tags(spark, sf_dir), START, END
    )


def detail_empty_as_account(spark, sf_dir):
    return _amount_as_double(factored.stacked(_factored(spark, sf_dir)))


def rollup_empty_as_account(spark, sf_dir):
    """From both sides of the detail as they are stored."""
    path = scratch(spark, "factored")
    factored.write_factored(_factored(spark, sf_dir), path)
    return factored.rollup_factored(factored.read_factored(spark, path), START, END)


def stored_detail(spark, sf_dir, *versions):
    """The detail as the rollup finds it: written by day and version, read back with a schema. Days
    follow each other in parts, so the shuffles of all days never lie on disk together."""
    path = scratch(spark, "detail")
    parts = day_parts(A.event_days(spark, sf_dir), DETAIL_EVENTS, START, END)
    for version in versions:
        for start, end in parts:
            write_days(_detail(spark, sf_dir, version, start, end), path, ("dt", "tp", "dp"))
    return read_table(spark, path, schemas.DETAIL)


def stored_rollup(spark, sf_dir, *versions):
    """The rollup as the export finds it: all levels, each version and part of the days by itself."""
    detail = stored_detail(spark, sf_dir, *versions)
    path = scratch(spark, "rollup")
    for version in versions:
        rows = detail.where(F.col("dp") == version)
        for start, end in day_parts(rows, ROLLUP_ROWS, START, END):
            write_days(rollup.rollup(detail, start, end, version), path, ("dt", "tp", "dp"))
    return read_table(spark, path, schemas.ROLLUP)


def rollup_levels(spark, sf_dir):
    return rollup.rollup_levels(stored_detail(spark, sf_dir, C.STABLE), START, END)


def rollup_levels_plain(spark, sf_dir):
    return rollup.rollup_levels_plain(stored_detail(spark, sf_dir, C.STABLE), START, END)


def rollup_path_level(spark, sf_dir):
    return rollup.rollup_paths(stored_detail(spark, sf_dir, C.STABLE), START, END)


def rollup_path_level_plain(spark, sf_dir):
    return rollup.rollup_paths_plain(stored_detail(spark, sf_dir, C.STABLE), START, END)


def rollup_merged(spark, sf_dir):
    return stored_rollup(spark, sf_dir, C.STABLE, C.SNAPSHOT)


def grouping_codes(spark, sf_dir):
    line = A.table(spark, sf_dir, "lineitem")
    dims = ["l_returnflag", "l_linestatus", "l_linenumber"]
    return line.cube(*dims).agg(
        labels.grouping_bits(F.grouping_id(*dims)).alias("bits"), F.count(F.lit(1)).alias("n")
    )


def json_field(spark, sf_dir):
    value = F.get_json_object("props", "$.k")
    return A.table(spark, sf_dir, "events").select(
        "event_id", value.alias("k"), value.try_cast("int").alias("k_int")
    )


def shard_key(spark, sf_dir):
    key = keys.shard_key(F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus"))
    return A.table(spark, sf_dir, "orders").select("o_orderkey", key.alias("shard"))


def _export(pattern: str) -> Query:
    def query(spark, sf_dir):
        return export.export_rows(rollup_merged(spark, sf_dir), START, END, pattern)

    return query


def export_files(spark, sf_dir):
    """The exported files read back: rows and shard keys per day."""
    stored, path = scratch(spark, "rollup"), scratch(spark, "export")
    write_days(rollup_levels(spark, sf_dir), stored, ("dt", "tp", "dp"))
    export.export_files(read_table(spark, stored, schemas.ROLLUP), path, START, END)
    rows = spark.read.parquet(path)
    return rows.groupBy(F.col("dt").cast("string").alias("dt")).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("hash_key_for_shard").cast("bigint")).alias("shards"),
    )


def export_shard_files(spark, sf_dir):
    """The manifest of files by ranges of shard keys: rows and keys per day, and files that overlap."""
    stored, path = scratch(spark, "rollup"), scratch(spark, "shards")
    write_days(rollup_levels(spark, sf_dir), stored, ("dt", "tp", "dp"))
    files = export.export_shards(read_table(spark, stored, schemas.ROLLUP), path, START, END)
    before = F.lag("max_shard").over(Window.partitionBy("dt").orderBy("min_shard"))
    return files.withColumn("before", before).groupBy("dt").agg(
        F.sum("rows").alias("n"),
        F.min("min_shard").alias("first"),
        F.max("max_shard").alias("last"),
        F.count_if(F.col("before") >= F.col("min_shard")).alias("overlaps"),
    )


def overwrite_roundtrip(spark, sf_dir):
    """Write both versions of all days, then one version of the odd days again."""
    path = scratch(spark, "overwrite")
    events = A.table(spark, sf_dir, "events").select(
        "event_id", F.to_date("ts").cast("string").alias("dt"), F.lit(C.DAY).alias("tp")
    )
    stable = events.withColumns({"dp": F.lit(C.STABLE), "run": F.lit(1)})
    snapshot = events.withColumns({"dp": F.lit(C.SNAPSHOT), "run": F.lit(1)})
    odd_days = F.dayofmonth(F.col("dt").cast("date")) % 2 == 1
    rerun = snapshot.where(odd_days & (F.col("event_id") % 2 == 0)).withColumn("run", F.lit(2))
    for rows in (stable, snapshot, rerun):
        write_days(rows, path, ("dt", "tp", "dp"))
    schema = "event_id bigint, run int, dt string, tp string, dp string"
    return spark.read.schema(schema).parquet(path)


QUERIES: dict[str, Query] = {
    "pv_monitor": pv_monitor,
    "monitor_m1": _check(monitor.EMPTY_PLACEMENT),
    "monitor_m2": _check(monitor.EMPTY_PLACEMENT_MONEY),
    "monitor_m3": _check(monitor.EMPTY_LAST_POSITION),
    "monitor_m4": _check(monitor.EMPTY_CLICK_ID),
    "monitor_m5": monitor_m5,
    "monitor_m6": monitor_m6,
    "monitor_m7": _check(monitor.EVENT_SIDES),
    "monitor_m8": monitor_m8,
    "monitor_merge": monitor_merge,
    "monitor_merge_fused": monitor_merge_fused,
    "monitor_ratios": monitor_ratios,
    "play_mode": play_mode,
    "semi_match": semi_match,
    "semi_match_drop_empty": semi_match_drop_empty,
    "freq_label": freq_label,
    "chan_count_label": chan_count_label,
    "chan_collapse": chan_collapse,
    "lifecycle_label": lifecycle_label,
    "order_facts_stable": order_facts_stable,
    "order_facts_history": order_facts_history,
    "order_facts_snapshot": order_facts_snapshot,
    "quarter_scan": quarter_scan,
    "unified_events": unified_events,
    "event_sequence": event_sequence,
    "user_summary": user_summary,
    "channel_label": channel_label,
    "conversion_path": conversion_path,
    "conversion_path_distinct": conversion_path_distinct,
    "conversion_path_cumulative": conversion_path_cumulative,
    "conversion_path_distinct_cumulative": conversion_path_distinct_cumulative,
    "null_skip_join": null_skip_join,
    "user_detail": detail_stable,
    "user_detail_history": detail_history,
    "user_detail_snapshot": detail_snapshot,
    "user_detail_empty_as_missing": detail_empty_as_missing,
    "user_detail_empty_as_account": detail_empty_as_account,
    "rollup_empty_as_account": rollup_empty_as_account,
    "rollup_levels": rollup_levels,
    "rollup_levels_plain": rollup_levels_plain,
    "rollup_path_level": rollup_path_level,
    "rollup_path_level_plain": rollup_path_level_plain,
    "rollup_merged": rollup_merged,
    "grouping_codes": grouping_codes,
    "json_field": json_field,
    "shard_key": shard_key,
    "export_normal": _export(export.NORMAL),
    "export_history": _export(export.HISTORY),
    "export_files": export_files,
    "export_shard_files": export_shard_files,
    "overwrite_roundtrip": overwrite_roundtrip,
}
