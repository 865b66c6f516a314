"""The driver's tables in the shape of the source tables.

Rules over ids stand in for values the tables lack, such as NULL accounts. Each adapter keeps every
row of its table. ``harness/oracle.py`` states the same rules in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trailmeter import constants as C
from trailmeter.plans.user_detail import UserTags

START, END = "1990-01-01", "2099-12-31"
Days = tuple[str, str] | None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _text(column: str) -> Column:
    return F.col(column).cast("string")


def _day(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd")


def _every(column: str, n: int) -> Column:
    return F.col(column) % n == 0


def _pick(index: Column, *values: str | None) -> Column:
    return F.element_at(F.array(*[F.lit(v).cast("string") for v in values]), (index + 1).cast("int"))


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    key_and_line = F.concat_ws("-", "l_orderkey", "l_linenumber")
    return line.select(
        F.trunc("l_shipdate", "month").cast("string").alias("dt"),
        _pick(F.col("l_suppkey") % 6, "99", "237", "315", "122", "1", None).alias(
            "ad_traffic_type"
        ),
        _text("l_linenumber").alias("ad_traffic_group"),
        F.when(_every("l_partkey", 3), "8").otherwise("5").alias("campaign_type"),
        F.when(F.col("l_returnflag") == "A", "").otherwise(_text("l_partkey")).alias(
            "placement_id"
        ),
        F.when(_every("l_partkey", 5), "0")
        .when(_every("l_partkey", 7), "")
        .otherwise(_text("l_linenumber"))
        .alias("last_pos_id"),
        F.when(F.col("l_linestatus") == "F", "2").otherwise("3").alias("loc"),
        # Flags that read otherwise as a number than as text: empty, missing, with a leading zero.
        F.when(_every("l_partkey", 4), "1")
        .when(_every("l_partkey", 9), "")
        .when(_every("l_partkey", 11), None)
        .when(_every("l_partkey", 13), "01")
        .otherwise("0")
        .alias("is_bill"),
        F.when(_every("l_suppkey", 9), "").otherwise(_text("l_linenumber")).alias("event_type"),
        _text("l_orderkey").alias("sid"),
        F.col("l_extendedprice").alias("total_price"),
        _pick(
            F.col("l_orderkey") % 3, C.BILLED_PARTITION, C.UNBILLED_PARTITION, C.SOCIAL_PARTITION
        ).alias("dp"),
        F.when(F.col("l_linestatus") == "F", "CPC").otherwise("cpm").alias("ad_billing_type"),
        F.when(_every("l_partkey", 6), "").otherwise(key_and_line).alias("click_id"),
        F.when(_every("l_partkey", 2), "3").otherwise("1").alias("ad_type"),
        _text("l_partkey").alias("item_sku_id"),
        _text("l_suppkey").alias("material_id"),
        F.lit("0").alias("delivery_system_type"),
        F.lit("4").alias("business_type"),
        "l_returnflag",
    )


def wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks added up; traffic type 1 is all refunds, so its sums are negative."""
    flags = {
        "sales_type": F.when(F.col("l_returnflag") == "R", "品牌").otherwise(C.PERFORMANCE_SALES),
        "resource_type": F.when(F.col("l_returnflag") == "N", "internal").otherwise("external"),
        "ad_comsumption_type": F.col("ad_billing_type"),
        "ad_business_type": F.col("business_type"),
    }
    sign = F.when(F.col("ad_traffic_type") == "1", -1).otherwise(1)
    return (
        clicks(spark, sf_dir)
        .withColumns(flags)
        .groupBy(
            "dt", "ad_traffic_type", "ad_traffic_group", "campaign_type", "placement_id", *flags
        )
        .agg(
            F.count(F.lit(1)).alias("clicks"),
            F.sum(F.col("total_price").cast("decimal(18,2)") * sign)
            .cast("double")
            .alias("consumption"),
        )
    )


def page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 30).cast("int"))
    return table(spark, sf_dir, "documents").select(
        day.cast("string").alias("dt"),
        F.col("lang").alias("pv_chan_first_cate_cd"),
        F.col("source").alias("pv_chan_second_cate_cd"),
        (F.col("doc_id") % 4).cast("string").alias("pv_chan_third_cate_cd"),
        (F.col("n_chars") > 1000).cast("string").alias("pv_chan_fourth_cate_cd"),
        _pick(F.col("doc_id") % 3, "1", "0", None).alias("is_join_clikc_flag"),
        F.when(_every("doc_id", 10), "term_{CLICK_ID}")
        .when(F.col("doc_id") % 10 != 1, F.concat(F.lit("term_"), "doc_id"))
        .alias("clk_utm_term"),
    )


def _account(prefix: str, suffix: str = "") -> Column:
    """Every eleventh user has '' as account."""
    name = F.concat(F.lit(prefix), "user_id", F.lit(suffix))
    return F.when(_every("user_id", 11), "").otherwise(name)


def _owned(account: Column) -> Column:
    """Every seventh user has no account."""
    return F.when(~_every("user_id", 7), account)


def _app() -> Column:
    return F.when(_every("event_id", 17), "PC").otherwise(C.APP)


def _clock() -> Column:
    return F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")


def events_of(spark: SparkSession, sf_dir: str, days: Days) -> DataFrame:
    """All events, or those of a range of days and of the days beside it, for readers that cut it to the
    range by their own days: the other rows only go before anything is made of them."""
    events = table(spark, sf_dir, "events")
    if days is None:
        return events
    first, last = (F.lit(day).cast("date") for day in days)
    return events.where(F.to_date("ts").between(F.date_sub(first, 1), F.date_add(last, 1)))


def event_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(_day("ts").alias("dt"))


def visits(spark: SparkSession, sf_dir: str, days: Days = None) -> DataFrame:
    events = events_of(spark, sf_dir, days).where("event_type <> 'purchase'")
    device = F.concat(F.lit("d"), "user_id", F.lit("-"), F.col("event_id") % 2)
    session = F.concat(F.lit("s"), "user_id", F.lit("-"), F.floor(F.hour("ts") / 6))
    return events.select(
        _day("ts").alias("dt"),
        _app().alias("platform"),
        _owned(_account("u")).alias("unif_user_log_acct"),
        F.concat(F.lit("l"), "user_id").alias("user_log_acct"),
        F.when(~_every("user_id", 13), device).alias("browser_uniq_id"),
        _pick(F.col("event_id") % 11, *C.CHANNELS, "unlisted", None).alias(
            "chan_second_cate_desc_bel"
        ),
        F.when(~_every("event_id", 19), session).alias("pv_id"),
        _clock().alias("request_tm"),
    )


def _purchase_columns() -> list[Column]:
    return [
        (F.col("event_id") % 50).cast("string").alias("item_sku_id"),
        F.concat(F.lit("o"), "event_id").alias("sale_ord_id"),
        F.concat(F.lit("p"), "event_id").alias("parent_sale_ord_id"),
        _clock().alias("sale_ord_tm"),
        F.concat(F.lit("L"), "user_id").alias("user_log_acct"),
    ]


def _purchases(spark: SparkSession, sf_dir: str, days: Days) -> DataFrame:
    return events_of(spark, sf_dir, days).where("event_type = 'purchase'")


def path_orders(
    spark: SparkSession, sf_dir: str, by_quarter: bool = False, days: Days = None
) -> DataFrame:
    """Purchases as settled order lines; accounts need trimming and lower case."""
    quarter = F.trunc("ts", "quarter").cast("string")
    return _purchases(spark, sf_dir, days).select(
        (quarter if by_quarter else _day("ts")).alias("dt"),
        _day("ts").alias("sale_ord_dt"),
        F.lit(1 if by_quarter else 0).alias("tp"),
        F.lit(C.QUARTER_TO_DATE if by_quarter else C.DAY_TO_DATE).alias("dp"),
        _app().alias("new_bs"),
        F.when(_every("event_id", 23), "0").otherwise("1").alias("intraday_ord_deal_flag"),
        F.when(_every("event_id", 5), "B端").otherwise(C.CONSUMER).alias("type_c"),
        _owned(_account(" U", " ")).alias("unif_user_log_acct"),
        F.col("value").alias("after_prefr_amount_1"),
        *_purchase_columns(),
    )


def path_snapshot_orders(spark: SparkSession, sf_dir: str, days: Days = None) -> DataFrame:
    return _purchases(spark, sf_dir, days).select(
        _day("ts").alias("dt"),
        F.lit("own").alias("add_cart_plat_flag"),
        _app().alias("plat_flag"),
        F.when(_every("event_id", 23), "0").otherwise("1").alias("deal_flag"),
        F.col("value").alias("after_prefr_amount"),
        *_purchase_columns(),
    )


def path_order_labels(spark: SparkSession, sf_dir: str, days: Days = None) -> DataFrame:
    business = F.when(_every("event_id", 5), "other").otherwise(C.CONSUMER_BUSINESS)
    return _purchases(spark, sf_dir, days).select(
        _day("ts").alias("dt"), business.alias("first_biz"), *_purchase_columns()[:2]
    )


def path_account_names(spark: SparkSession, sf_dir: str, days: Days = None) -> DataFrame:
    """Logins of users with an account, on each day they have events."""
    named = ~_every("user_id", 7) & ~_every("user_id", 11)
    return _user_days(spark, sf_dir, days).where(named).select(
        F.col("day").cast("string").alias("dt"),
        F.concat(F.lit(" L"), "user_id").alias("user_acct_name"),
        F.concat(F.lit("U"), "user_id").alias("unif_user_log_acct"),
    )


def _user_days(spark: SparkSession, sf_dir: str, days: Days) -> DataFrame:
    """Customers on each day they have events: one row per user and day."""
    seen = (
        events_of(spark, sf_dir, days)
        .select("user_id", F.col("ts").cast("date").alias("day"))
        .distinct()
    )
    customer = table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "user_id")
    return seen.join(customer, "user_id")


def tags(spark: SparkSession, sf_dir: str, days: Days = None) -> UserTags:
    users = _user_days(spark, sf_dir, days)
    same_day = F.col("day").cast("string").alias("dt")
    day_before = F.date_sub("day", 1).cast("string").alias("dt")
    account = F.concat(F.lit(" U"), "user_id", F.lit(" "))
    return UserTags(
        lifecycle=users.select(
            day_before,
            F.when(~_every("user_id", 5), account).alias("unif_user_log_acct"),
            F.concat(F.lit("U"), "user_id").alias("user_log_acct"),
            F.when(F.col("c_mktsegment") == "MACHINERY", "-1")
            .otherwise(F.col("c_mktsegment"))
            .alias("user_life_cycle_type"),
        ),
        status=users.select(
            same_day,
            account.alias("unif_user_log_acct"),
            F.when(_every("c_nationkey", 10), "0").otherwise("1").alias("init_acct_status"),
        ),
        accounts=users.select(
            day_before,
            account.alias("unif_user_log_acct"),
            F.when(~_every("c_nationkey", 5), F.concat(F.lit("v"), F.col("c_nationkey") % 4)).alias(
                "user_visitcycle_app"
            ),
            F.when(~_every("c_nationkey", 4), F.concat(F.lit("b"), F.col("c_nationkey") % 3)).alias(
                "user_buycycle_all"
            ),
        ),
        devices=users.select(
            day_before,
            F.concat(F.lit("d"), "user_id", F.lit("-0")).alias("browse_uniq_id"),
            F.concat(F.lit("dv"), F.col("c_nationkey") % 4).alias("user_visitcycle_app"),
            F.concat(F.lit("db"), F.col("c_nationkey") % 3).alias("user_buycycle_all"),
        ),
    )


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    return table(spark, sf_dir, "orders").join(line, F.col("o_orderkey") == F.col("l_orderkey"))


def _order_line_columns() -> list[Column]:
    return [
        (F.col("l_partkey") % 3).cast("string").alias("item_sku_id"),
        F.concat_ws("-", "o_orderkey", F.col("l_suppkey") % 2).alias("sale_ord_id"),
        _text("o_orderkey").alias("parent_sale_ord_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss.S").alias("sale_ord_tm"),
    ]


def settled_orders(spark: SparkSession, sf_dir: str, by_quarter: bool = False) -> DataFrame:
    quarter = F.trunc("o_orderdate", "quarter").cast("string")
    return _order_lines(spark, sf_dir).select(
        (quarter if by_quarter else _day("o_orderdate")).alias("dt"),
        _day("o_orderdate").alias("sale_ord_dt"),
        F.lit(1 if by_quarter else 0).alias("tp"),
        F.lit(C.QUARTER_TO_DATE if by_quarter else C.DAY_TO_DATE).alias("dp"),
        F.when(_every("o_orderkey", 10), "PC").otherwise(C.APP).alias("new_bs"),
        F.when(_every("o_orderkey", 13), "0").otherwise("1").alias("intraday_ord_deal_flag"),
        F.when(F.col("o_orderstatus") == "P", "B端").otherwise(C.CONSUMER).alias("type_c"),
        F.concat(F.lit(" M"), F.col("o_custkey") % 500).alias("unif_user_log_acct"),
        F.concat(F.lit("C"), "o_custkey", F.lit(" ")).alias("user_log_acct"),
        F.col("l_extendedprice").alias("after_prefr_amount_1"),
        *_order_line_columns(),
    )


def snapshot_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_lines(spark, sf_dir).select(
        _day("o_orderdate").alias("dt"),
        F.when(_every("o_orderkey", 10), "YHD_PC")
        .when(~_every("o_orderkey", 7), "own")
        .alias("add_cart_plat_flag"),
        F.when(_every("o_orderkey", 13), "PC").otherwise(C.APP).alias("plat_flag"),
        F.lit("1").alias("deal_flag"),
        F.concat(F.lit("C"), "o_custkey", F.lit(" ")).alias("user_log_acct"),
        F.col("l_extendedprice").alias("after_prefr_amount"),
        *_order_line_columns(),
    )


def order_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_lines(spark, sf_dir).select(
        _day("o_orderdate").alias("dt"),
        F.when(F.col("l_returnflag") == "R", "other")
        .otherwise(C.CONSUMER_BUSINESS)
        .alias("first_biz"),
        *_order_line_columns()[:2],
    )


def account_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names on each day their customer has orders; every fifth name is its own account."""
    days = (
        table(spark, sf_dir, "orders")
        .select(F.col("o_custkey").alias("c_custkey"), _day("o_orderdate").alias("dt"))
        .distinct()
    )
    name = F.concat(F.lit("c"), "c_custkey")
    merged = F.concat(F.lit("M"), F.floor(F.col("c_custkey") / 3))
    return days.join(table(spark, sf_dir, "customer"), "c_custkey").select(
        "dt",
        name.alias("user_acct_name"),
        F.when(_every("c_custkey", 5), name).otherwise(merged).alias("unif_user_log_acct"),
    )
