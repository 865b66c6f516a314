"""Order facts: one amount per user, parent order and second, from three kinds of order tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trailmeter import constants as C
from trailmeter.functions.keys import money, normal_account, whole_seconds
from trailmeter.operators.joins import flag_members, left_join_missing_aside, unique_per_key
from trailmeter.sources.days import read_days, read_quarters

FACT_KEYS = ["dt", "unif_user_log_acct", "user_log_acct", "parent_sale_ord_id", "event_time"]


def _deal_facts(lines: DataFrame, day: str) -> DataFrame:
    """Largest amount per order line, then the sum per parent order; non-consumer lines add 0."""
    consumer = F.col("type_c") == C.CONSUMER
    line = {
        "dt": F.col(day),
        "unif_user_log_acct": normal_account(F.col("unif_user_log_acct")),
        "user_log_acct": normal_account(F.col("user_log_acct")),
        "item_sku_id": F.col("item_sku_id"),
        "sale_ord_id": F.col("sale_ord_id"),
        "parent_sale_ord_id": F.when(consumer, F.col("parent_sale_ord_id")).otherwise(""),
        "event_time": whole_seconds(F.col("sale_ord_tm")),
    }
    amount = F.when(consumer, money(F.col("after_prefr_amount_1"))).otherwise(F.lit(0))
    return (
        unique_per_key(lines, line, _amount=F.max(amount))
        .groupBy(*FACT_KEYS)
        .agg(F.sum("_amount").cast(C.MONEY_SUM).alias("after_prefr_amount_1"))
    )


def _app_deals(version_rows: Column) -> Column:
    return (
        version_rows & (F.col("new_bs") == C.APP) & (F.col("intraday_ord_deal_flag") == "1")
    )


def stable_order_facts(orders: DataFrame, start: str, end: str | None = None) -> DataFrame:
    """Settled orders, by the partition of their day."""
    rows = (F.col("tp") == 0) & (F.col("dp") == C.DAY_TO_DATE)
    return _deal_facts(read_days(orders, start, end).where(_app_deals(rows)), "dt")


def history_order_facts(orders: DataFrame, start: str, end: str | None = None) -> DataFrame:
    """Settled orders of past years, kept in quarter partitions."""
    rows = (F.col("tp") == 1) & (F.col("dp") == C.QUARTER_TO_DATE)
    quarters = read_quarters(orders, start, end, "sale_ord_dt")
    return _deal_facts(quarters.where(_app_deals(rows)), "sale_ord_dt")


def snapshot_order_facts(
    orders: DataFrame,
    labels: DataFrame,
    names: DataFrame,
    start: str,
    end: str | None = None,
) -> DataFrame:
    """First look at a day: consumer orders come from a label table, accounts from a name table."""
    deals = read_days(orders, start, end).where(
        ~F.col("add_cart_plat_flag").isin(C.FOREIGN_CART_FLAGS)
        & (F.col("plat_flag") == C.APP)
        & (F.col("deal_flag") == "1")
    )
    line = {
        "dt": F.col("dt"),
        "user_log_acct": normal_account(F.col("user_log_acct")),
        "item_sku_id": F.col("item_sku_id"),
        "sale_ord_id": F.col("sale_ord_id"),
        "parent_sale_ord_id": F.col("parent_sale_ord_id"),
        "event_time": whole_seconds(F.col("sale_ord_tm")),
    }
    lines = unique_per_key(deals, line, _amount=F.max(money(F.col("after_prefr_amount"))))
    consumer = read_days(labels, start, end).where(F.col("first_biz") == C.CONSUMER_BUSINESS)
    flagged = flag_members(lines, consumer, ["dt", "sale_ord_id", "item_sku_id"], "_consumer")
    # The account follows from the login, so adding up by login first gives the same groups and
    # leaves fewer rows for the join with names.
    by_login = flagged.groupBy(
        "dt",
        "user_log_acct",
        F.when(F.col("_consumer"), F.col("parent_sale_ord_id"))
        .otherwise("")
        .alias("parent_sale_ord_id"),
        "event_time",
    ).agg(
        F.sum(F.when(F.col("_consumer"), F.col("_amount")).otherwise(F.lit(0)))
        .cast(C.MONEY_SUM)
        .alias("after_prefr_amount_1")
    )
    renamed = read_days(names, start, end).where(
        F.col("user_acct_name") != F.col("unif_user_log_acct")
    )
    accounts = unique_per_key(
        renamed,
        {"dt": F.col("dt"), "user_log_acct": normal_account(F.col("user_acct_name"))},
        _account=F.max(normal_account(F.col("unif_user_log_acct"))),
    )
    joined = left_join_missing_aside(
        by_login.withColumn("_login", F.col("user_log_acct")),
        accounts.withColumnRenamed("user_log_acct", "_login"),
        "_login",
        also=["dt"],
        empty_is_missing=False,
    )
    account = F.coalesce("_account", "user_log_acct").alias("unif_user_log_acct")
    columns = [account if name == "unif_user_log_acct" else F.col(name) for name in FACT_KEYS]
    return joined.select(*columns, "after_prefr_amount_1")
