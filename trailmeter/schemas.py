"""Explicit schemas of the input roles. Every table is partitioned by ``dt`` (yyyy-MM-dd)."""

from __future__ import annotations

from pyspark.sql.types import (
    DecimalType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


def _table(text: str, **typed) -> StructType:
    fields = [StructField(name, StringType()) for name in text.split()]
    fields += [StructField(name, kind) for name, kind in typed.items()]
    return StructType([*fields, StructField("dt", StringType())])


def _ordered(columns: list[str], **typed) -> StructType:
    return StructType([StructField(name, typed.get(name, StringType())) for name in columns])


CLICKS = _table(
    "dp loc ad_traffic_type ad_traffic_group campaign_type placement_id last_pos_id click_id sid "
    "is_bill event_type delivery_system_type business_type ad_type item_sku_id material_id "
    "ad_billing_type",
    total_price=DoubleType(),
)
WIDE = _table(
    "ad_traffic_type ad_traffic_group campaign_type placement_id sales_type resource_type "
    "ad_comsumption_type ad_business_type",
    clicks=LongType(),
    consumption=DoubleType(),
)
PAGE_VIEWS = _table(
    "pv_chan_first_cate_cd pv_chan_second_cate_cd pv_chan_third_cate_cd pv_chan_fourth_cate_cd "
    "is_join_clikc_flag clk_utm_term"
)
VISITS = _table(
    "platform unif_user_log_acct user_log_acct browser_uniq_id chan_second_cate_desc_bel pv_id "
    "request_tm"
)
ORDERS = _table(
    "dp new_bs intraday_ord_deal_flag type_c unif_user_log_acct user_log_acct item_sku_id "
    "sale_ord_id parent_sale_ord_id sale_ord_tm sale_ord_dt",
    tp=IntegerType(),
    after_prefr_amount_1=DoubleType(),
)
SNAPSHOT_ORDERS = _table(
    "add_cart_plat_flag plat_flag deal_flag user_log_acct item_sku_id sale_ord_id "
    "parent_sale_ord_id sale_ord_tm",
    after_prefr_amount=DoubleType(),
)
ORDER_LABELS = _table("first_biz sale_ord_id item_sku_id")
ACCOUNT_NAMES = _table("user_acct_name unif_user_log_acct")
LIFECYCLE_TAGS = _table("unif_user_log_acct user_log_acct user_life_cycle_type")
STATUS_TAGS = _table("unif_user_log_acct init_acct_status")
ACCOUNT_TAGS = _table("unif_user_log_acct user_visitcycle_app user_buycycle_all")
DEVICE_TAGS = _table("browse_uniq_id user_visitcycle_app user_buycycle_all")

# Output column orders; the partition columns come last.
DETAIL_COLUMNS = (
    "platform unif_user_log_acct user_log_acct browser_uniq_id attr user_life_cycle_type "
    "parent_sale_ord_id tc_visit_chan tc_visit_chan_num visit_chan_cate2_cds_with_times "
    "user_visit_freq tc_visit_times tc_user_visits_before_deal tc_deal_after_prefr_amount_1 "
    "path_user_visit_freq user_visitcycle user_buycycle dt tp dp"
).split()
DETAIL = _ordered(
    DETAIL_COLUMNS,
    tc_visit_chan_num=IntegerType(),
    tc_visit_times=LongType(),
    tc_user_visits_before_deal=IntegerType(),
    tc_deal_after_prefr_amount_1=DecimalType(28, 6),
)
ROLLUP_COLUMNS = (
    "platform lvl is_visit_multi_chan tc_visit_chan user_visit_freq user_life_cycle_type "
    "visit_chan_cate2_cds_with_times uv tc_user_visits tc_user_visits_before_deal_t1 "
    "deal_user_num_toc_t1 deal_order_num_toc_t1 deal_after_prefr_amount_1_toc_t1 "
    "tc_user_visits_before_deal_t2 deal_user_num_toc_t2 deal_order_num_toc_t2 "
    "deal_after_prefr_amount_1_toc_t2 path_user_visit_freq user_visitcycle user_buycycle dt tp dp"
).split()
ROLLUP = _ordered(
    ROLLUP_COLUMNS,
    uv=LongType(),
    tc_user_visits=LongType(),
    **{
        f"{name}_{side}": DoubleType() if "amount" in name else LongType()
        for side in ("t1", "t2")
        for name in (
            "tc_user_visits_before_deal",
            "deal_user_num_toc",
            "deal_order_num_toc",
            "deal_after_prefr_amount_1_toc",
        )
    },
)
