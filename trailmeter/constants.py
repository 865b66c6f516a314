"""Business values.

Everything between the two markers is a fixed value: it has to match the tables
these jobs read and the labels their consumers filter on.
"""

# --- fixed values -----------------------------------------------------------

# Play mode: own / co-play / media.
PLAY_OWN = "京东播放"
PLAY_SHARED = "共播"
PLAY_MEDIA = "媒体播放"
OWN_GROUPS = ["2", "4", "12", "23", "21", "1", "-999999"]
SHARED_TYPES = ["854", "315", "157", "317"]
MIXED_TYPES = ["99", "237"]
MIXED_CAMPAIGNS = ["8", "13", "77"]

# Click fact and wide summary filters.
OFF_SITE = "2"
LANDING_PAGE = "3"
BILLED_PARTITION = "RTB_all"
UNBILLED_PARTITION = "rtbnc"
SOCIAL_PARTITION = "GDT"
NOT_BILLED = "1"
CLIENT_EVENT_TYPES = [0, 1, 3, 4]
DELIVERY_SYSTEMS = ["0", "12"]
MATCH_BUSINESS_TYPES = ["4", "256", "2048"]
CLICK_ID_TYPES = ["99", "122", "251"]
SKU_AD_TYPE = "3"
AUCTION_BUSINESS_TYPES = ["2048", "33554432", "4", "256", "67108864", "524288"]
PERFORMANCE_SALES = "效果"
EXTERNAL_RESOURCE = "external"
CPC = "cpc"
CLICK_ID_MACRO = "{CLICK_ID}"

# Monitor measures, in the order of the output table.
MONITOR_MEASURES = [
    "all_clicks",
    "placementid_isnull_clicks",
    "consumption",
    "placementid_isnull_consumption",
    "repage_finance_clicks",
    "repage_last_placementid_isnull_finance_clicks",
    "finance_clicks",
    "clickid_isnull_finance_clicks",
    "summary_finance_clicks",
    "detail_finance_clicks",
    "detail_rtb_join_c2s_clicks",
    "detail_rtb_clicks",
    "detail_s2s_clicks",
    "detail_c2s_clicks",
    "summary_cpc_consumption",
    "detail_cpc_consumption",
]
PAGE_VIEW_CHANNELS = [
    "pv_chan_first_cate_cd",
    "pv_chan_second_cate_cd",
    "pv_chan_third_cate_cd",
    "pv_chan_fourth_cate_cd",
]

# Visit channels, most important first.
CHANNELS = [
    "直接流量",
    "搜索及信息流",
    "展示广告",
    "广告变现",
    "腾讯资源",
    "联盟",
    "APP投放引流",
    "付费其他",
    "免费其他",
]
OTHER_CHANNELS = "其他"
OTHER_CHANNELS_SNAPSHOT = "其他组合"
TIMES = "次"
FREQ_7_TO_10 = "[7-10]次"
FREQ_OVER_10 = ">10次"
NO_ACCOUNT = "无pin"
UNKNOWN_LIFECYCLE = "生命周期未知(有pin)"
NO_VISIT_CYCLE = "近365日未访"
NO_BUY_CYCLE = "历史未购"

# Orders.
APP = "APP"
DAY = "day"
CONSUMER = "C端"
CONSUMER_BUSINESS = "TOC_零售"
FOREIGN_CART_FLAGS = ["YHD_PC", "YHD_M", "YHD_APP"]
DAY_TO_DATE = "DTD"
QUARTER_TO_DATE = "QTD"

# Rollup: dimensions (first one is the highest grouping bit) and levels.
ROLLUP_DIMENSIONS = [
    "is_visit_multi_chan",
    "tc_visit_chan",
    "user_visit_freq",
    "user_life_cycle_type",
    "user_visitcycle",
    "user_buycycle",
]
ROLLUP_LEVELS = {
    "0": [],
    "1": ["is_visit_multi_chan"],
    "2": ["tc_visit_chan"],
    "3": ["is_visit_multi_chan", "tc_visit_chan"],
    "4": ["user_visit_freq"],
    "5": ["user_visit_freq", "user_life_cycle_type"],
    "7": ROLLUP_DIMENSIONS,
}
PATH_LEVEL = "6"

# Export.
SHARDS = 30_000
EXPORT_SORT = [
    "platform",
    "lvl",
    "tc_visit_chan",
    "visit_chan_cate2_cds_with_times",
    "user_life_cycle_type",
    "user_visit_freq",
]
EXPORT_BATCH_ROWS = 500_000
EXPORT_WRITERS = 25
FILE_BYTES = 256_000_000

# --- end of fixed values ----------------------------------------------------

SNAPSHOT = "snapshot"
STABLE = "stable"
HISTORY = "history"

# Money is added as a decimal, so a sum does not depend on the order of rows.
MONEY = "decimal(22,6)"
MONEY_SUM = "decimal(28,6)"
