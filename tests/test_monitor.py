import random

import pytest

from trailmeter import constants as C
from trailmeter.plans import monitor as M
from trailmeter.plans.page_views import page_view_monitor
from trailmeter.schemas import CLICKS, PAGE_VIEWS, WIDE

pytestmark = pytest.mark.usefixtures("fixed_plans")

DAY = "2024-01-01"
CLICK = {
    "dt": DAY,
    "dp": "RTB_all",
    "loc": "2",
    "ad_traffic_type": "99",
    "ad_traffic_group": "3",
    "campaign_type": "5",
    "placement_id": "p",
    "last_pos_id": "l",
    "click_id": "c",
    "sid": "s",
    "is_bill": "0",
    "event_type": "0",
    "delivery_system_type": "0",
    "business_type": "4",
    "ad_type": "3",
    "item_sku_id": "k",
    "material_id": "m",
    "ad_billing_type": "CPC",
    "total_price": 1.0,
}
SUMMARY = {
    "dt": DAY,
    "ad_traffic_type": "99",
    "ad_traffic_group": "3",
    "campaign_type": "5",
    "placement_id": "p",
    "sales_type": "效果",
    "resource_type": "external",
    "ad_comsumption_type": "cpc",
    "ad_business_type": "4",
    "clicks": 1,
    "consumption": 1.0,
}


@pytest.fixture
def clicks(make):
    return lambda *changes: make([{**CLICK, **c} for c in changes], CLICKS)


@pytest.fixture
def wide(make):
    return lambda *changes: make([{**SUMMARY, **c} for c in changes], WIDE)


def only(df, *names):
    (row,) = df.select(*names).collect()
    return tuple(row)


def test_missing_ids_are_counted_by_their_own_spelling(clicks):
    ids = [None, "", "0", "x"]
    first = clicks(*[{"placement_id": i} for i in ids])
    assert only(M.run_check(M.EMPTY_PLACEMENT, first), "all_clicks", "placementid_isnull_clicks") == (4, 1)
    second = clicks(*[{"last_pos_id": i, "loc": "3"} for i in ids])
    names = ["repage_finance_clicks", "repage_last_placementid_isnull_finance_clicks"]
    assert only(M.run_check(M.EMPTY_LAST_POSITION, second), *names) == (4, 2)
    third = clicks(*[{"click_id": i} for i in ids])
    names = ["finance_clicks", "clickid_isnull_finance_clicks"]
    assert only(M.run_check(M.EMPTY_CLICK_ID, third), *names) == (4, 1)


def test_billed_flag_is_a_number(clicks):
    flags = ["0", "1", "", None, "none", "01"]
    rows = clicks(*[{"is_bill": flag} for flag in flags])
    assert only(M.run_check(M.BILLED_TOTAL, rows), "detail_rtb_clicks") == (1,)


def test_event_types_that_are_no_number_count_on_neither_side(clicks):
    rows = clicks(*[{"event_type": e} for e in ["0", "4", "5", "", None, "x"]])
    assert only(M.run_check(M.EVENT_SIDES, rows), "detail_s2s_clicks", "detail_c2s_clicks") == (1, 2)


def test_media_play_only(clicks, wide):
    own = {"ad_traffic_group": "2", "ad_traffic_type": "1"}
    found = M.summary_vs_detail_clicks(clicks({}, own), wide({"clicks": 7}, {**own, "clicks": 5}))
    rows = [tuple(r) for r in found.select("summary_finance_clicks", "detail_finance_clicks").collect()]
    assert sorted(rows, key=str) == [(7, None), (None, 1)]
    assert {r.combine_play_type for r in found.collect()} == {C.PLAY_MEDIA}


def test_cpc_is_matched_in_any_case(clicks, wide):
    rows = clicks(
        {"ad_billing_type": "cPc", "total_price": 0.1},
        {"ad_billing_type": "CPC", "total_price": 0.2},
        {"ad_billing_type": "cpm", "total_price": 5.0},
        {"dp": "GDT", "is_bill": "1", "total_price": 1.0},
        {"dp": "rtbnc", "total_price": 1.0},
    )
    assert only(M.run_check(M.DETAIL_CPC, rows), "detail_cpc_consumption") == (1.3,)
    sums = wide({"consumption": 0.1}, {"ad_business_type": "1"}, {"sales_type": "x"})
    assert only(M.run_check(M.SUMMARY_CPC, sums), "summary_cpc_consumption") == (0.1,)


MATCH_CASES = {
    "same click id and sku": ([{}], [{}], 1),
    "two client rows, many billed rows": ([{}, {}], [{}, {}, {}], 2),
    "other sku": ([{}], [{"item_sku_id": "z"}], 0),
    "sku does not matter for other ads": (
        [{"ad_type": "1", "item_sku_id": "y"}],
        [{"ad_type": "1", "item_sku_id": "z"}],
        1,
    ),
    "session decides for other types": (
        [{"ad_traffic_type": "1", "click_id": "y"}],
        [{"ad_traffic_type": "1", "click_id": "z"}],
        1,
    ),
    "no type goes by session": ([{"ad_traffic_type": None}], [{"ad_traffic_type": None}], 1),
    "NULL key": ([{"click_id": None}], [{"click_id": None}], 0),
    "zero key": ([{"click_id": "0"}], [{"click_id": "0"}], 0),
    "zero item": ([{"item_sku_id": "0"}], [{"item_sku_id": "0"}], 0),
    "other day": ([{}], [{"dt": "2024-01-02"}], 0),
    "empty key": ([{"click_id": ""}], [{"click_id": ""}], 1),
}


@pytest.mark.parametrize("form", [M.matched_clicks, M.matched_clicks_one_scan])
@pytest.mark.parametrize("case", MATCH_CASES)
def test_match(clicks, form, case):
    client, billed, expected = MATCH_CASES[case]
    rows = [{"dp": "rtbnc", **c} for c in client] + [{"event_type": "9", **b} for b in billed]
    found = form(clicks(*rows)).collect()
    assert sum(r.detail_rtb_join_c2s_clicks for r in found) == expected
    if case == "empty key":
        assert form(clicks(*rows), drop_empty_keys=True).count() == 0


def test_a_billed_client_row_matches_itself(clicks):
    for form in (M.matched_clicks, M.matched_clicks_one_scan):
        assert only(form(clicks({})), "detail_rtb_join_c2s_clicks") == (1,)


@pytest.mark.parametrize("plan", [M.click_monitor_plain, M.click_monitor])
def test_negative_measures(clicks, wide, plan):
    """A negative sum stays if its check is alone with the key and turns 0 beside another check."""
    alone = {"ad_traffic_type": "7", "consumption": -5.0, "sales_type": "x"}
    beside = {"ad_traffic_type": "99", "consumption": -5.0, "sales_type": "x"}
    found = plan(clicks({}), wide(alone, beside), DAY)
    sums = {r.ad_traffic_type: (r.consumption, r.all_clicks) for r in found.collect()}
    assert sums == {"7": (-5.0, 0.0), "99": (0.0, 1.0)}


@pytest.mark.parametrize("plan", [M.click_monitor_plain, M.click_monitor])
def test_no_row_without_a_check(clicks, wide, plan):
    nothing = {"loc": "9", "ad_traffic_type": "42"}
    found = plan(clicks({}, nothing), wide(), DAY)
    assert [r.ad_traffic_type for r in found.collect()] == ["99"]


def random_clicks(rng, n):
    pick = rng.choice
    return [
        {
            "dt": pick([DAY, "2024-01-02"]),
            "dp": pick(["RTB_all", "rtbnc", "GDT", None]),
            "loc": pick(["2", "2", "3", None]),
            "ad_traffic_type": pick(["99", "315", "122", None]),
            "ad_traffic_group": pick(["2", "3", None]),
            "campaign_type": pick(["8", None]),
            "placement_id": pick(["", None, "p"]),
            "last_pos_id": pick(["", "0", None, "p"]),
            "click_id": pick(["", "0", None, *"abcdef"]),
            "sid": pick(["", "0", None, *"abcdef"]),
            "is_bill": pick(["0", "1", "", None]),
            "event_type": pick(["0", "5", "", None]),
            "delivery_system_type": pick(["0", "5"]),
            "business_type": pick(["4", "5"]),
            "ad_type": pick(["3", "1", None]),
            "item_sku_id": pick(["0", None, *"abc"]),
            "material_id": pick(["0", None, *"abc"]),
            "ad_billing_type": pick(["CPC", "cpm", None]),
            "total_price": pick([None, -2.5, 1.25, 0.1]),
        }
        for _ in range(n)
    ]


def random_wide(rng, n):
    pick = rng.choice
    return [
        {
            "dt": pick([DAY, "2024-01-02"]),
            "ad_traffic_type": pick(["99", "315", "8", None]),
            "ad_traffic_group": pick(["2", "3", None]),
            "campaign_type": pick(["8", None]),
            "placement_id": pick(["", None, "p"]),
            "sales_type": pick(["效果", None]),
            "resource_type": pick(["external", "x"]),
            "ad_comsumption_type": pick(["CPC", "cpm", None]),
            "ad_business_type": pick(["4", "9"]),
            "clicks": pick([None, -1, 2]),
            "consumption": pick([None, -7.5, 2.25]),
        }
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed, drop_empty", [(1, False), (2, True), (3, False)])
def test_fused_equals_plain(make, rows_of, seed, drop_empty):
    rng = random.Random(seed)
    # Few rows leave keys with a single check; many fill all of them.
    size = 40 if seed == 3 else 600
    c, w = make(random_clicks(rng, size), CLICKS), make(random_wide(rng, size // 4), WIDE)
    args = (c, w, DAY, "2024-01-02", drop_empty)
    plain = rows_of(M.click_monitor_plain(*args))
    assert plain and rows_of(M.click_monitor(*args)) == plain
    assert rows_of(M.matched_clicks(c, drop_empty)) == rows_of(
        M.matched_clicks_one_scan(c, drop_empty)
    )


def test_fused_reads_clicks_twice_and_wide_once(spark, tmp_path, make):
    for name, schema in (("c", CLICKS), ("w", WIDE)):
        make([], schema).write.parquet(str(tmp_path / name))
    c = spark.read.schema(CLICKS).parquet(str(tmp_path / "c"))
    w = spark.read.schema(WIDE).parquet(str(tmp_path / "w"))
    plans = {
        f.__name__: f(c, w, DAY)._jdf.queryExecution().executedPlan().toString()
        for f in (M.click_monitor, M.click_monitor_plain)
    }
    assert plans["click_monitor"].count("FileScan") == 3
    assert plans["click_monitor_plain"].count("FileScan") > 10


def test_ratios(clicks, wide):
    rows = clicks({"click_id": ""}, {}, {}, {})
    ratios = M.monitor_ratios(M.click_monitor(rows, wide({"clicks": 10}), DAY))
    names = ["clickid_isnull_ratio", "repage_last_placementid_isnull_ratio", "finance_clicks_diff"]
    assert only(ratios, *names) == (0.25, None, 6.0)


def test_page_views(make):
    base = dict(zip(C.PAGE_VIEW_CHANNELS, "abcd"), dt=DAY)
    rows = [
        {**base, "is_join_clikc_flag": "1", "clk_utm_term": "x{CLICK_ID}"},
        {**base, "is_join_clikc_flag": "0", "clk_utm_term": None},
        {**base, "is_join_clikc_flag": None, "clk_utm_term": "x1"},
        {**base, "pv_chan_first_cate_cd": None, "is_join_clikc_flag": "1"},
        {**base, "dt": "2024-01-02"},
    ]
    found = page_view_monitor(make(rows, PAGE_VIEWS), DAY)
    names = ["pv_chan_first_cate_cd", "pv", "join_click_pv", "jdv_click_id_macro_replace_faild"]
    rows = {tuple(r) for r in found.select(*names).collect()}
    assert rows == {("a", 3.0, 1.0, 1.0), (None, 1.0, 1.0, 0.0)}
