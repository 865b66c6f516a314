import pytest

from trailmeter.plans import orders as O
from trailmeter.schemas import ACCOUNT_NAMES, ORDER_LABELS, ORDERS, SNAPSHOT_ORDERS

pytestmark = pytest.mark.usefixtures("fixed_plans")

DAY = "2024-04-01"
LINE = {
    "dt": DAY,
    "tp": 0,
    "dp": "DTD",
    "new_bs": "APP",
    "intraday_ord_deal_flag": "1",
    "type_c": "C端",
    "unif_user_log_acct": " Acct ",
    "user_log_acct": "Login ",
    "item_sku_id": "s1",
    "sale_ord_id": "o1",
    "parent_sale_ord_id": "p1",
    "sale_ord_tm": f"{DAY} 10:00:00.5",
    "sale_ord_dt": DAY,
    "after_prefr_amount_1": 10.0,
}
SNAP = {
    "dt": DAY,
    "add_cart_plat_flag": "own",
    "plat_flag": "APP",
    "deal_flag": "1",
    "user_log_acct": " Login",
    "item_sku_id": "s1",
    "sale_ord_id": "o1",
    "parent_sale_ord_id": "p1",
    "sale_ord_tm": f"{DAY} 10:00:00.5",
    "after_prefr_amount": 10.0,
}
NAMES = ["unif_user_log_acct", "user_log_acct", "parent_sale_ord_id", "event_time"]


def facts(df):
    rows = df.select(*NAMES, "after_prefr_amount_1").collect()
    return sorted((*r[:4], float(r[4])) for r in rows)


def test_a_line_counts_once_with_its_largest_amount(make):
    rows = [
        LINE,
        {**LINE, "after_prefr_amount_1": 12.0},  # the same line again
        {**LINE, "item_sku_id": "s2", "after_prefr_amount_1": 3.0},
        {**LINE, "sale_ord_tm": f"{DAY} 10:00:00"},  # the same second without a fraction
        {**LINE, "sale_ord_tm": f"{DAY} 10:00:01", "after_prefr_amount_1": 1.0},
    ]
    found = O.stable_order_facts(make(rows, ORDERS), DAY)
    assert facts(found) == [
        ("acct", "login", "p1", f"{DAY} 10:00:00", 15.0),
        ("acct", "login", "p1", f"{DAY} 10:00:01", 1.0),
    ]


def test_other_orders_keep_a_row_without_money(make):
    rows = [{**LINE, "type_c": "B端"}, {**LINE, "type_c": None, "item_sku_id": "s2"}]
    found = O.stable_order_facts(make(rows, ORDERS), DAY)
    assert facts(found) == [("acct", "login", "", f"{DAY} 10:00:00", 0.0)]


def test_filters_of_the_settled_table(make):
    changes = [
        {"tp": 1},
        {"dp": "QTD"},
        {"new_bs": "PC"},
        {"intraday_ord_deal_flag": "0"},
        {"dt": "2024-03-31"},
    ]
    rows = [{**LINE, **c} for c in changes]
    assert O.stable_order_facts(make(rows, ORDERS), DAY).count() == 0


def test_history_reads_each_day_from_its_quarter(make):
    base = {**LINE, "tp": 1, "dp": "QTD"}
    rows = [
        {**base, "dt": "2024-01-01", "sale_ord_dt": "2024-03-31"},
        {**base, "dt": "2024-04-01", "sale_ord_dt": "2024-04-01"},
        {**base, "dt": "2024-01-01", "sale_ord_dt": "2024-04-01"},
        {**base, "dt": "2024-01-01", "sale_ord_dt": "2024-03-30"},
        {**base, "dt": "2024-04-01", "sale_ord_dt": "2024-04-01", "tp": 0},
    ]
    found = O.history_order_facts(make(rows, ORDERS), "2024-03-31", "2024-04-01").collect()
    assert sorted((r.dt, float(r.after_prefr_amount_1)) for r in found) == [
        ("2024-03-31", 10.0),
        ("2024-04-01", 10.0),
    ]


def snapshot(make, rows, labels, names):
    return facts(
        O.snapshot_order_facts(
            make(rows, SNAPSHOT_ORDERS),
            make(labels, ORDER_LABELS),
            make(names, ACCOUNT_NAMES),
            DAY,
        )
    )


LABEL = {"dt": DAY, "first_biz": "TOC_零售", "sale_ord_id": "o1", "item_sku_id": "s1"}
NAME = {"dt": DAY, "user_acct_name": "LOGIN", "unif_user_log_acct": " Main"}


def test_snapshot_labels_and_names(make):
    rows = [SNAP, {**SNAP, "item_sku_id": "s2", "after_prefr_amount": 4.0}]
    # Twice the same label must not double the amount; another business is no consumer order.
    labels = [LABEL, LABEL, {**LABEL, "item_sku_id": "s2", "first_biz": "other"}]
    assert snapshot(make, rows, labels, [NAME]) == [
        ("main", "login", "", f"{DAY} 10:00:00", 0.0),
        ("main", "login", "p1", f"{DAY} 10:00:00", 10.0),
    ]


def test_snapshot_account_without_another_name(make):
    own = {**NAME, "unif_user_log_acct": "LOGIN"}
    other_day = {**NAME, "dt": "2024-03-31"}
    (row,) = snapshot(make, [SNAP], [LABEL], [own, other_day])
    assert row[:2] == ("login", "login")
    two = [NAME, {**NAME, "unif_user_log_acct": "zeta"}]
    (row,) = snapshot(make, [SNAP], [LABEL], two)
    assert row[:2] == ("zeta", "login")


def test_snapshot_filters(make):
    changes = [
        {"add_cart_plat_flag": "YHD_PC"},
        {"add_cart_plat_flag": "YHD_APP"},
        {"add_cart_plat_flag": None},
        {"plat_flag": "PC"},
        {"deal_flag": "0"},
    ]
    assert snapshot(make, [{**SNAP, **c} for c in changes], [LABEL], [NAME]) == []
