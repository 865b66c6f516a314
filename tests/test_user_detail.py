import pytest

from trailmeter import constants as C
from trailmeter import schemas as S
from trailmeter.operators import paths
from trailmeter.plans import user_detail as U
from trailmeter.plans.orders import FACT_KEYS

pytestmark = pytest.mark.usefixtures("fixed_plans")

DAY, BEFORE = "2024-01-02", "2024-01-01"
FACTS = ", ".join(f"{n} string" for n in FACT_KEYS) + ", after_prefr_amount_1 double"


def visit(account, device, channel=C.CHANNELS[0], pv="v1", clock="10:00:00", **more):
    return {
        "dt": DAY,
        "platform": "APP",
        "unif_user_log_acct": account,
        "user_log_acct": account,
        "browser_uniq_id": device,
        "chan_second_cate_desc_bel": channel,
        "pv_id": pv,
        "request_tm": f"{DAY} {clock}",
        **more,
    }


def order(account, parent="p1", clock="11:00:00", amount=5.0):
    return {
        "dt": DAY,
        "unif_user_log_acct": account,
        "user_log_acct": account,
        "parent_sale_ord_id": parent,
        "event_time": f"{DAY} {clock}",
        "after_prefr_amount_1": amount,
    }


@pytest.fixture
def detail(make):
    def build(visits, orders=(), life=(), status=(), accounts=(), devices=(), **options):
        tags = U.UserTags(
            make(list(life), S.LIFECYCLE_TAGS),
            make(list(status), S.STATUS_TAGS),
            make(list(accounts), S.ACCOUNT_TAGS),
            make(list(devices), S.DEVICE_TAGS),
        )
        facts = make(list(orders), FACTS).withColumn("dt", U.F.col("dt"))
        facts = facts.withColumn(
            "after_prefr_amount_1", U.F.col("after_prefr_amount_1").cast(C.MONEY_SUM)
        )
        return U.user_detail(make(list(visits), S.VISITS), facts, tags, DAY, **options).collect()

    return build


def test_identities_of_one_account(detail):
    rows = detail([visit("a", "d1"), visit("a", "d2", pv="v2")], [order("a")])
    # Two devices and the order's own identity, each with the one path of the account.
    assert {r.browser_uniq_id for r in rows} == {"d1", "d2", None}
    assert {(r.attr, r.tc_visit_times, r.parent_sale_ord_id) for r in rows} == {("order", 2, "p1")}
    assert {r.visit_chan_cate2_cds_with_times for r in rows} == {f"{C.CHANNELS[0]}|2"}
    assert {float(r.tc_deal_after_prefr_amount_1) for r in rows} == {5.0}
    assert {(r.platform, r.dt, r.tp, r.dp) for r in rows} == {("APP", DAY, "day", "stable")}


def test_device_only_and_no_identity(detail):
    rows = {r.browser_uniq_id: r for r in detail([visit(None, "d1"), visit(None, None)])}
    assert rows["d1"].attr == "visit" and rows["d1"].path_user_visit_freq == "1次"
    lost = rows[None]
    assert (lost.attr, lost.parent_sale_ord_id, lost.tc_visit_times) == (None, None, None)
    assert (lost.user_visit_freq, lost.path_user_visit_freq) == (None, "0次")
    # An unknown number of channels is the other label, not ''.
    assert (lost.tc_visit_chan_num, lost.tc_visit_chan) == (None, C.OTHER_CHANNELS)
    assert lost.user_life_cycle_type == C.NO_ACCOUNT


def test_empty_accounts_merge_only_if_asked(detail):
    visits = [visit("", "d1"), visit("", "d2", pv="v2")]
    merged = detail(visits, empty_account_is_missing=False)
    assert [r.tc_visit_times for r in merged] == [2, 2]
    assert {r.user_life_cycle_type for r in merged} == {None}
    apart = detail(visits)
    assert [r.tc_visit_times for r in apart] == [1, 1]


def test_empty_accounts_add_rows_in_proportion(detail):
    few, many = (
        len(detail([visit("", f"d{n}", pv=f"v{n}") for n in range(users)])) for users in (10, 20)
    )
    assert (few, many) == (10, 20)


def test_order_without_consumer_id_still_makes_an_order_user(detail):
    (row,) = detail([], [order("a", parent="", amount=0.0)])
    assert (row.attr, row.parent_sale_ord_id, row.tc_visit_times) == ("order", "", 0)
    assert (row.tc_visit_chan, row.tc_visit_chan_num, row.user_visit_freq) == ("", 0, "0次")


@pytest.mark.parametrize("number", [1, 4, 5])
def test_channel_labels(detail, number):
    visits = [visit("a", "d", channel=c, pv=c) for c in reversed(C.CHANNELS[:number])]
    visits.append(visit("a", "d", channel="elsewhere", pv="x"))
    (row,) = detail(visits)
    joined = "+".join(C.CHANNELS[:number])
    assert row.tc_visit_chan_num == number
    assert row.tc_visit_chan == (joined if number <= 4 else C.OTHER_CHANNELS)
    (snap,) = detail(visits, version=C.SNAPSHOT)
    assert snap.tc_visit_chan == (joined if number <= 4 else C.OTHER_CHANNELS_SNAPSHOT)
    assert snap.dp == "snapshot"


def test_more_than_ten_visits(detail):
    visits = [visit("a", "d", pv=f"v{n}", clock=f"10:{n:02d}:00") for n in range(11)]
    (row,) = detail(visits)
    assert (row.user_visit_freq, row.path_user_visit_freq) == (C.FREQ_OVER_10, C.FREQ_OVER_10)


def test_visits_at_the_time_of_an_order_come_first(detail):
    rows = detail([visit("a", "d", clock="11:00:00")], [order("a")])
    assert {(r.parent_sale_ord_id, r.tc_user_visits_before_deal) for r in rows} == {("p1", 1)}


def test_users_with_several_chunks_of_orders(detail, monkeypatch):
    """Two orders make two chunks of one, and a third chunk that is empty."""
    visits = [visit("a", d, clock=f"10:{n}0:00") for n in range(3) for d in ("d1", "d2")]
    orders = [order("a", f"p{n}", f"10:{n}5:00", n + 1.0) for n in range(2)]
    last = [order("a", "p2", "10:25:00", 3.0)]
    for found in (orders, orders + last):
        expected = detail(visits, found)
        with monkeypatch.context() as patch:
            patch.setattr(paths, "SEGMENT_CHUNK", 1)
            assert sorted(map(str, detail(visits, found))) == sorted(map(str, expected))
        assert {r.tc_user_visits_before_deal for r in expected} == {2}
        assert len(expected) == 9


def test_other_platforms_and_days_are_left_out(detail):
    assert detail([visit("a", "d", platform="PC"), visit("b", "d", dt=BEFORE)]) == []


def life(value, account="A ", day=BEFORE):
    return {"dt": day, "unif_user_log_acct": account, "user_life_cycle_type": value}


def test_tag_days_and_keys(detail):
    account = {"unif_user_log_acct": " A"}
    (row,) = detail(
        [visit("a", "D1")],
        life=[life("old"), life("new"), life("zzz", day=DAY)],
        status=[{"dt": DAY, **account, "init_acct_status": "1"}],
        accounts=[{"dt": BEFORE, **account, "user_visitcycle_app": "av"}],
        devices=[{"dt": BEFORE, "browse_uniq_id": "D1", "user_buycycle_all": "db"}],
    )
    assert row.user_life_cycle_type == "old"
    assert (row.user_visitcycle, row.user_buycycle) == ("av", "db")


def test_tag_defaults_and_status(detail):
    (row,) = detail(
        [visit("a", "D1")],
        life=[{**life("x", account=None), "user_log_acct": "A"}],
        status=[
            {"dt": DAY, "unif_user_log_acct": "a", "init_acct_status": "1"},
            {"dt": DAY, "unif_user_log_acct": "a", "init_acct_status": "0"},
        ],
        # Device ids are compared as they are, and this one differs in case.
        devices=[{"dt": BEFORE, "browse_uniq_id": "d1", "user_buycycle_all": "db"}],
    )
    assert row.user_life_cycle_type == C.NO_ACCOUNT
    assert (row.user_visitcycle, row.user_buycycle) == (C.NO_VISIT_CYCLE, C.NO_BUY_CYCLE)
    (row,) = detail([visit("a", "d")], life=[{**life("x", account=None), "user_log_acct": "A"}])
    assert row.user_life_cycle_type == "x"


def test_visit_accounts_are_taken_as_they_are(detail):
    (row,) = detail([visit("A", "d")], life=[life("old")])
    assert row.user_life_cycle_type == C.UNKNOWN_LIFECYCLE


def test_unknown_version(detail):
    with pytest.raises(ValueError):
        detail([], version="weekly")
