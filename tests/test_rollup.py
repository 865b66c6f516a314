import random

import pytest

from trailmeter import constants as C
from trailmeter.plans import rollup as R
from trailmeter.schemas import DETAIL, ROLLUP_COLUMNS

pytestmark = pytest.mark.usefixtures("fixed_plans")

DAYS = ("2024-01-01", "2024-01-02")


def random_detail(seed, n):
    rng = random.Random(seed)
    pick = rng.choice
    return [
        {
            "dt": pick(DAYS),
            "tp": pick(["day", "day", "day", "week"]),
            "dp": pick(["stable", "stable", "snapshot"]),
            "platform": pick(["APP", "APP", "PC"]),
            "unif_user_log_acct": pick(["", None, *[f"a{n}" for n in range(8)]]),
            "browser_uniq_id": pick(["", None, *[f"d{n}" for n in range(8)]]),
            "attr": pick(["order", "visit", None]),
            "user_life_cycle_type": pick([None, "l1", "l2"]),
            "parent_sale_ord_id": pick(["", None, *[f"p{n}" for n in range(6)]]),
            "tc_visit_chan": pick([None, "", "c1", "c2"]),
            "tc_visit_chan_num": pick([None, 0, 1, 3, 4]),
            "visit_chan_cate2_cds_with_times": pick([None, "", "x|1", "y|2"]),
            "user_visit_freq": pick([None, "0次", "1次"]),
            "tc_visit_times": pick([None, 0, 1, 9]),
            "tc_user_visits_before_deal": pick([None, 0, 2]),
            "tc_deal_after_prefr_amount_1": pick([None, "0", "1.50", "7.25"]),
            "path_user_visit_freq": pick(["0次", "2次"]),
            "user_visitcycle": pick(["v1", None]),
            "user_buycycle": pick(["b1", "b2"]),
        }
        for _ in range(n)
    ]


@pytest.fixture
def detail(make):
    def build(rows):
        from decimal import Decimal

        name = "tc_deal_after_prefr_amount_1"
        return make([{**r, name: r[name] and Decimal(r[name])} for r in rows], DETAIL)

    return build


@pytest.mark.parametrize("version", [C.STABLE, C.SNAPSHOT])
@pytest.mark.parametrize("size", [6, 500])
def test_each_form_equals_its_plain_form(detail, rows_of, version, size):
    df = detail(random_detail(size, size))
    for tuned, plain in (
        (R.rollup_levels, R.rollup_levels_plain),
        (R.rollup_paths, R.rollup_paths_plain),
    ):
        found = tuned(df, *DAYS, version)
        assert found.columns == ROLLUP_COLUMNS
        assert rows_of(found) == rows_of(plain(df, *DAYS, version))


def test_tasks_follow_the_rows_of_the_detail(detail, rows_of, capsys, monkeypatch):
    df = detail(random_detail(4, 500))
    n = R._detail_rows(df, *DAYS, C.STABLE, True).count()
    forms = R.rollup_levels, R.rollup_paths, R.rollup_levels_plain, R.rollup_paths_plain
    before = [rows_of(form(df, *DAYS)) for form in forms]
    monkeypatch.setattr(R, "FACET_ROWS", 7)
    monkeypatch.setattr(R, "PLAIN_ROWS", 3)
    for form, rows, most in zip(forms, before, (7, 7, 3, 3), strict=True):
        found = form(df, *DAYS)
        assert rows_of(found) == rows
        found.explain()
        assert f", {-(-n // most)}), REPARTITION_BY_NUM" in capsys.readouterr().out


def test_levels_add_up(detail):
    rows = R.rollup_levels(detail(random_detail(3, 400)), *DAYS).collect()
    for day in DAYS:
        total = [r for r in rows if r.dt == day and r.lvl == "0"]
        finest = [r for r in rows if r.dt == day and r.lvl == "7"]
        assert len(total) == 1
        assert total[0].uv == sum(r.uv for r in finest)
        amount = "deal_after_prefr_amount_1_toc_t2"
        assert total[0][amount] == pytest.approx(sum(r[amount] or 0 for r in finest))


def row(account, device, parent="", attr="visit", **more):
    base = random_detail(0, 1)[0]
    fixed = {
        "dt": DAYS[0],
        "tp": "day",
        "dp": "stable",
        "platform": "APP",
        "unif_user_log_acct": account,
        "browser_uniq_id": device,
        "attr": attr,
        "parent_sale_ord_id": parent,
        "user_life_cycle_type": None,
        "tc_visit_chan": "c",
        "tc_visit_chan_num": 1,
        "user_visit_freq": "1次",
        "tc_visit_times": 3,
        "tc_user_visits_before_deal": 1,
        "tc_deal_after_prefr_amount_1": "2.5",
        "user_visitcycle": "v",
        "user_buycycle": "b",
        "visit_chan_cate2_cds_with_times": "x|1",
        "path_user_visit_freq": "1次",
    }
    return {**base, **fixed, **more}


def level(df, lvl):
    return [r for r in df.collect() if r.lvl == lvl]


def test_one_user_with_two_devices_and_orders(detail):
    rows = [row("a", d, p, "order") for d in ("d1", "d2") for p in ("p1", "p2", "")]
    (total,) = level(R.rollup_levels(detail(rows), DAYS[0]), "0")
    assert (total.uv, total.tc_user_visits, total.deal_user_num_toc_t2) == (2, 3, 1)
    assert (total.deal_order_num_toc_t2, total.deal_after_prefr_amount_1_toc_t2) == (2, 7.5)
    assert total.tc_user_visits_before_deal_t2 == 3
    assert (total.deal_user_num_toc_t1, total.deal_after_prefr_amount_1_toc_t1) == (0, 0.0)


def test_order_shared_by_two_users_counts_once(detail):
    rows = [row(a, None, "p1", "order") for a in ("a", "b")]
    (total,) = level(R.rollup_levels(detail(rows), DAYS[0]), "0")
    assert (total.deal_user_num_toc_t2, total.deal_order_num_toc_t2) == (2, 1)


def test_a_real_null_is_not_a_rolled_up_one(detail):
    found = R.rollup_levels(detail([row("a", "d1"), row("b", "d2", user_life_cycle_type="l")]), DAYS[0])
    assert sorted(str(r.user_life_cycle_type) for r in level(found, "5")) == ["None", "l"]
    assert len(level(found, "4")) == 1


def test_path_level_repeats_the_visits_of_the_day(detail):
    rows = [row("a", "d1", path_user_visit_freq=f) for f in ("1次", "2次")]
    found = level(R.rollup_paths(detail(rows), DAYS[0]), "6")
    assert sorted((r.path_user_visit_freq, r.tc_user_visits, r.uv) for r in found) == [
        ("1次", 3, 1),
        ("2次", 3, 1),
    ]
    assert {(r.tc_visit_chan, r.user_visit_freq) for r in found} == {(None, None)}


def test_snapshot_measures_go_to_the_first_columns(detail):
    rows = [row("a", "d1", "p1", "order", dp="snapshot")]
    (total,) = level(R.rollup(detail(rows), DAYS[0], version=C.SNAPSHOT), "0")
    assert (total.deal_order_num_toc_t1, total.deal_order_num_toc_t2, total.dp) == (1, 0, "snapshot")


def test_history_is_kept_as_stable_and_unknown_versions_fail(detail):
    df = detail(random_detail(4, 200))
    stable = R.rollup(df, *DAYS, "stable").count()
    assert stable and R.rollup(df, *DAYS, "history").count() == stable
    with pytest.raises(ValueError, match="unknown version"):
        R.rollup(df, *DAYS, "other")


@pytest.mark.parametrize("missing", [False, True])
def test_visits_are_those_of_all_users(make, missing):
    """Users that the detail tells apart by device stay apart in the rollup."""
    rows = [
        {"dt": DAYS[0], "tp": "day", "dp": "stable", "platform": "APP", "attr": "visit",
         "unif_user_log_acct": "", "browser_uniq_id": d, "tc_visit_times": n}
        for d, n in (("d1", 1), ("d2", 2))
    ]
    levels = R.rollup_levels(make(rows, DETAIL), *DAYS, "stable", missing)
    total = levels.where("lvl = '0' or lvl = 0").select("tc_user_visits").collect()
    assert [r[0] for r in total] == [3 if missing else 2]
