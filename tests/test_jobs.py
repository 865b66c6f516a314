"""All jobs over stored tables, one after another, as they run every day."""

import pytest

from trailmeter import schemas
from trailmeter.plans import jobs
from trailmeter.sources.days import read_table, write_days

import test_monitor
import test_orders
import test_user_detail

pytestmark = pytest.mark.usefixtures("fixed_plans")

DAY, BEFORE = "2024-01-02", "2024-01-01"


@pytest.fixture(scope="module")
def paths(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("tables")

    def frame(rows, schema):
        return spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)

    at = {"dt": DAY}
    order = {**test_orders.LINE, **at, "sale_ord_tm": f"{DAY} 11:00:00.5", "sale_ord_dt": DAY}
    snap = {**test_orders.SNAP, **at, "sale_ord_tm": f"{DAY} 11:00:00.5"}
    quarter = {**order, "dt": "2024-01-01", "tp": 1, "dp": "QTD"}
    visits = [test_user_detail.visit("acct", "d1"), test_user_detail.visit("acct", "d2", pv="v2")]
    rows = {
        "clicks": [{**test_monitor.CLICK, **at}],
        "wide": [{**test_monitor.SUMMARY, **at}],
        "page_views": [{**at, "pv_chan_first_cate_cd": "x"}],
        "visits": visits,
        "orders": [order, quarter],
        "snapshot_orders": [snap],
        "order_labels": [{**test_orders.LABEL, **at}],
        "account_names": [{**test_orders.NAME, **at, "unif_user_log_acct": "acct"}],
        "lifecycle_tags": [test_user_detail.life("old", "acct")],
        "status_tags": [],
        "account_tags": [],
        "device_tags": [],
    }
    found = {name: str(root / name) for name in jobs.SCHEMAS}
    for name, values in rows.items():
        table = frame(values, jobs.SCHEMAS[name])
        if values:
            write_days(table, found[name])
        else:
            table.write.parquet(found[name])
    return found


def test_click_monitor_job(spark, paths, tmp_path):
    out = str(tmp_path / "out")
    jobs.run_click_monitor(spark, paths, out, BEFORE, DAY)
    (row,) = spark.read.parquet(out).collect()
    assert (row.all_clicks, row.consumption, str(row.dt)) == (1.0, 1.0, DAY)
    jobs.run_click_monitor(spark, paths, out, BEFORE, DAY)
    assert spark.read.parquet(out).count() == 1


def test_page_view_job(spark, paths, tmp_path):
    out = str(tmp_path / "out")
    jobs.run_page_view_monitor(spark, paths, out, DAY)
    (row,) = spark.read.parquet(out).collect()
    assert (row.pv_chan_first_cate_cd, row.pv) == ("x", 1.0)


def test_detail_rollup_and_export_jobs(spark, paths, tmp_path):
    for version in ("snapshot", "stable", "history", "snapshot"):
        jobs.run_user_detail(spark, paths, paths["detail"], BEFORE, DAY, version)
    detail = read_table(spark, paths["detail"], schemas.DETAIL)
    found = {(r.dp, r.browser_uniq_id) for r in detail.collect()}
    assert found == {(dp, d) for dp in ("stable", "snapshot") for d in ("d1", "d2", None)}
    assert {r.user_life_cycle_type for r in detail.collect()} == {"old"}

    for version in ("stable", "snapshot", "stable"):
        jobs.run_rollup(spark, paths, paths["rollup"], BEFORE, DAY, version)
    rollup = read_table(spark, paths["rollup"], schemas.ROLLUP)
    totals = {r.dp: r for r in rollup.where("lvl = '0'").collect()}
    assert totals["stable"].deal_after_prefr_amount_1_toc_t2 == 10.0
    assert totals["snapshot"].deal_after_prefr_amount_1_toc_t1 == 10.0
    assert {(r.uv, r.tc_user_visits) for r in totals.values()} == {(2, 2)}

    out = str(tmp_path / "export")
    jobs.run_export(spark, paths, out, BEFORE, DAY)
    exported = spark.read.parquet(out)
    assert exported.count() == rollup.count()
    assert exported.where("lvl = '0'").agg({"uv": "sum"}).first()[0] == 2
