"""Ranges that go on where a failed run stopped."""

import pytest

from trailmeter.plans import jobs
from trailmeter.sources.days import read_table, write_days

import test_monitor

pytestmark = pytest.mark.usefixtures("fixed_plans")

DAYS = [f"2024-01-0{n}" for n in range(1, 6)]


@pytest.fixture
def paths(spark, tmp_path):
    found = {name: str(tmp_path / name) for name in ("clicks", "wide")}
    for name, row in (("clicks", test_monitor.CLICK), ("wide", test_monitor.SUMMARY)):
        schema = jobs.SCHEMAS[name]
        rows = [tuple({**row, "dt": day}.get(n) for n in schema.names) for day in DAYS]
        write_days(spark.createDataFrame(rows, schema), found[name])
    return found


def opened(monkeypatch):
    """The days that the job is run for."""
    seen, real = [], jobs.run_click_monitor

    def run(spark, paths, out, start, end, **options):
        seen.append((start, end))
        real(spark, paths, out, start, end, **options)

    monkeypatch.setitem(jobs.INPUTS, run, jobs.INPUTS[real])
    return run, seen


def test_a_rerun_opens_only_unfinished_days(spark, paths, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    run, seen = opened(monkeypatch)

    def dies(spark, paths, out, start, end, **options):
        if start >= DAYS[2]:
            raise RuntimeError("lost")
        run(spark, paths, out, start, end, **options)

    dies.__name__ = run.__name__
    monkeypatch.setitem(jobs.INPUTS, dies, jobs.INPUTS[run])
    with pytest.raises(RuntimeError, match="lost"):
        jobs.run_restartable(dies, spark, paths, out, DAYS[0], DAYS[4])
    assert seen == [(d, d) for d in DAYS[:2]]
    assert jobs.run_restartable(run, spark, paths, out, DAYS[0], DAYS[4], days_at_once=2) == DAYS[2:]
    assert seen[2:] == [(DAYS[2], DAYS[3]), (DAYS[4], DAYS[4])]
    assert jobs.run_restartable(run, spark, paths, out, DAYS[0], DAYS[4]) == []
    rows = read_table(spark, out, "dt string, all_clicks double").collect()
    assert sorted((r.dt, r.all_clicks) for r in rows) == [(d, 1.0) for d in DAYS]


def test_a_day_with_new_inputs_is_run_again(spark, paths, tmp_path, monkeypatch):
    out = str(tmp_path / "out")
    run, seen = opened(monkeypatch)
    jobs.run_restartable(run, spark, paths, out, DAYS[0], DAYS[1], days_at_once=9)
    schema = jobs.SCHEMAS["clicks"]
    row = tuple({**test_monitor.CLICK, "dt": DAYS[1]}.get(n) for n in schema.names)
    write_days(spark.createDataFrame([row, row], schema), paths["clicks"])
    # The day itself; the day after also reads it as the day before.
    assert jobs.run_restartable(run, spark, paths, out, DAYS[0], DAYS[1]) == [DAYS[1]]
    rows = read_table(spark, out, "dt string, all_clicks double").collect()
    assert sorted((r.dt, r.all_clicks) for r in rows) == [(DAYS[0], 1.0), (DAYS[1], 2.0)]


def test_gaps_begin_new_parts():
    days = [(d, "m") for d in (DAYS[0], DAYS[1], DAYS[3], DAYS[4])]
    assert [[d for d, _ in p] for p in jobs._parts(days, 3)] == [DAYS[:2], DAYS[3:]]


def test_ratios_are_a_job_of_their_own(spark, paths, tmp_path):
    out = str(tmp_path / "ratios")
    assert jobs.run_restartable(jobs.run_monitor_ratios, spark, paths, out, DAYS[0], DAYS[1]) == DAYS[:2]
    assert spark.read.parquet(out).count() == 2
