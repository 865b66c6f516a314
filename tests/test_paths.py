import datetime as dt
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from trailmeter.operators import paths
from trailmeter.operators.running import running_sum_before

pytestmark = pytest.mark.usefixtures("fixed_plans")

COLS = paths.EventColumns(
    keys=["day", "u"],
    time="t",
    tie=["id"],
    is_order="o",
    channel="c",
    order_id="oid",
    amount="m",
    visit_id="v",
)
SCHEMA = (
    "day string, u string, t timestamp_ntz, id int, o boolean, c string, oid string, "
    "m int, v string"
)
START = dt.datetime(2024, 1, 1)


def naive(events, distinct=False, cumulative=False):
    """One pass over each user's sorted events, as plainly as it can be said."""
    users = defaultdict(list)
    for e in events:
        users[e[0], e[1]].append(e)
    out = set()
    for (day, user), found in users.items():
        found.sort(key=lambda e: (e[2], e[3]))
        seg, seen = 0, set()
        segments = defaultdict(lambda: {"order": "", "amount": 0, "visits": [], "has": False})
        for _, _, t, i, is_order, channel, oid, amount, visit in found:
            s = segments[seg]
            if is_order:
                s.update(order=oid or "", amount=amount or 0, has=True)
                seg += 1
                continue
            if distinct:
                scope = (visit,) if cumulative else (visit, seg)
                counts = visit is not None and scope not in seen
                seen.add(scope)
            else:
                counts = True
            if counts:
                s["visits"].append((t, channel or ""))
        before = len(segments[0]["visits"]) if segments[0]["has"] else 0
        so_far = []
        for n in sorted(segments):
            s = segments[n]
            so_far += s["visits"]
            visits = so_far if cumulative else s["visits"]
            times = Counter(c for _, c in visits)
            first = {}
            for t, c in visits:
                first[c] = min(first.get(c, t), t)
            steps = sorted(times, key=lambda c: (first[c], c))
            path = ">".join(f"{c}|{times[c]}" for c in steps)
            out.add((day, user, n, s["order"], float(s["amount"]), path, len(visits), before))
    return out


def computed(spark, events, **options):
    df = paths.conversion_paths(spark.createDataFrame(events, SCHEMA), COLS, **options)
    assert df.where(F.col("chunk") != F.floor(F.col("seg") / paths.SEGMENT_CHUNK)).count() == 0
    return [(*r[:4], float(r[4]), *r[5:]) for r in df.drop("chunk").collect()]


def random_events(seed, size, users, minutes):
    rng = random.Random(seed)
    events = []
    for n in range(size):
        is_order = rng.random() < 0.3
        events.append(
            (
                rng.choice(["2024-01-01", "2024-01-02"]),
                rng.choice(users),
                # Whole seconds in few minutes: many ties, decided by id.
                START + dt.timedelta(seconds=rng.randrange(minutes * 60)),
                n,
                is_order,
                None if is_order else rng.choice(["a", "b", "c", None]),
                rng.choice([f"o{n}", ""]) if is_order else None,
                rng.choice([rng.randrange(1000), None]) if is_order else None,
                None if is_order else rng.choice(["v1", "v2", "v3", "v4", None]),
            )
        )
    return events


@pytest.mark.parametrize("distinct", [False, True])
@pytest.mark.parametrize("cumulative", [False, True])
def test_random_events_match_a_plain_loop(spark, monkeypatch, distinct, cumulative):
    # Two segments per chunk, so that most users need several.
    monkeypatch.setattr(paths, "SEGMENT_CHUNK", 2)
    events = random_events(11, 400, [f"u{n}" for n in range(12)], minutes=5)
    found = computed(spark, events, distinct_visits=distinct, cumulative=cumulative)
    assert len(found) == len(set(found))
    assert set(found) == naive(events, distinct, cumulative)


def test_one_user_with_nearly_all_events(spark, monkeypatch):
    monkeypatch.setattr(paths, "SEGMENT_CHUNK", 50)
    events = random_events(5, 3000, ["hot"] * 30 + ["cold"], minutes=600)
    assert set(computed(spark, events)) == naive(events)


def event(n, is_order=False, channel="a", second=None, user="u", amount=1):
    time = START + dt.timedelta(seconds=n if second is None else second)
    oid = f"o{n}" if is_order else None
    return ("d", user, time, n, is_order, None if is_order else channel, oid, amount, f"v{n}")


def short(found):
    return sorted(row[2:] for row in found)


def test_visits_only_make_one_segment(spark):
    assert short(computed(spark, [event(1), event(2, channel="b"), event(3)])) == [
        (0, "", 0.0, "a|2>b|1", 3, 0)
    ]


def test_order_only_has_an_empty_path(spark):
    assert short(computed(spark, [event(1, True)])) == [(0, "o1", 1.0, "", 0, 0)]


def test_order_first_then_visits(spark):
    assert short(computed(spark, [event(1, True), event(2), event(3)])) == [
        (0, "o1", 1.0, "", 0, 0),
        (1, "", 0.0, "a|2", 2, 0),
    ]


def test_two_orders(spark):
    events = [event(1), event(2, True), event(3, channel="b"), event(4), event(5, True)]
    assert short(computed(spark, events)) == [
        (0, "o2", 1.0, "a|1", 1, 1),
        (1, "o5", 1.0, "b|1>a|1", 2, 1),
    ]
    assert short(computed(spark, events, cumulative=True)) == [
        (0, "o2", 1.0, "a|1", 1, 1),
        (1, "o5", 1.0, "a|2>b|1", 3, 1),
    ]


def test_equal_times_go_by_the_tie(spark):
    events = [event(1, second=0), event(2, True, second=0), event(3, channel="b", second=0)]
    assert short(computed(spark, events)) == [
        (0, "o2", 1.0, "a|1", 1, 1),
        (1, "", 0.0, "b|1", 1, 1),
    ]


def test_running_sum_equals_one_window(spark, rows_of):
    rng = random.Random(2)
    rows = [(rng.choice("xyz"), n // 7, n, rng.choice([0, 0, 1, 5])) for n in range(300)]
    df = spark.createDataFrame(rows, "k string, slot int, pos int, v bigint")
    found = running_sum_before(df, ["k"], "slot", [F.col("pos")], "v", "before", "total")
    expected, total = defaultdict(int), Counter()
    for k, _, _, v in rows:
        total[k] += v
    want = []
    for k, _, pos, v in rows:
        want.append((k, pos, expected[k], total[k]))
        expected[k] += v
    assert rows_of(found, "k", "pos", "before", "total") == sorted(
        want, key=lambda row: tuple((True, str(v)) for v in row)
    )


def test_seconds_follow_the_clock_through_a_time_change(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        times = ["2024-03-31 01:59:59", "2024-03-31 02:30:00", "2024-03-31 03:00:00"]
        df = spark.createDataFrame([(t,) for t in times], "t string")
        second = paths.second_of(F.col("t").cast("timestamp_ntz"))
        found = [r[0] for r in df.select(second).collect()]
        assert found == sorted(found) and len(set(found)) == 3
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_hot_minute_and_missing_times_are_spread(spark):
    """Rows of the fullest slot: the window of a slot is what one task must hold."""
    cols = paths.EventColumns(**{**vars(COLS), "tie": ["o", "id"], "visits_first": True})
    second = F.timestamp_micros(F.col("id") * 1000 + F.lit(1_700_000_000_000_000)).cast("timestamp_ntz")
    rows = spark.range(60_000).select(
        F.lit("d").alias("day"), F.lit("u").alias("u"), F.when(F.col("id") % 2 == 0, second).alias("t"),
        F.col("id").cast("int").alias("id"), (F.col("id") % 1000 == 0).alias("o"), F.lit("c").alias("c"),
        F.col("id").cast("string").alias("oid"), F.lit(1).alias("m"), F.lit("v").alias("v"),
    )
    numbered = paths.number_segments(rows, cols)
    late = numbered.where("not o").agg(
        F.max(F.when(F.col("t").isNull(), F.col("seg"))), F.max("seg"), F.min("_orders")
    )
    assert tuple(late.first()) == (0, 60, 60)
    slot = paths.second_of(F.col("t"))
    fullest = rows.where("t is not null").groupBy(slot).count().agg(F.max("count")).first()[0]
    assert fullest <= 500


def hot(spark, size, order_every):
    """One user's events: half of them at one exact time, the others spread over its second."""
    time = F.timestamp_micros(F.when(F.col("id") % 2 == 0, 0).otherwise(F.col("id")) + F.lit(1_700_000_000_000_000))
    is_order = F.col("id") % order_every == order_every - 1
    return spark.range(size).select(
        F.lit("d").alias("day"), F.lit("u").alias("u"), time.cast("timestamp_ntz").alias("t"),
        F.col("id").cast("int").alias("id"), is_order.alias("o"), F.lit("c").alias("c"),
        F.col("id").cast("string").alias("oid"), F.lit(1).alias("m"), F.lit("v").alias("v"),
    )


VISITS_FIRST = paths.EventColumns(**{**vars(COLS), "tie": ["o", "id"], "visits_first": True})


def test_a_hot_second_is_spread(spark):
    """200,000 events of one user in one second: no task numbers more than a few of them."""
    rows = hot(spark, 200_000, 1001)
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        numbered = paths.number_segments(rows, VISITS_FIRST)
        held = numbered.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
        assert held[1] == 200_000 and held[0] < 20_000
        last = numbered.agg(F.max("seg"), F.min("_orders"), F.max("_orders")).first()
        assert tuple(last) == (199, 199, 199)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_visits_of_one_time_are_one_row_before_they_are_numbered(spark):
    steps, _ = paths._steps(hot(spark, 10_000, 1001), VISITS_FIRST, distinct=False)
    at = F.unix_micros(F.col("_time").cast("timestamp")) % 1_000_000
    one = steps.where((at == 0) & ~F.col("_is_order")).select("_visits").collect()
    assert [r[0] for r in one] == [4995]
    found = paths.conversion_paths(hot(spark, 10_000, 1001), VISITS_FIRST)
    assert found.agg(F.sum("all_times"), F.count("seg")).first() == (10_000 - 9, 10)


def test_alike_orders_are_as_many_segments(spark):
    events = [event(1), event(2, True), event(2, True), event(3)]
    assert short(computed(spark, events)) == [
        (0, "o2", 1.0, "a|1", 1, 1),
        (1, "o2", 1.0, "", 0, 1),
        (2, "", 0.0, "a|1", 1, 1),
    ]


def test_cumulative_paths_read_the_events_twice_at_most(spark, tmp_path):
    rows = spark.createDataFrame(random_events(3, 50, ["u"], 5), SCHEMA)
    rows.write.parquet(str(tmp_path / "events"))
    found = paths.conversion_paths(spark.read.parquet(str(tmp_path / "events")), COLS, cumulative=True)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") <= 2


def test_a_channel_is_carried_through_chunks_without_it(spark, monkeypatch):
    monkeypatch.setattr(paths, "SEGMENT_CHUNK", 2)
    events = [event(0, channel="z"), *[event(n, True) for n in range(1, 12)], event(20, channel="a")]
    assert set(computed(spark, events, cumulative=True)) == naive(events, cumulative=True)
    assert short(computed(spark, events, cumulative=True))[-1][3] == "z|1>a|1"
