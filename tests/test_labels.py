import pytest
from pyspark.sql import functions as F

from trailmeter import constants as C
from trailmeter.functions import aggregates, keys, labels


def evaluate(spark, column, **values):
    schema = ", ".join(f"{n} {t}" for n, (t, _) in values.items())
    row = tuple(v for _, v in values.values())
    return spark.createDataFrame([row], schema).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "group, kind, campaign, expected",
    [
        ("2", "1", "5", C.PLAY_OWN),
        ("-999999", "99", "8", C.PLAY_OWN),
        ("2", "315", "5", C.PLAY_SHARED),
        ("3", "854", None, C.PLAY_SHARED),
        ("3", "157", "5", C.PLAY_SHARED),
        (None, "317", "5", C.PLAY_SHARED),
        ("3", "99", "8", C.PLAY_SHARED),
        ("3", "237", "77", C.PLAY_SHARED),
        ("3", "99", "13", C.PLAY_SHARED),
        ("3", "99", "5", C.PLAY_MEDIA),
        ("3", "99", None, C.PLAY_MEDIA),
        ("2", None, None, C.PLAY_MEDIA),
        (None, None, None, C.PLAY_MEDIA),
    ],
)
def test_play_mode(spark, group, kind, campaign, expected):
    found = evaluate(
        spark,
        labels.play_mode("g", "k", "c"),
        g=("string", group),
        k=("string", kind),
        c=("string", campaign),
    )
    assert found == expected


@pytest.mark.parametrize(
    "times, expected",
    [
        (None, "0次"),
        (0, "0次"),
        (1, "1次"),
        (6, "6次"),
        (7, "[7-10]次"),
        (10, "[7-10]次"),
        (11, ">10次"),
        (100, ">10次"),
    ],
)
def test_frequency_label(spark, times, expected):
    assert evaluate(spark, labels.frequency_label(F.col("n")), n=("bigint", times)) == expected


@pytest.mark.parametrize(
    "number, count_label, kept",
    [
        (0, "", ""),
        (1, "1", "a+b"),
        (2, "2", "a+b"),
        (3, "3", "a+b"),
        (4, ">=4", "a+b"),
        (5, ">=4", "其他"),
        (None, "", "其他"),
    ],
)
def test_channel_counts(spark, number, count_label, kept):
    n = ("int", number)
    assert evaluate(spark, labels.channel_count_label(F.col("n")), n=n) == count_label
    assert evaluate(spark, labels.channel_label(F.col("n"), F.lit("a+b")), n=n) == kept


@pytest.mark.parametrize("position, channel", list(enumerate(C.CHANNELS, start=1)))
def test_known_channels_get_their_rank(spark, position, channel):
    ranked = labels.ranked_channel(F.col("c"))
    assert evaluate(spark, ranked, c=("string", channel)) == f"{position}-{channel}"


@pytest.mark.parametrize("channel", ["elsewhere", "", None])
def test_unknown_channels_get_none(spark, channel):
    assert evaluate(spark, labels.ranked_channel(F.col("c")), c=("string", channel)) is None


def test_channel_set(spark):
    rows = [("u", C.CHANNELS[8]), ("u", C.CHANNELS[0]), ("u", C.CHANNELS[8]), ("u", "x"), ("v", None)]
    df = spark.createDataFrame(rows, "u string, c string")
    found = df.groupBy("u").agg(aggregates.channel_set(labels.ranked_channel(F.col("c"))).alias("l"))
    found = found.select("u", "l", aggregates.channel_number(F.col("l")).alias("n")).collect()
    assert {tuple(r) for r in found} == {("u", f"{C.CHANNELS[0]}+{C.CHANNELS[8]}", 2), ("v", "", 0)}


@pytest.mark.parametrize(
    "account, status, value, expected",
    [
        (None, "1", "life", C.NO_ACCOUNT),
        ("a", "0", "life", C.NO_ACCOUNT),
        ("", "0", "life", C.NO_ACCOUNT),
        ("a", "1", None, C.UNKNOWN_LIFECYCLE),
        ("a", None, "-1", C.UNKNOWN_LIFECYCLE),
        ("a", None, "life", "life"),
        ("", None, None, None),
        ("", "1", "-1", "-1"),
    ],
)
def test_lifecycle(spark, account, status, value, expected):
    found = evaluate(
        spark,
        labels.lifecycle_label(F.col("a"), F.col("s"), F.col("v")),
        a=("string", account),
        s=("string", status),
        v=("string", value),
    )
    assert found == expected


@pytest.mark.parametrize(
    "account, device, literal, missing",
    [
        ("a", "d", "a", "a"),
        ("a", None, "a", "a"),
        (None, "d", "d", "d"),
        (None, None, None, None),
        ("", "d", "", "d"),
        ("", None, "", None),
    ],
)
def test_identity(spark, account, device, literal, missing):
    values = {"a": ("string", account), "d": ("string", device)}
    a, d = F.col("a"), F.col("d")
    assert evaluate(spark, keys.identity(a, d), **values) == missing
    as_it_is = keys.identity(a, d, empty_account_is_missing=False)
    assert evaluate(spark, as_it_is, **values) == literal


@pytest.mark.parametrize(
    "text, expected", [("t_{CLICK_ID}_x", True), ("t_123", False), ("t_CLICK_ID", False), (None, None)]
)
def test_click_macro(spark, text, expected):
    assert evaluate(spark, labels.has_click_macro(F.col("t")), t=("string", text)) is expected


@pytest.mark.parametrize(
    "time, expected",
    [
        ("2024-01-01 10:00:00.5", "2024-01-01 10:00:00"),
        ("2024-01-01 10:00:00", "2024-01-01 10:00:00"),
        ("", ""),
        (None, None),
    ],
)
def test_whole_seconds(spark, time, expected):
    assert evaluate(spark, keys.whole_seconds(F.col("t")), t=("string", time)) == expected


def test_normal_account(spark):
    assert evaluate(spark, keys.normal_account(F.col("a")), a=("string", "  AbC ")) == "abc"


def test_level_bits():
    bits = {level: labels.level_bits(kept) for level, kept in C.ROLLUP_LEVELS.items()}
    assert bits == {
        "0": "00111111",
        "1": "00011111",
        "2": "00101111",
        "3": "00001111",
        "4": "00110111",
        "5": "00110011",
        "7": "00000000",
    }


def test_shard_key_stays_in_range_and_repeats(spark):
    key = keys.shard_key(F.col("id"), F.lit(None))
    first = [r[0] for r in spark.range(5000).select(key).collect()]
    again = [r[0] for r in spark.range(5000).repartition(3).orderBy("id").select(key).collect()]
    assert first == again
    assert 1 <= min(first) and max(first) <= C.SHARDS and len(set(first)) > 4000


def test_sum_where_is_zero_without_a_match(spark):
    df = spark.createDataFrame([(1, None), (2, 5.5)], "k int, v double")
    total = aggregates.sum_where(F.col("k") == 1, F.col("v"))
    assert df.agg(total.alias("x")).first()["x"] == 0
