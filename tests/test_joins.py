import random

from pyspark.sql import functions as F

from trailmeter.operators import joins


def frames(spark):
    random.seed(3)
    accounts = [None, "", *[f"u{n}" for n in range(20)]]
    left = [(n, random.choice(accounts), random.choice("ab")) for n in range(400)]
    right = [(a, d, f"{a}{d}") for a in accounts[1:12] for d in "ab"] + [(None, "a", "none")]
    return (
        spark.createDataFrame(left, "id int, account string, dt string"),
        spark.createDataFrame(right, "account string, dt string, tag string"),
    )


def test_equals_a_plain_join_on_a_nullified_key(spark, rows_of):
    left, right = frames(spark)
    found = joins.left_join_missing_aside(left, right, "account", also=["dt"])
    # The joined key stands for the right one; the left column is gone, so look at the others.
    plain = left.withColumn("k", F.nullif("account", F.lit(""))).join(
        right.withColumnRenamed("account", "k"), ["dt", "k"], "left"
    )
    assert rows_of(found, "id", "dt", "tag") == rows_of(plain, "id", "dt", "tag")
    assert found.count() == left.count()


def test_empty_can_be_a_key(spark, rows_of):
    left, right = frames(spark)
    found = joins.left_join_missing_aside(left, right, "account", ["dt"], empty_is_missing=False)
    plain = left.join(right, ["dt", "account"], "left")
    assert rows_of(found, "id", "tag") == rows_of(plain, "id", "tag")


def test_missing_keys_spread_over_tasks(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        # A condition, as the optimizer drops the whole join for a literal NULL.
        left = spark.range(4000).select("id", F.when(F.col("id") < 0, "x").alias("k"))
        right = spark.createDataFrame([("x", 1)], "k string, v int")
        joined = joins.left_join_missing_aside(left, right, "k")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 4 and max(sizes) < 1500
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_grouped_right_side_is_not_shuffled_again(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left, right = frames(spark)
        grouped = joins.unique_per_key(
            right, {"dt": F.col("dt"), "account": F.col("account")}, tag=F.max("tag")
        )
        joined = joins.left_join_missing_aside(left, grouped, "account", also=["dt"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        # One for the group, one for the left side.
        assert plan.count("Exchange hashpartitioning") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_merge_by_key_equals_separate_joins(spark, rows_of):
    ids = spark.createDataFrame([(k,) for k in "abcd"], "k string")
    one = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", None)], "k string, x string")
    two = spark.createDataFrame([("b", "5"), ("c", "7"), ("c", "6"), (None, "0")], "k string, y string")
    merged = joins.merge_by_key([one, two], ["k"], x=F.max("x"), y=F.min("y"))
    together = ids.join(merged, "k", "left").select("k", "x", "y")
    apart = (
        ids.join(one.groupBy("k").agg(F.max("x").alias("x")), "k", "left")
        .join(two.groupBy("k").agg(F.min("y").alias("y")), "k", "left")
        .select("k", "x", "y")
    )
    assert rows_of(together) == rows_of(apart)


def test_flag_members_never_fans_out(spark, rows_of):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id int, k string")
    members = spark.createDataFrame([("a",), ("a",), (None,)], "k string")
    flagged = joins.flag_members(left, members, ["k"], "hit")
    assert rows_of(flagged, "id", "hit") == [(1, True), (2, False), (3, False)]


def test_no_key_value_is_set_apart(spark, rows_of):
    keys = ["\0a", "\0", "a"]
    left = spark.createDataFrame([(k,) for k in [*keys, None]], "k string")
    right = spark.createDataFrame([(k, n) for n, k in enumerate(keys)], "k string, v int")
    found = joins.left_join_missing_aside(left, right, "k")
    assert rows_of(found, "k", "v") == rows_of(left.join(right, "k", "left"), "k", "v")
