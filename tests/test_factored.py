"""The detail without its pairs, and its rollup next to that of the pairs."""

import random

import pytest
from pyspark.sql import functions as F

from trailmeter import constants as C
from trailmeter import schemas as S
from trailmeter.plans import factored, rollup
from trailmeter.plans import user_detail as U
from tests.test_user_detail import BEFORE, DAY, FACTS, order, visit

pytestmark = pytest.mark.usefixtures("fixed_plans")


@pytest.fixture
def sources(make):
    def build(visits, orders=(), life=(), devices=()):
        tags = U.UserTags(
            make(list(life), S.LIFECYCLE_TAGS),
            make([], S.STATUS_TAGS),
            make([], S.ACCOUNT_TAGS),
            make(list(devices), S.DEVICE_TAGS),
        )
        facts = make(list(orders), FACTS)
        amount = F.col("after_prefr_amount_1").cast(C.MONEY_SUM)
        return make(list(visits), S.VISITS), facts.withColumn("after_prefr_amount_1", amount), tags

    return build


def crowd(seed):
    """Users with and without accounts, some of whom share devices, with orders of their own."""
    rng = random.Random(seed)
    accounts, devices = ["", "", "", None, "a", "b", "c"], ["d1", "d2", "d3", "d4", "", None]
    visits = [
        visit(
            rng.choice(accounts),
            rng.choice(devices),
            channel=rng.choice(C.CHANNELS[:3]),
            pv=f"v{rng.randrange(9)}",
            clock=f"10:{n // 60:02}:{n % 60:02}",
        )
        for n in range(60)
    ]
    orders = [
        order(rng.choice(accounts), parent=f"p{n}", clock=f"10:00:{7 * n:02}", amount=float(n))
        for n in range(6)
    ]
    life = [
        {"dt": BEFORE, "unif_user_log_acct": a, "user_log_acct": a, "user_life_cycle_type": f"life-{a}"}
        for a in "abc"
    ]
    cycles = [
        {"dt": BEFORE, "browse_uniq_id": d, "user_visitcycle_app": f"v-{d}", "user_buycycle_all": f"b-{d}"}
        for d in ("d1", "d3")
    ]
    return visits, orders, life, cycles


@pytest.mark.parametrize("seed", [1, 2])
def test_rollup_equals_that_of_the_pairs(spark, sources, rows_of, seed):
    given = sources(*crowd(seed))
    pairs = U.user_detail(*given, DAY, empty_account_is_missing=False)
    sides = factored.factored_detail(*given, DAY)
    names = [c for c in pairs.columns if c != "user_id"]
    assert rows_of(factored.expanded(sides), *names) == rows_of(pairs, *names)
    want = rollup.rollup(pairs, DAY, empty_account_is_missing=False)
    assert rows_of(factored.rollup_factored(sides, DAY)) == rows_of(want)


def test_rows_grow_in_proportion(sources):
    def sizes(users):
        visits = [visit("", f"d{n}", pv=f"v{n}") for n in range(users)]
        orders = [order("", parent=f"p{n}", clock=f"11:00:{n:02}") for n in range(users)]
        sides = factored.factored_detail(*sources(visits, orders), DAY)
        return sides.members.count(), sides.paths.count(), factored.expanded(sides).count()

    (people, paths, pairs), (more_people, more_paths, more_pairs) = sizes(10), sizes(20)
    # The orders have an identity of their own; visits before all orders end with the first.
    assert (people, paths) == (11, 10) and (more_people, more_paths) == (21, 20)
    assert (pairs, more_pairs) == (110, 420)


def test_sides_are_stored_by_day(spark, sources, rows_of, tmp_path):
    sides = factored.factored_detail(*sources(*crowd(3)), DAY)
    for _ in range(2):
        factored.write_factored(sides, str(tmp_path))
    back = factored.read_factored(spark, str(tmp_path))
    assert rows_of(back.members) == rows_of(sides.members)
    assert rows_of(back.paths) == rows_of(sides.paths)


def test_unknown_version(sources):
    with pytest.raises(ValueError, match="unknown version"):
        factored.factored_detail(*sources([]), DAY, version="daily")
