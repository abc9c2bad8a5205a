"""Range rules held in a table, against a plain search."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.ranges import lookup_range, stretches


def by_hand(account, ranges):
    found = [(p, v) for p, lo, hi, v in ranges if None not in (account, lo, hi) and account == account and lo <= account <= hi]
    return max(found)[1] if found else None


def check(spark, ranges, accounts):
    table = spark.createDataFrame(ranges, "position int, low double, high double, rule string")
    rows = spark.createDataFrame([(i, a) for i, a in enumerate(accounts)], "id int, account double").withColumn("value", F.lit("mine"))
    out = lookup_range(rows, "account", stretches(table, "low", "high", "position", "rule"), "value")
    assert out.columns == ["id", "account", "value"]
    found = {r.id: r.value for r in out.collect()}
    assert len(found) == out.count() == len(accounts)
    assert found == {i: by_hand(a, ranges) for i, a in enumerate(accounts)}


@pytest.mark.parametrize("count, spread", [(1, 10), (9, 30), (300, 500), (300, 40)])
def test_last_covering_range_wins(spark, count, spread):
    r = random.Random(count + spread)
    ranges = []
    for p in range(count):
        low = r.randint(0, spread) + r.choice([0.0, 0.0, 0.25])
        ranges.append((p, low, low + r.choice([0, 1, 2.5, 17, spread]), r.choice(["Debit", "Credit"])))
    accounts = [r.randint(-5, 2 * spread + 5) + r.choice([0.0, 0.25, 0.5]) for _ in range(300)]
    check(spark, ranges, [*accounts, None, float("nan"), float("inf"), -0.0])


def test_bounds_far_apart_and_crowded(spark):
    """Most stretches lie in one bin, which is split again."""
    ranges = [(p, 1000.0 + p / 8, 1000.0 + p / 8 + 0.1, f"r{p % 7}") for p in range(400)] + [(900, -1e12, -9e11, "low"), (901, 5e15, 5e15, "high")]
    check(spark, ranges, [1000 + k / 32 for k in range(0, 1700, 3)] + [-1e12, -9.5e11, 5e15, 0.0, 4e15])


def test_ranges_that_cover_nothing(spark):
    check(spark, [(1, 5.0, 4.0, "a"), (2, None, 9.0, "b"), (3, 7.0, None, "c")], [4.5, 7.0, None])
    check(spark, [(1, 5.0, 5.0, "a")], [5.0, 4.0, 6.0])
    assert stretches(spark.createDataFrame([], "p int, a double, b double, v string"), "a", "b", "p", "v").count() == 0
