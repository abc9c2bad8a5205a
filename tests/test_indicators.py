import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.indicators import indicator_by_columns, indicator_by_range, indicator_by_sign
from ledgerloom.spec import AccountRange


def _by_hand(account, amount, ranges):
    found = None
    for r in ranges:
        if account is not None and r.start <= account <= r.end and r.negatives in ("Debit", "Credit"):
            negative = amount is not None and amount < 0
            found = "D" if negative == (r.negatives == "Debit") else "C"
    return found


@pytest.mark.parametrize("count", [0, 1, 7, 400])
def test_last_covering_range_wins(spark, count):
    rng = random.Random(count)
    ranges = []
    for _ in range(count):
        low = rng.randint(0, 500)
        ranges.append(AccountRange(low, low + rng.choice([0, 1, 5, 60]), rng.choice(["Debit", "Credit", "None"])))
    rows = [(float(rng.randint(-5, 600)) + rng.choice([0, 0.5]), float(rng.randint(-2, 2))) for _ in range(600)]
    rows += [(None, 1.0), (3.0, None)]
    df = spark.createDataFrame(rows, "account double, amount double")
    got = df.select(indicator_by_range(F.col("account"), F.col("amount"), ranges).alias("v")).collect()
    assert [r.v for r in got] == [_by_hand(a, m, ranges) for a, m in rows]


def test_by_sign_and_by_columns(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (1.0, 1.0), (None, 1.0), (1.0, None), (None, None)], "d double, c double")
    rows = df.select(
        indicator_by_columns(F.col("d"), F.col("c")).alias("pair"), indicator_by_sign(F.col("d")).alias("sign")
    ).collect()
    assert [r.pair for r in rows] == ["C", "D", "C", "C", "D", None]
    assert [r.sign for r in rows] == ["D", "D", "D", "C", "D", "C"]
