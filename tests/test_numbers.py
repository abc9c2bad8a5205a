import random
from decimal import Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import is_number, money_sum, money_total, parse_number, round_binary, uncounted_amounts
from ledgerloom.operators.quality import percent

CELLS = [
    ("£14,907.90", 14907.9, True),
    ("-£91.00", -91.0, True),
    ("(5)", -5.0, True),
    ("(-5)", 5.0, True),
    ("Light (445)", -445.0, True),
    ("1.234,56", 1.23456, True),
    ("13.5", 13.5, True),
    ("007", 7.0, True),
    ("5.", 5.0, True),
    ("-.5", -0.5, True),
    ("2020-01-02", None, False),
    ("", None, False),
    ("abc", None, False),
    ("5f", None, False),
    ("0x332D", None, False),
    ("Infinity", None, False),
    ("1-2", None, False),
    ("--5", None, False),
    ("1.2.3", None, False),
    ("n/a", None, False),
    (None, None, True),
]


def test_parse_number(spark):
    df = spark.createDataFrame([(c,) for c, _, _ in CELLS], "c string")
    rows = df.select("c", parse_number(F.col("c")).alias("v"), is_number(F.col("c")).alias("ok")).collect()
    assert [(r.c, r.v, r.ok) for r in rows] == CELLS


def test_round_binary_agrees_with_python(spark):
    rng = random.Random(7)
    values = [rng.uniform(-1, 1) * 10 ** rng.randint(-6, 14) for _ in range(3000)]
    values += [rng.randint(-(10**12), 10**12) / 100000 for _ in range(3000)]
    values += [rng.randint(-(10**13), 10**13) / 20000 for _ in range(3000)]
    values += [0.0, -0.5, 0.00005, 0.00015, 2.5, 1e300, 538134771718.75854]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    rows = df.select("v", round_binary(F.col("v")).alias("r")).collect()
    assert [r.r for r in rows] == [round(r.v, 4) for r in rows]


@pytest.mark.parametrize(
    ("count", "total", "expected"), [(1, 8, 12), (3, 8, 38), (4, 21, 19), (0, 0, 0), (1, 40, 2), (5, 5, 100)]
)
def test_percent_rounds_half_even(spark, count, total, expected):
    row = spark.range(1).select(F.expr(percent(str(count), str(total))).cast("int").alias("p")).first()
    assert row.p == expected == (round(100 * count / total) if total else 0)


def test_money_sum_is_exact(spark):
    amounts = [0.1] * 1000 + [-0.3] * 500 + [1e15, -1e15, 2.5e-6, None, float("nan"), 123456789.654321]
    df = spark.createDataFrame([(a,) for a in amounts], "a double").repartition(13)
    assert str(df.agg(money_sum(F.col("a"))).first()[0]) == "123456739.65432350"
    assert df.limit(0).agg(money_sum(F.col("a"))).first()[0] == 0


def test_money_sum_keeps_small_amounts_and_skips_odd_cells(spark):
    rows = [(4e-7,)] * 1000 + [(None,), (float("nan"),), (float("inf"),), (1e300,)]  # the last two are counted apart
    df = spark.createDataFrame(rows, "a double")
    assert float(df.agg(money_sum(F.col("a")).alias("s")).first()["s"]) == 0.0004


def test_money_sum_of_huge_amounts(spark):
    amounts = [9e27] * 7 + [-9e27] * 7 + [1e30, 1e33, -1e30, -1e33, 123456789012345.5, 1e-7, -0.3, 1e37, -1e37]
    df = spark.createDataFrame([(a,) for a in amounts], "a double").repartition(5)
    assert str(df.agg(money_sum(F.col("a"))).first()[0]) == "123456789012345.20000010"
    odd = spark.createDataFrame([(x,) for x in (1e38, -1e300, float("inf"), float("nan"), None, 5e37, 5e37, 1.5)], "a double")
    row = odd.agg(money_sum(F.col("a")).alias("s"), money_total(F.col("a")).alias("t"), uncounted_amounts(F.col("a")).alias("n")).first()
    assert (row.s, row.t, row.n) == (None, 1e38, 3)


def test_money_sum_keeps_digits_of_decimals_and_text(spark):
    df = spark.sql("SELECT cast('1234567890123456789012.0123456789' AS decimal(38,10)) AS d, '0.1' AS t UNION ALL SELECT 0.0000000001, 'none'")
    row = df.agg(money_sum(F.col("d")).alias("d"), money_sum(F.col("t")).alias("t"), uncounted_amounts(F.col("t")).alias("n")).first()
    assert (str(row.d), str(row.t), row.n) == ("1234567890123456789012.01234568", "0.10000000", 1)


def test_doubles_of_any_size_are_cast_once(spark):
    huge = [1e14, -99999999999999.98, 1e22, -9.999999999999999e21, 1e28, 1e30, -9.999999999999999e29, 3e-10, -7.5e29, 4.5e29, 3e29]
    df = spark.createDataFrame([(a,) for a in huge], "a double").repartition(4)
    with localcontext(prec=60):
        exact = sum(Decimal(repr(a)) for a in huge).quantize(Decimal("1e-8"))
    a = F.col("a")
    row = df.agg(money_sum(a).alias("s"), money_total(a).alias("t"), uncounted_amounts(a).alias("n")).first()
    assert (row.s, row.t, row.n) == (exact, pytest.approx(float(exact), rel=1e-15), 0)
    tie = spark.createDataFrame([(-619526782413903.0,), (-1.5e-08,), (1e-08,), (1e29,), (-1e29,)], "a double")
    assert str(tie.agg(money_sum(a)).first()[0]) == "-619526782413903.00000001"
    # No cell is divided, and none takes a cast that may fail.
    plan = df.groupBy("a").agg(money_sum(a).alias("s"), money_total(a).alias("t"), uncounted_amounts(a).alias("n"))
    partial = plan._jdf.queryExecution().optimizedPlan().toString()
    assert " div " not in partial and "decimal(38,10))" not in partial
