import pytest

from ledgerloom.operators.aggregates import count_values, net_amounts, sum_values
from ledgerloom.operators.filters import filter_all, filter_any
from ledgerloom.spec import Condition

CODES = ["13101", "13101.0", "013101", "13101.7", " +13101 ", "1.3101e4", "0x332D", "abc", "", "5f", "-5", "10.5", None]


@pytest.fixture(scope="module")
def codes(spark):
    return spark.createDataFrame([(c,) for c in CODES], "`the code` string")


def _kept(df, *conditions):
    return [r[0] for r in filter_all(df, [Condition("the code", *c) for c in conditions]).collect()]


NUMERIC = ["13101", "13101.0", "013101", "13101.7", " +13101 "]


@pytest.mark.parametrize(
    ("comparison", "value", "expected"),
    [
        ("eq", "13101", NUMERIC),
        ("neq", "13101", ["-5", "10.5"]),
        ("eq", "-5", ["-5"]),
        ("eq", "10.50", []),
        ("eq", "abc", ["abc"]),
        ("neq", "abc", [c for c in CODES if c not in ("abc", None)]),
        ("gt", "13000", [*NUMERIC, "1.3101e4"]),
        ("lt", "6", ["5f", "-5"]),
        ("lte", "5", ["5f", "-5"]),
        ("gte", "13101.5", ["13101.7"]),
        ("like", "131", ["13101", "13101.0", "013101", "13101.7", " +13101 "]),
        ("like", "1_1", ["13101", "13101.0", "013101", "13101.7", " +13101 ", "1.3101e4"]),
        ("like", "A", []),
        ("eq", "99999999999999999999", []),
    ],
)
def test_comparisons_on_text(codes, comparison, value, expected):
    assert _kept(codes, (comparison, value)) == expected


def test_long_numbers_are_compared_exactly(spark):
    df = spark.createDataFrame([("9007199254740993",), ("9007199254740992.9",), ("99999999999999999999",)], "n string")
    rows = filter_all(df, [Condition("n", "eq", "9007199254740993")]).collect()
    assert [r.n for r in rows] == ["9007199254740993"]


def test_unknown_comparison(codes):
    with pytest.raises(ValueError, match="between"):
        _kept(codes, ("between", "1"))


def test_conditions_are_data_not_sql(codes):
    assert _kept(codes, ("eq", "' OR 1=1 --")) == []


def test_typed_predicate_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "cast(id AS double) AS amount").write.parquet(path)
    df = filter_all(spark.read.parquet(path), [Condition("amount", "gt", "90"), Condition("id", "eq", "95")])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(amount,90.0)" in plan
    assert "EqualTo(id,95)" in plan
    assert df.count() == 1


def test_union_of_conditions(spark):
    df = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "b")], "n string, t string")
    conditions = [Condition("n", "gt", "1"), Condition("t", "eq", "b"), Condition("n", "eq", "1")]
    assert sorted(r.n for r in filter_any(df, conditions, "bag").collect()) == ["1", "2", "2", "3", "3"]
    assert sorted(r.n for r in filter_any(df, conditions, "set").collect()) == ["1", "2", "3"]


def test_aggregates(spark):
    df = spark.createDataFrame(
        [("D", "10.5"), ("C", "4"), ("D", "x"), (None, "7"), ("C", None)],
        "amountCreditDebitIndicator string, amount string",
    )
    counts = count_values(df, [Condition("amount"), Condition("amountCreditDebitIndicator", unique=True)]).collect()
    assert [(r.condition_no, r["count"]) for r in counts] == [(1, 4), (2, 2)]
    assert sum_values(df, [Condition("amount")]).first()["sum"] == 21.5
    assert net_amounts(df).first().asDict() == {"total_debit_amount": 10.5, "total_credit_amount": -4.0, "net": 14.5}
    assert net_amounts(df, signed=True).first().net == 6.5
    assert net_amounts(df.limit(0)).first().net == 0.0
