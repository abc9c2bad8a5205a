import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.formula import compile_formula, operands

ROWS = [(3.0, 2.0), (-7.0, 3.0), (None, 4.0), (5.0, 0.0), (-2.0, 0.5), (0.1, 0.2)]


def _by_hand(expression, a, b):
    try:
        value = eval(expression.replace("^", "**"), {}, {"a": a or 0.0, "b": b or 0.0})  # noqa: S307
        return round(value, 4)
    except (ZeroDivisionError, TypeError):
        return None


@pytest.mark.parametrize(
    "expression", ["a+b", "a-b*2", "a/b", "(a+b)^2", "-a^2", "a%b", "a//b", "a^b", "+a-(-b)", "2.5*a/3"]
)
def test_formula_agrees_with_python(spark, expression):
    df = spark.createDataFrame(ROWS, "a double, b double")
    text = expression.replace("a", "<1>").replace("b", "<2>")
    result = compile_formula(text, {1: F.col("a"), 2: F.col("b")})
    got = [r.v for r in df.select(result.alias("v")).collect()]
    assert got == [_by_hand(expression, a, b) for a, b in ROWS]


def test_negative_operand_is_squared_as_a_value(spark):
    df = spark.createDataFrame([(-2.0,)], "a double")
    assert df.select(compile_formula("<1> ^ 2", {1: F.col("a")}).alias("v")).first().v == 4.0


@pytest.mark.parametrize("text", ["__import__('os')", "<1>.real", "f(<1>)", "[1]", "'a'", "x", "<1> if 1 else 2", "True"])
def test_only_arithmetic_is_accepted(spark, text):
    with pytest.raises((ValueError, SyntaxError)):
        compile_formula(text, {1: F.col("a")})


def test_empty_expression(spark):
    with pytest.raises(ValueError, match="No Expression"):
        compile_formula("  ", {})


def test_operands():
    assert operands("<2> + <10> * <2>") == (2, 10)
