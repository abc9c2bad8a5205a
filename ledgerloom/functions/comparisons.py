"""Comparison predicates of analysis steps over text or typed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.columns import named
from ledgerloom.spec import Condition

_INT_MAX = 2**31 - 1
_LONG_MAX = 2**63 - 1

_ORDERINGS = {
    "lt": lambda left, right: left < right,
    "gt": lambda left, right: left > right,
    "lte": lambda left, right: left <= right,
    "gte": lambda left, right: left >= right,
}


def _whole_number(c: Column, value: int) -> Column:
    """Text cell as the whole number it denotes, fraction cut off, in the width that holds ``value``.

    The form is checked before casting: casts that fail are many times slower than the check.
    """
    if value > _LONG_MAX:
        return c.try_cast("double")
    form = r"^\s*([+-]?\d+)(\.\d*)?\s*$"
    if value <= _INT_MAX:
        return F.when(c.rlike(form), c.try_cast("double").try_cast("int"))
    return F.when(c.rlike(form), F.regexp_extract(c, form, 1).try_cast("bigint"))


def _equality(c: Column, numeric: bool, text: str) -> Column:
    if text.isascii() and text.isdigit():
        value = int(text)
        literal = F.lit(float(value)) if value > _LONG_MAX else F.lit(value)
        return (c if numeric else _whole_number(c, value)) == literal
    if numeric:
        return c == F.lit(text).try_cast("double")
    return c == F.lit(text)


def predicate(df: DataFrame, condition: Condition) -> Column:
    """Row predicate of one condition.

    Typed numeric columns are compared directly, so the predicate reaches the file scan. Text columns are
    cast row by row; cells that do not convert never match. Digit-only input compares as a number, any
    other input of ``eq`` / ``neq`` compares as text.
    """
    numeric = isinstance(df.schema[condition.column].dataType, T.NumericType)
    c = named(condition.column)
    kind = condition.comparison
    if kind in _ORDERINGS:
        left = c if numeric else c.try_cast("double")
        return _ORDERINGS[kind](left, F.lit(float(condition.input)))
    if kind == "eq":
        return _equality(c, numeric, condition.input)
    if kind == "neq":
        return ~_equality(c, numeric, condition.input)
    if kind == "like":
        return c.cast("string").like(f"%{condition.input}%")
    raise ValueError(f"unknown comparison {kind!r}")
