"""Whole-table aggregates of analysis steps. Several conditions of a step become several result rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.columns import named
from ledgerloom.runtime import durable
from ledgerloom.spec import Condition, Step


@dataclass(frozen=True)
class Kept:
    """What a chain of filters leaves of a table: which rows, and how often each of them. None: all, and once."""

    rows: Column | None = None
    times: Column | None = None


@dataclass(frozen=True)
class Measure:
    """An aggregate whose parts add up: the sum of ``value``, or its number of distinct values."""

    value: Column
    distinct: bool = False


def _kept(value: Column, kept: Kept) -> Column:
    return value if kept.rows is None else F.when(kept.rows, value)


def _count(value: Column, kept: Kept) -> Measure:
    return Measure(_kept(F.when(value.isNotNull(), F.lit(1) if kept.times is None else kept.times), kept))


def _sum(value: Column, kept: Kept) -> Measure:
    return Measure(_kept(value if kept.times is None else value * kept.times, kept))


def _one_row(df: DataFrame, measures: Sequence[Measure]) -> DataFrame:
    """Columns ``m0, m1, ...`` in one row, from a single pass over ``df``.

    Rows are first reduced to the combinations of all values to be counted, with sums beside them. Only combinations, not
    rows, are then spread over the distinct counts; a single count needs no more than the combinations' number.
    """
    sums = {f"m{i}": m.value for i, m in enumerate(measures) if not m.distinct}
    keys = {f"m{i}": m.value for i, m in enumerate(measures) if m.distinct}
    parts = df
    if keys:
        grouped = df.groupBy(*[v.alias(n) for n, v in keys.items()])
        parts = grouped.agg(*[F.sum(v).alias(n) for n, v in sums.items()] or [F.lit(1).alias("none")])
        sums = {n: named(n) for n in sums}
    count = F.count if len(keys) == 1 else F.count_distinct
    return parts.agg(*[F.sum(v).alias(n) for n, v in sums.items()], *[count(named(n)).alias(n) for n in keys])


def _rows(wide: DataFrame, cells: Sequence[Column], name: str) -> DataFrame:
    """One row per cell, in condition order."""
    rows = [F.struct(F.lit(i + 1).alias("condition_no"), c.alias(name)) for i, c in enumerate(cells)]
    return wide.select(F.inline(F.array(*rows)))


def _double(df: DataFrame, name: str) -> Column:
    c = named(name)
    return c if isinstance(df.schema[name].dataType, T.NumericType) else c.try_cast("double")


def _count_measures(df: DataFrame, conditions: Sequence[Condition], kept: Kept) -> list[Measure]:
    return [
        Measure(_kept(named(c.column), kept), True) if c.unique else _count(named(c.column), kept) for c in conditions
    ]


def _net_measures(df: DataFrame, amount: str, indicator: str, kept: Kept) -> list[Measure]:
    value, side = _double(df, amount), named(indicator)
    return [_sum(F.when(side == s, value), kept) for s in ("D", "C")]


def _counts(wide: DataFrame, names: Sequence[str]) -> DataFrame:
    return _rows(wide, [F.coalesce(named(n), F.lit(0)).cast("bigint") for n in names], "count")


def _sums(wide: DataFrame, names: Sequence[str]) -> DataFrame:
    return _rows(wide, [named(n).cast("double") for n in names], "sum")


def _net(wide: DataFrame, names: Sequence[str], signed: bool) -> DataFrame:
    totals = wide.select(
        F.coalesce(named(names[0]).cast("double"), F.lit(0.0)).alias("total_debit_amount"),
        F.coalesce(-named(names[1]).cast("double"), F.lit(0.0)).alias("total_credit_amount"),
    )
    debit, credit = F.col("total_debit_amount"), F.col("total_credit_amount")
    return totals.withColumn("net", debit + credit if signed else debit - credit)


def count_values(df: DataFrame, conditions: Sequence[Condition], approximate: bool = False) -> DataFrame:
    """Non-null or distinct counts: columns ``condition_no, count``. All come from one pass over ``df``."""
    names = [f"m{i}" for i in range(len(conditions))]
    if not approximate:
        return _counts(_one_row(df, _count_measures(df, conditions, Kept())), names)
    measures = [
        F.approx_count_distinct(named(c.column)) if c.unique else F.count(named(c.column)) for c in conditions
    ]
    return _counts(df.agg(*[m.alias(n) for n, m in zip(names, measures)]), names)


def sum_values(df: DataFrame, conditions: Sequence[Condition]) -> DataFrame:
    """Sums of text columns read as numbers, other text ignored: columns ``condition_no, sum``."""
    wide = _one_row(df, [_sum(_double(df, c.column), Kept()) for c in conditions])
    return _sums(wide, [f"m{i}" for i in range(len(conditions))])


AMOUNT, INDICATOR = "amount", "amountCreditDebitIndicator"


def net_amounts(df: DataFrame, amount: str = AMOUNT, indicator: str = INDICATOR, signed: bool = False) -> DataFrame:
    """Debit total, negated credit total and their difference, in one row.

    The difference of the debit total and the *negated* credit total adds up both sides for positive
    amounts. ``signed`` gives debits minus credits instead.
    """
    return _net(_one_row(df, _net_measures(df, amount, indicator, Kept())), ("m0", "m1"), signed)


def aggregate_steps(df: DataFrame, steps: Sequence[tuple[Step, Kept]], signed_net: bool = False) -> dict[str, DataFrame]:
    """Results of several count, sum and net steps by their order, each over what its filters keep of ``df``.

    One pass over ``df`` fills one stored row, which all results read. Rows that no step keeps are filtered first.
    """
    measures: list[Measure] = []
    places: dict[str, list[str]] = {}
    shared = {id(k): k for _, k in steps}
    chosen = [k.rows for k in shared.values()]
    if all(c is not None for c in chosen):
        df = df.filter(reduce(or_, chosen))
    for step, kept in steps:
        # With a single filter before all steps, the rows that are left are the ones kept.
        own = Kept(None, kept.times) if len(shared) == 1 else kept
        if step.kind == "Count":
            found = _count_measures(df, step.conditions, own)
        elif step.kind == "Sum":
            found = [_sum(_double(df, c.column), own) for c in step.conditions]
        else:
            found = _net_measures(df, AMOUNT, INDICATOR, own)
        places[step.order] = [f"m{len(measures) + i}" for i in range(len(found))]
        measures += found
    wide = durable(_one_row(df, measures))
    results = {}
    for step, _ in steps:
        names = places[step.order]
        if step.kind == "Net":
            results[step.order] = _net(wide, names, signed_net)
        else:
            results[step.order] = (_counts if step.kind == "Count" else _sums)(wide, names)
    return results
