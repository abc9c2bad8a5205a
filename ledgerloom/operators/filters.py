"""Filters made of several conditions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.comparisons import predicate
from ledgerloom.operators.aggregates import Kept
from ledgerloom.spec import Condition


def filter_all(df: DataFrame, conditions: Sequence[Condition]) -> DataFrame:
    """Rows that meet every condition."""
    return reduce(lambda kept, c: kept.filter(predicate(df, c)), conditions, df)


def filter_any(df: DataFrame, conditions: Sequence[Condition], mode: str = "set") -> DataFrame:
    """Rows that meet at least one condition.

    ``set`` returns each row once, ``bag`` once per condition it meets. Both read the input once.
    """
    matches = [predicate(df, c) for c in conditions]
    kept = df.filter(reduce(or_, matches))
    if mode == "set":
        return kept
    if mode != "bag":
        raise ValueError(f"unknown mode {mode!r}")
    hits = F.array_compact(F.array(*[F.when(m, F.lit(i)) for i, m in enumerate(matches)]))
    return kept.withColumn("_hit", F.explode(hits)).drop("_hit")


def kept_by(df: DataFrame, conditions: Sequence[Condition], relation: str = "and", before: Kept = Kept()) -> Kept:
    """What a filter step leaves of what ``before`` leaves, as columns over ``df``: ``or`` keeps a row once per condition."""
    matches = [predicate(df, c) for c in conditions]
    if not matches:
        return before
    rows, times = reduce(or_ if relation == "or" else and_, matches), before.times
    if relation == "or" and len(matches) > 1:
        hits = reduce(add, [F.when(m, F.lit(1)).otherwise(F.lit(0)) for m in matches])
        times = hits if times is None else times * hits
    return Kept(rows if before.rows is None else before.rows & rows, times)
