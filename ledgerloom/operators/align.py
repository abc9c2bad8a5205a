"""Columns of different files put side by side by row position."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame

from ledgerloom.operators.ordinals import dense_ordinal


def align_by_position(frames: Sequence[tuple[DataFrame, str]], position: str = "_position") -> DataFrame:
    """Joins ``(frame, order column)`` pairs on their dense row numbers, starting at zero.

    Shorter frames are padded with nulls. Order columns are dropped, ``position`` stays.
    """
    numbered = [
        dense_ordinal(df, ord_col, "_place").drop(ord_col).withColumnRenamed("_place", position)
        for df, ord_col in frames
    ]
    return reduce(lambda left, right: left.join(right, position, "full_outer"), numbered)
