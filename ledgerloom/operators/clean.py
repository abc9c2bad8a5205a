"""Cleaning and projection of raw report rows. ``keep`` names bookkeeping columns left untouched."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.columns import named
from ledgerloom.spec import Exclusion, ExclusionRule

# Cells with exactly this text are read as null.
NULL_TOKENS = (
    "", " ", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "BLANK", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def data_columns(df: DataFrame, keep: Sequence[str] = ()) -> list[str]:
    return [c for c in df.columns if c not in keep]


def null_tokens_to_null(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)} - set(keep)
    return df.select(
        *[
            F.when(~named(c).isin(*NULL_TOKENS), named(c)).alias(c) if c in texts else named(c)
            for c in df.columns
        ]
    )


def drop_all_null(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drops rows in which every data column is null."""
    return df.filter(reduce(or_, [named(c).isNotNull() for c in data_columns(df, keep)]))


def repaired_header(cells: Sequence[str | None]) -> list[str]:
    """Column names from header cells: ``NO_NAME<k>`` for blank ones, ``.1``, ``.2`` … for repeats."""
    names: list[str] = []
    for position, cell in enumerate(cells):
        base = cell if cell else f"NO_NAME{position}"
        name, repeat = base, 0
        while name in names:
            repeat += 1
            name = f"{base}.{repeat}"
        names.append(name)
    return names


def _rule_matches(name: str, rule: ExclusionRule) -> Column:
    c = named(name)
    if rule.contains == "NULL":
        return c.isNull()
    if rule.contains == "NOT_NULL":
        return c.isNotNull()
    # A null cell takes part in the text search as "nan".
    text = F.coalesce(c.cast("string"), F.lit("nan"))
    return F.lower(text).contains(rule.contains.lower())


def excluded(df: DataFrame, exclusion: Exclusion, keep: Sequence[str] = ()) -> Column:
    """True for rows the exclusion rules match; rules address columns by 1-based position."""
    names = data_columns(df, keep)
    matches = [_rule_matches(names[rule.column - 1], rule) for rule in exclusion.rules]
    if len(matches) == 1 or exclusion.aggr == "or":
        return reduce(or_, matches)
    if exclusion.aggr == "and":
        return reduce(and_, matches)
    return F.lit(False)


def exclude_rows(df: DataFrame, exclusion: Exclusion, keep: Sequence[str] = ()) -> DataFrame:
    return df.filter(~excluded(df, exclusion, keep))


def drop_trailing_total(df: DataFrame, ord_col: str, keep: Sequence[str] = ()) -> DataFrame:
    """Drops the last row when its first or second cell mentions a total."""
    heads = data_columns(df, {ord_col, *keep})[:2]
    is_total = reduce(
        or_, [F.lower(F.coalesce(named(c).cast("string"), F.lit(""))).contains("total") for c in heads]
    )
    last = df.agg(F.max(named(ord_col))).scalar()
    return df.filter(~((named(ord_col) == last) & is_total))


def prune(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Keeps the given columns, then drops rows without any value in them."""
    return drop_all_null(df.select(*[named(c) for c in [*keep, *columns]]), keep)


def project(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[named(c) for c in columns])
