"""Type checks of report columns, the bad-row report and the report gate."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import dates, numbers
from ledgerloom.functions.columns import named
from ledgerloom.operators.ordinals import dense_ordinal
from ledgerloom.runtime import lookup_side
from ledgerloom.spec import DATE_TYPES, NUMERIC_TYPES, TypedField

FLAG = "_type_valid"
# Fixed value: text of a type error.
INVALID_TYPE = "Invalid Data Type"
# Declared types of the columns that must be empty: cells beyond the header, and lines with a cell that never closes.
SURPLUS_TYPE, UNCLOSED_TYPE = "surplus", "unclosed"

ERROR_SCHEMA = T.StructType(
    [
        T.StructField("report_name", T.StringType()),
        T.StructField("cdm_field", T.StringType()),
        T.StructField("file_name", T.StringType()),
        T.StructField("field_name", T.StringType()),
        T.StructField("data_row", T.LongType()),
        T.StructField("error", T.StringType()),
    ]
)


def checked(c: Column, data_type: str) -> tuple[Column, Column]:
    """``(value, valid)`` of a text column under a declared type."""
    if data_type in NUMERIC_TYPES:
        return numbers.parse_number(c), numbers.is_number(c)
    if data_type == "string":
        return F.when(c.isNull() | (c == "nan"), F.lit("")).otherwise(c), F.lit(True)
    if data_type in DATE_TYPES:
        return F.coalesce(c, F.lit("")), dates.is_date(c)
    if data_type in (SURPLUS_TYPE, UNCLOSED_TYPE):
        return c, c.isNull()
    if data_type == "boolean":
        lowered = F.lower(c)
        known = F.coalesce(lowered.isin("true", "false"), F.lit(False))
        return F.when(known, lowered == "true"), known
    return c, F.lit(False)


def validate(
    df: DataFrame,
    fields: Sequence[TypedField],
    keep: Sequence[str] = (),
) -> DataFrame:
    """Typed value and ``<field>_type_valid`` flag per field; invalid rows stay in."""
    columns = [named(c) for c in keep]
    for f in fields:
        value, valid = checked(named(f.name), f.data_type)
        columns += [value.alias(f.name), valid.alias(f.name + FLAG)]
    return df.select(*columns)


def bad_fields(fields: Sequence[TypedField]) -> Column:
    """``fieldA (type)|fieldB (type)`` for the invalid cells of a row, empty when there are none."""
    marks = [F.when(~named(f.name + FLAG), F.lit(f"{f.name} ({f.data_type})")) for f in fields]
    return F.concat_ws("|", *marks)


def bad_rows(df: DataFrame, fields: Sequence[TypedField], keep: Sequence[str] = ()) -> DataFrame:
    """Rows with an invalid cell: the ``keep`` columns and ``field_name`` naming the cells.

    Exploding the mark computes each check once; a filter on it would be pushed down and repeat them.
    """
    mark = bad_fields(fields)
    return df.select(*[named(c) for c in keep], F.explode(F.when(mark != "", F.array(mark))).alias("field_name"))


def all_valid(fields: Sequence[TypedField]) -> Column:
    return reduce(and_, [named(f.name + FLAG) for f in fields])


def valid_rows(df: DataFrame, fields: Sequence[TypedField], keep: Sequence[str] = ()) -> DataFrame:
    """Rows without an invalid cell, flags removed."""
    return df.filter(all_valid(fields)).select(*[named(c) for c in [*keep, *[f.name for f in fields]]])


def type_errors(
    df: DataFrame,
    fields: Sequence[TypedField],
    report_name: str,
    file_name: str,
    ord_col: str,
) -> DataFrame:
    """One error row per bad row; ``data_row`` is its 1-based place among the rows of ``df``.

    Only the order key and the field marks go through the numbering shuffle, and of those only the order
    ranges that hold a bad row.
    """
    marked = df.select(named(ord_col), bad_fields(fields).alias("field_name"))
    numbered = dense_ordinal(marked, ord_col, "data_row", start=1, wanted=F.col("field_name") != "")
    return _as_errors(numbered, report_name, file_name)


def numbered_errors(
    df: DataFrame, fields: Sequence[TypedField], report_name: str, file_name: str, row_col: str
) -> DataFrame:
    """One error row per bad row of rows that already have their number."""
    bad = df.filter(~all_valid(fields)).select(named(row_col).alias("data_row"), bad_fields(fields).alias("field_name"))
    return _as_errors(bad, report_name, file_name)


def _as_errors(numbered: DataFrame, report_name: str, file_name: str) -> DataFrame:
    return numbered.select(
        F.lit(report_name).alias("report_name"),
        F.lit(None).cast("string").alias("cdm_field"),
        F.lit(file_name).alias("file_name"),
        "field_name",
        F.col("data_row").cast("bigint").alias("data_row"),
        F.lit(INVALID_TYPE).alias("error"),
    )


def passing_reports(rows: DataFrame, errors: DataFrame, report_col: str = "report_name") -> DataFrame:
    """Rows of reports that have no error row at all."""
    failed = lookup_side(errors.select(named(report_col)).distinct())
    return rows.join(failed, report_col, "left_anti")


def sorted_errors(*tables: DataFrame) -> DataFrame:
    """All error rows by report and row; the other columns only make the order repeatable."""
    merged = reduce(lambda a, b: a.unionByName(b), tables)
    order = ["report_name", "data_row", "file_name", "cdm_field", "field_name", "error"]
    return merged.orderBy(*[F.col(c).asc_nulls_last() for c in order])
