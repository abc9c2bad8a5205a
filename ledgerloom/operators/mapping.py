"""Mapping rows compiled to columns: source fields of a validated file → fields of a canonical table.

Every operator yields a value and an error text; a cell that cannot be mapped gives null and an error
instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions import codes, dates, indicators
from ledgerloom.functions.columns import named
from ledgerloom.functions.formula import compile_formula
from ledgerloom.functions.numbers import is_number, parse_number
from ledgerloom.spec import NUMERIC_TYPES, MappingRow

# Error texts of mapping operators.
NOT_NUMERIC_ABS = "The value {} is not numeric to convert to float/int for absolute function"
NOT_NUMERIC_SIGN = "The value {} is not numeric to convert to float/int for DbCrInd1 function"
BAD_DATE = "The value {} is not in the proper Date Format"
BAD_SPLIT = "Could not split the value {} for {} characters"
BAD_DIVISION = "Could not divide the value {} by {}"
BAD_FORMULA = "Failed to solve the expression. {}"
BAD_OPERAND = "Expresion contains non numeric operand(s). {}"
BAD_ADDITION = "Could not use Addition operation"
BAD_SUBTRACTION = "Could not use subtraction operation"
BAD_PRODUCT = "Could not calculate product"
NO_INDICATOR = "Could not determine Debit/Credit Indicator for {}"
NO_RANGE = "Could not determine DC Indicator. Reference not in range | Data: A/C No - {}, Amount - {}"
ACCOUNT_NOT_NUMERIC = "A/C No should be numeric | Data: {}"
AMOUNT_NOT_NUMERIC = "Amount value should be numeric | Data: {}"
DIFFERENT_FILES = "Using fields of different input files"
FORMULA_FILES = "Multiple files used for the conversion."

_SPARK_TYPES = {"decimal": "double", "number": "double", "integer": "bigint", "boolean": "boolean"}


@dataclass(frozen=True)
class Mapped:
    """A target column with its error text, the file it comes from and what to report as its field."""

    target: str
    value: Column
    error: Column | None = None
    file_name: str | None = None
    field_name: str | None = None


@dataclass(frozen=True)
class JobError:
    """An error of the mapping itself rather than of a row."""

    target: str
    error: str


class Cells:
    """Validated source fields of one file, by name, with the type each was validated as."""

    def __init__(self, kinds: Mapping[str, str]):
        self._kinds = kinds

    def raw(self, name: str) -> Column:
        return named(name)

    def text(self, name: str) -> Column:
        return named(name).cast("string")

    def number(self, name: str) -> Column:
        return named(name) if self._typed(name) else parse_number(self.text(name))

    def valid_number(self, name: str) -> Column:
        return F.lit(True) if self._typed(name) else is_number(self.text(name))

    def _typed(self, name: str) -> bool:
        return self._kinds.get(name) in NUMERIC_TYPES


def _message(template: str, *values: Column) -> Column:
    pieces = template.split("{}")
    columns = [F.lit(pieces[0])]
    for value, piece in zip(values, pieces[1:]):
        columns += [F.coalesce(value, F.lit("nan")), F.lit(piece)]
    return F.concat(*columns)


def spark_type(data_type: str) -> str:
    return _SPARK_TYPES.get(data_type, "string")


def empty_column(row: MappingRow) -> Column:
    return F.lit(None).cast(spark_type(row.data_type))


def split_head(c: Column, size: int) -> Column:
    return F.substring(c, 1, size)


def split_rest(c: Column, size: int) -> Column:
    """What follows the first ``size`` characters; null when the text is shorter but not empty."""
    long_enough = (F.length(c) >= size) | (F.length(c) == 0)
    return F.when(long_enough, F.substring(c, size + 1, 2_147_483_647))


def _folded(cells: Cells, names: list[str], combine: Callable[[Column, Column], Column]) -> Column:
    numbers = [
        F.when(cells.text(n) == "", F.lit(0.0)).otherwise(_zero_for_null(cells, n)) for n in names
    ]
    return reduce(combine, numbers)


def _zero_for_null(cells: Cells, name: str) -> Column:
    return F.when(cells.raw(name).isNull(), F.lit(0.0)).otherwise(cells.number(name))


def _sum_like(combine, message):
    def build(row: MappingRow, cells: Cells, names: list[str]) -> list[Mapped]:
        value = _folded(cells, names, combine)
        error = F.when(value.isNull(), F.lit(message))
        return [_result(row, value, error, " | ".join(names))]

    return build


def _result(row: MappingRow, value: Column, error: Column | None = None, field: str | None = None):
    files = row.files() or ((row.file_name,) if row.file_name else (None,))
    return Mapped(row.target, value, error, files[0], field)


def _free_text(row, cells, names):
    return [_result(row, F.lit(row.free_text))]


def _formula(row, cells, names):
    by_order = {s.order: s.field_name for s in row.sources}
    values = {order: _zero_for_blank(cells, name) for order, name in by_order.items()}
    result = compile_formula(row.expression, values)
    numeric = reduce(lambda a, b: a & b, [_usable(cells, n) for n in names], F.lit(True))
    error = F.when(~numeric, _message(BAD_OPERAND, F.lit(row.expression))).when(
        result.isNull(), _message(BAD_FORMULA, F.lit(row.expression))
    )
    return [_result(row, F.when(numeric, result), error)]


def _usable(cells: Cells, name: str) -> Column:
    return cells.valid_number(name) | (cells.text(name) == "")


def _zero_for_blank(cells: Cells, name: str) -> Column:
    return F.when(cells.text(name) == "", F.lit(0.0)).otherwise(_zero_for_null(cells, name))


def _account_code(row, cells, names):
    split = row.code_split
    extract = codes.code_outside if split.inside_outside == "outside" else codes.code_inside
    return [_result(row, extract(cells.text(names[0]), split.opening_char, split.closing_char))]


def _coalesce(row, cells, names):
    """The first non-blank field: validation turns null text into empty text."""
    values = [F.when(cells.text(n) != "", cells.raw(n)) for n in names[:-1]]
    return [_result(row, F.coalesce(*values, cells.raw(names[-1])))]


def _absolute(row, cells, names):
    c = cells.raw(names[0])
    value = F.when(c.isNotNull(), F.abs(F.coalesce(cells.number(names[0]), F.lit(0.0))))
    return [_result(row, value, None, names[0])]


def _indicator_by_sign(row, cells, names):
    valid = cells.valid_number(names[0])
    value = F.when(valid, indicators.indicator_by_sign(cells.number(names[0])))
    error = F.when(~valid, _message(NOT_NUMERIC_SIGN, cells.text(names[0])))
    return [_result(row, value, error, names[0])]


def _split(row, cells, names):
    c = cells.text(names[0])
    short = (F.length(c) > 0) & (F.length(c) < row.characters)
    error = F.when(short, _message(BAD_SPLIT, c, F.lit(str(row.characters))))
    mapped = [_result(row, split_head(c, row.characters), error, names[0])]
    if row.extra:
        mapped.append(Mapped(row.extra, split_rest(c, row.characters), None, mapped[0].file_name))
    return mapped


def _divide(row, cells, names):
    left, right = [cells.number(n) if cells._typed(n) else cells.text(n).try_cast("double") for n in names[:2]]
    value = F.try_divide(left, right)
    present = cells.raw(names[0]).isNotNull() & cells.raw(names[1]).isNotNull()
    error = F.when(
        value.isNull() & present, _message(BAD_DIVISION, cells.text(names[0]), cells.text(names[1]))
    )
    return [_result(row, value, error, " | ".join(names[:2]))]


def _debit_plus_credit(row, cells, names):
    debit, credit = [F.coalesce(cells.number(n), F.lit(0.0)) for n in names[:2]]
    return [_result(row, debit + credit)]


def _indicator_by_columns(row, cells, names):
    value = indicators.indicator_by_columns(*[_zero_for_null(cells, n) for n in names[:2]])
    pair = F.concat_ws(", ", *[cells.text(n) for n in names[:2]])
    return [_result(row, value, F.when(value.isNull(), _message(NO_INDICATOR, pair)), "")]


def _indicator_by_range(row, cells, names):
    account, amount = names[:2]
    valid = cells.valid_number(account) & cells.valid_number(amount)
    value = F.when(
        valid, indicators.indicator_by_range(cells.number(account), cells.number(amount), row.ranges)
    )
    error = (
        F.when(~cells.valid_number(account), _message(ACCOUNT_NOT_NUMERIC, cells.text(account)))
        .when(~cells.valid_number(amount), _message(AMOUNT_NOT_NUMERIC, cells.text(amount)))
        .when(value.isNull(), _message(NO_RANGE, cells.text(account), cells.text(amount)))
    )
    return [_result(row, value, error, f"{account} | {amount}")]


def _concatenate(row, cells, names):
    return [_result(row, F.concat_ws("-", *[F.coalesce(cells.text(n), F.lit("")) for n in names]))]


# Operation codes of mapping files; journal line numbers need a window and are added by the job.
JOURNAL_LINE_NUMBER = "Journal Line Number"
_OPERATIONS = {
    "FT": _free_text,
    "MC": _formula,
    "SGLAN": _account_code,
    "CS": _coalesce,
    "ABS": _absolute,
    "SPLIT": _split,
    "DCI1": _indicator_by_sign,
    "DCI2": _indicator_by_columns,
    "DCI3": _indicator_by_range,
    "DIV": _divide,
    "DC": _debit_plus_credit,
    "SUM": _sum_like(lambda a, b: a + b, BAD_ADDITION),
    "DIFF": _sum_like(lambda a, b: a - b, BAD_SUBTRACTION),
    "PROD": _sum_like(lambda a, b: a * b, BAD_PRODUCT),
    "CONCAT": _concatenate,
}
_SORTED_OPERANDS = {"CS", "SUM", "DIFF", "PROD", "CONCAT", "DCI2"}


def _direct(row: MappingRow, cells: Cells, names: list[str]) -> list[Mapped]:
    name = names[0]
    if row.data_type == "decimal":
        return [_result(row, cells.number(name), None, name)]
    if row.data_type == "integer":
        return [_result(row, cells.number(name).try_cast("bigint"), None, name)]
    return [_result(row, cells.raw(name), None, name)]


def _date_mask(row: MappingRow, cells: Cells, names: list[str]) -> list[Mapped]:
    c = cells.text(names[0])
    try:
        value = dates.masked_timestamp(F.when(c != "", c), row.date_format)
    except ValueError:
        # No cell can be read with an unknown code; each says so.
        value = F.lit(None).cast("string")
    error = F.when((c != "") & value.isNull(), _message(BAD_DATE, c))
    return [_result(row, value, error, names[0])]


def compile_row(row: MappingRow, kinds: Mapping[str, str]) -> list[Mapped] | JobError:
    """Columns of one mapping row; more than one only where an operator also fills an extra field."""
    if row.map_type == "dummy" or (row.map_type == "direct" and not row.sources):
        return [_result(row, empty_column(row))]
    cells = Cells(kinds)
    if len(row.files()) > 1:
        if row.operation == "MC":
            return JobError(row.target, FORMULA_FILES)
        if row.operation == "DCI3":
            return [Mapped(row.target, empty_column(row))]
        return JobError(row.target, DIFFERENT_FILES)
    sources = row.ordered_sources() if row.operation in _SORTED_OPERANDS else row.sources
    names = [s.field_name for s in sources]
    if row.map_type == "direct":
        return _direct(row, cells, names)
    if row.map_type == "date-mask":
        return _date_mask(row, cells, names)
    if row.map_type == "calculated" and row.operation in _OPERATIONS:
        return _OPERATIONS[row.operation](row, cells, names)
    raise ValueError(f"unknown mapping {row.map_type!r} / {row.operation!r}")
