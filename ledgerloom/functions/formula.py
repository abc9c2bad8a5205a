"""Arithmetic formulas over ``<n>`` operands, compiled once into a Column expression."""

from __future__ import annotations

import ast
import re
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions.numbers import round_binary

_OPERAND = re.compile(r"<(\d+)>")


def _modulo(left: Column, right: Column) -> Column:
    return left - right * F.floor(F.try_divide(left, right)).cast("double")


_BINARY = {
    ast.Add: lambda left, right: left + right,
    ast.Sub: lambda left, right: left - right,
    ast.Mult: lambda left, right: left * right,
    ast.Div: F.try_divide,
    ast.FloorDiv: lambda left, right: F.floor(F.try_divide(left, right)).cast("double"),
    ast.Mod: _modulo,
    ast.Pow: F.pow,
}


def operands(expression: str) -> tuple[int, ...]:
    return tuple(dict.fromkeys(int(n) for n in _OPERAND.findall(expression)))


def compile_formula(expression: str, values: Mapping[int, Column]) -> Column:
    """Column for ``expression``, rounded half to even at four places; null where it has no finite value.

    ``values`` maps operand numbers to numeric columns; nulls count as zero. ``^`` is the power sign.
    Only numbers, operands and arithmetic operators are accepted.
    """
    source = _OPERAND.sub(r"operand_\1", re.sub(r"\s", "", expression)).replace("^", "**")
    if not source:
        raise ValueError("No Expression to evaluate")
    tree = ast.parse(source, mode="eval").body

    def column(node: ast.expr) -> Column:
        if isinstance(node, ast.BinOp) and type(node.op) in _BINARY:
            return _BINARY[type(node.op)](column(node.left), column(node.right))
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.USub):
            return -column(node.operand)
        if isinstance(node, ast.UnaryOp) and isinstance(node.op, ast.UAdd):
            return column(node.operand)
        if isinstance(node, ast.Constant) and type(node.value) in (int, float):
            return F.lit(float(node.value))
        if isinstance(node, ast.Name) and node.id.startswith("operand_"):
            return F.coalesce(values[int(node.id[len("operand_") :])], F.lit(0.0))
        raise ValueError(f"formula part {ast.unparse(node)!r} is not allowed")

    result = column(tree)
    finite = ~F.isnan(result) & (F.abs(result) != F.lit(float("inf")))
    return F.when(finite, round_binary(result, 4))
