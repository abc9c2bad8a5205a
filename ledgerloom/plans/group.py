"""Grouping of a trial balance: joined table, coverage and category totals."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators import grouping as ops
from ledgerloom.sinks.writers import write_groupings, write_table


@dataclass(frozen=True)
class Grouped:
    table: DataFrame
    coverage: DataFrame
    rollup: DataFrame
    accounts: DataFrame


def group_trial_balance(
    tb: DataFrame, grouping: DataFrame, with_names: bool = False, account: str = "account"
) -> Grouped:
    """Joins by account code, or by code and account name, and scores the result."""
    table = (
        ops.group_by_code_and_name(tb, grouping)
        if with_names
        else ops.group_by_code(tb, ops.without_nan_text(grouping))
    )
    return scored(table, account)


def scored(table: DataFrame, account: str = "account") -> Grouped:
    return Grouped(
        table,
        ops.coverage(table, account=account),
        ops.category_rollup(table, account=account),
        ops.category_accounts(table, account=account),
    )


def quality_block(grouped: Grouped) -> DataFrame:
    """Coverage and the totals of each category in one row."""
    cells = F.struct("category", "total_value", "mapped", "accounts")
    details = grouped.rollup.agg(F.array_sort(F.collect_list(cells)).alias("account_detail"))
    return grouped.coverage.select("*", details.scalar().alias("account_detail"))


def write_grouped(grouped: Grouped, grouping: DataFrame, folder: str, name: str = "trialBalance") -> None:
    folder = folder.rstrip("/")
    stored = f"{folder}/{name}_grouped.parquet"
    write_table(grouped.table, stored, "parquet")
    written = grouped.table.sparkSession.read.parquet(stored)
    write_table(written, f"{folder}/{name}_grouped.csv")
    write_groupings(grouping, quality_block(scored(written)), f"{folder}/grouping")
    ops.category_accounts(written).write.mode("overwrite").json(f"{folder}/grouping/accounts")
