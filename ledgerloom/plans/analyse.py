"""Step lists: filters and aggregates over a table or over the result of an earlier step."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence

from pyspark.sql import DataFrame

from ledgerloom.operators.aggregates import Kept, aggregate_steps, count_values, net_amounts, sum_values
from ledgerloom.operators.filters import filter_all, filter_any, kept_by
from ledgerloom.runtime import durable
from ledgerloom.sinks.writers import write_preview, write_table
from ledgerloom.spec import Step

AGGREGATES = ("Count", "Sum", "Net")


def run_step(df: DataFrame, step: Step, signed_net: bool = False) -> DataFrame:
    if step.kind == "Filter":
        if step.relation == "or":
            return filter_any(df, step.conditions, mode="bag")
        return filter_all(df, step.conditions)
    if step.kind == "Count":
        return count_values(df, step.conditions)
    if step.kind == "Sum":
        return sum_values(df, step.conditions)
    if step.kind == "Net":
        return net_amounts(df, signed=signed_net)
    raise ValueError(f"unknown step type {step.kind!r}")


def _together(base: DataFrame, steps: Sequence[Step], signed_net: bool) -> dict[str, DataFrame]:
    """Results of the aggregate steps that only filters part from ``base``, if there are several: one pass for all."""
    kept = {"": Kept()}
    found: list[tuple[Step, Kept]] = []
    for step in steps:
        if step.source not in kept:
            continue
        if step.kind == "Filter":
            kept[step.order] = kept_by(base, step.conditions, step.relation, kept[step.source])
        elif step.kind in AGGREGATES:
            found.append((step, kept[step.source]))
    return aggregate_steps(base, found, signed_net) if len(found) > 1 else {}


def run_steps(base: DataFrame, steps: Sequence[Step], signed_net: bool = False) -> dict[str, DataFrame]:
    """Result per step order. A step without a source reads the base table.

    Aggregate steps over filters of the base table share one pass over it. Of the others, a result that several steps
    read is stored once; the rest is lazy.
    """
    results: dict[str, DataFrame] = {}
    ready = _together(base, steps, signed_net)
    readers = Counter(step.source for step in steps if step.order not in ready)
    for step in steps:
        if step.order in ready:
            results[step.order] = ready[step.order]
            continue
        source = results[step.source] if step.source else base
        result = run_step(source, step, signed_net)
        results[step.order] = durable(result) if readers[step.order] > 1 else result
    return results


def run_chain(base: DataFrame, steps: Sequence[Step], signed_net: bool = False) -> dict[str, DataFrame]:
    """The older linear form: every step reads the result of the one before it."""
    results: dict[str, DataFrame] = {}
    current = base
    for step in steps:
        current = run_step(current, step, signed_net)
        results[step.order] = current
    return results


def write_steps(
    base: DataFrame, steps: Sequence[Step], folder: str, order_by: str | None = None
) -> dict[str, DataFrame]:
    """Runs the steps and writes each as ``tmp_<type>_<order>.parquet``, ``.csv`` and ``.json`` (first ten rows).

    Every result is computed once, into the Parquet table; the other files and later steps read it from there, and
    aggregate steps of one source share a pass over it. The CSV is an export, which ``read_headed_csv`` reads back.
    """
    spark = base.sparkSession
    results: dict[str, DataFrame] = {}
    ready: dict[str, DataFrame] = {}
    for step in steps:
        source = results[step.source] if step.source else base
        name = f"{folder.rstrip('/')}/tmp_{step.kind}_{step.order}"
        if step.kind in AGGREGATES and step.order not in ready:
            every = Kept()
            beside = [(s, every) for s in steps if s.kind in AGGREGATES and s.source == step.source]
            ready |= aggregate_steps(source, beside) if len(beside) > 1 else {step.order: run_step(source, step)}
        result = ready[step.order] if step.kind in AGGREGATES else run_step(source, step)
        write_table(result, f"{name}.parquet", "parquet")
        result = results[step.order] = spark.read.parquet(f"{name}.parquet")
        shown = result.drop("condition_no")
        write_table(shown, f"{name}.csv")
        write_preview(shown, f"{name}.json", order_by=order_by if order_by in shown.columns else None)
    return results
