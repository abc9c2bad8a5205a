"""Debit / credit indicators."""

from __future__ import annotations

from collections.abc import Sequence
from heapq import heappop, heappush

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.spec import AccountRange


def indicator_by_sign(amount: Column) -> Column:
    """``D`` from zero upwards, else ``C``; a null amount counts as credit."""
    return F.when(amount >= 0, "D").otherwise("C")


def indicator_by_columns(debit: Column, credit: Column) -> Column:
    """Indicator of the larger of two amounts; with one amount only, its side; with none, null."""
    return (
        F.when(debit.isNotNull() & credit.isNotNull(), F.when(debit > credit, "D").otherwise("C"))
        .when(debit.isNotNull(), "D")
        .when(credit.isNotNull(), "C")
    )


def _winning_rules(ranges: Sequence[AccountRange]) -> list[tuple[float, str | None, str | None]]:
    """``(bound, rule at the bound, rule between it and the next bound)`` for ascending bounds.

    One sweep: open ranges wait in a heap, latest first, and closed ones leave when they come to its top.
    """
    opening: dict[float, list[tuple[int, float, str]]] = {}
    for place, r in enumerate(ranges):
        if r.negatives in ("Debit", "Credit") and r.start <= r.end:
            opening.setdefault(r.start, []).append((-place, r.end, r.negatives))
    open_ranges: list[tuple[int, float, str]] = []
    found = []
    for bound in sorted({b for r in ranges for b in (r.start, r.end)}):
        for r in opening.get(bound, ()):
            heappush(open_ranges, r)
        rules = []
        for closed in (lambda end: end < bound, lambda end: end <= bound):
            while open_ranges and closed(open_ranges[0][1]):
                heappop(open_ranges)
            rules.append(open_ranges[0][2] if open_ranges else None)
        found.append((bound, *rules))
    return found


def negatives_rule(account: Column, ranges: Sequence[AccountRange]) -> Column:
    """The ``negatives`` rule of the last range covering ``account``, null without one.

    The ranges are cut into disjoint stretches beforehand and compiled into a balanced tree of
    comparisons: each row needs a logarithmic number of them and no join. For ranges held in a
    table, or by the thousand, ``operators.ranges`` joins instead.
    """
    stretches = _winning_rules(ranges)

    def tree(low: int, high: int) -> Column:
        if high - low == 1:
            bound, at_bound, beyond = stretches[low]
            return F.when(account == bound, F.lit(at_bound)).otherwise(F.lit(beyond).cast("string"))
        middle = (low + high) // 2
        return F.when(account < stretches[middle][0], tree(low, middle)).otherwise(tree(middle, high))

    if not stretches:
        return F.lit(None).cast("string")
    return F.when(account >= stretches[0][0], tree(0, len(stretches)))


def indicator_by_range(account: Column, amount: Column, ranges: Sequence[AccountRange]) -> Column:
    """Indicator from the account's range and the sign of the amount; null without a range."""
    return indicator_by_rule(negatives_rule(account, ranges), amount)


def indicator_by_rule(rule: Column, amount: Column) -> Column:
    """Indicator from a ``negatives`` rule and the sign of the amount; null without a rule."""
    negative = F.coalesce(amount < 0, F.lit(False))
    return F.when(rule == "Debit", F.when(negative, "D").otherwise("C")).when(
        rule == "Credit", F.when(negative, "C").otherwise("D")
    )
