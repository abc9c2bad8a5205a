"""Data-quality metrics of canonical tables.

All plain metrics of a table come from one aggregation over it, all distinct counts from a second scan of their columns
alone; no row is multiplied. Results are long tables with ``METRIC_SCHEMA``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.columns import blank_to_null, named
from ledgerloom.functions.numbers import money_sum, money_total, uncounted_amounts
from ledgerloom.operators.ordinals import sequence_gaps
from ledgerloom.spec import NUMERIC_TYPES, TypedField

METRIC_SCHEMA = {
    "entity": "string",
    "section": "string",
    "metric": "string",
    "value": "double",
    "outcome": "string",
    "percent": "int",
    "total": "bigint",
    "count": "bigint",
    "fields": "array<struct<name:string,percent:int,present:boolean>>",
    "warning": "string",
}

NET_TOLERANCE = 0.001
ZERO_CLAMP = 0.000001

# Canonical fields that the presence rules look at.
CONTROL_FIELDS = ("enteredBy", "enteredDateTime", "approvedBy", "approvedDateTime", "lastModifiedBy")
REVERSAL_FIELDS = ("reversalIndicator", "reversalJournalId")
MANUAL_JOURNAL_FIELDS = ("journalEntryType", "sourceId")


@dataclass(frozen=True)
class Metric:
    """One row of the long metric table; its values are SQL expressions over the one-row aggregate."""

    section: str
    name: str
    value: str = "NULL"
    outcome: str = "NULL"
    percent: str = "NULL"
    total: str = "NULL"
    count: str = "NULL"
    fields: str = "NULL"
    warning: str = "NULL"

    def sql(self, entity: str) -> str:
        given = {
            "entity": f"'{entity}'",
            "section": f"'{self.section}'",
            "metric": f"'{self.name}'",
            "value": self.value,
            "outcome": self.outcome,
            "percent": self.percent,
            "total": self.total,
            "count": self.count,
            "fields": self.fields,
            "warning": self.warning,
        }
        cells = [f"'{name}', cast({given[name]} AS {kind})" for name, kind in METRIC_SCHEMA.items()]
        return f"named_struct({', '.join(cells)})"


def metric_rows(one_row: DataFrame, entity: str, metrics: Sequence[Metric]) -> DataFrame:
    return one_row.selectExpr(f"inline(array({', '.join(m.sql(entity) for m in metrics)}))")


# ---- aggregates -------------------------------------------------------------------------------------


def distinct_counts(df: DataFrame, columns: Mapping[str, str]) -> Column:
    """Struct of the distinct counts of columns without nulls and empty text, by given name, as one scalar subquery.

    One scan of these columns alone; their distinct combinations, not the rows, are spread over the counts.
    """
    values = df.select(*[F.when(named(c).cast("string") != "", named(c)).alias(n) for n, c in columns.items()])
    return values.distinct().agg(F.struct(*[F.count_distinct(named(n)).alias(n) for n in columns])).scalar()


def signed(amount: Column, indicator: Column) -> Column:
    """Amounts with credits negated; any other indicator counts as debit."""
    return F.when(indicator == "C", -amount).otherwise(amount)


def signed_sum(amount: Column, indicator: Column) -> Column:
    return money_sum(signed(amount, indicator))


def amount_aggregates(amount: Column, name: str) -> list[Column]:
    """The exact sum, the sum of any size, and the number of cells in neither."""
    return [money_sum(amount).alias(name), money_total(amount).alias(f"{name} total"), uncounted_amounts(amount).alias(f"{name} uncounted")]


def netting(total: str) -> str:
    return f"CASE WHEN abs({total}) <= {NET_TOLERANCE} THEN 'pass' ELSE 'fail' END"


def clamped(total: str) -> str:
    return f"CASE WHEN abs({total}) < {ZERO_CLAMP} THEN 0 ELSE {total} END"


def rounded(total: str) -> str:
    return f"round({total}, 5)"


def percent(count: str, total: str) -> str:
    """Whole percentage, rounded half to even; zero when there is nothing to count."""
    return f"coalesce(bround(try_divide(double({count}), double({total})) * 100, 0), 0)"


def _filled(name: str) -> str:
    return f"filled {name}"


def _present(name: str) -> str:
    return f"present {name}"


def fill_counts(df: DataFrame, names: Sequence[str]) -> list[Column]:
    """Per column: rows with a non-blank value."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    return [
        F.count(blank_to_null(named(n)) if n in texts else named(n)).alias(_filled(n)) for n in names
    ]


def presence_counts(names: Sequence[str]) -> list[Column]:
    """Per column: rows with any value, blank text included."""
    return [F.count(named(n)).alias(_present(n)) for n in names]


# ---- metric lists over the aggregate ----------------------------------------------------------------

CELLS, DISTINCT = "_cells", "_distinct"
_CELL = "array<struct<name:string,kind:string,filled:bigint,present:bigint>>"


def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def cell_array(columns: Sequence[str], kinds: dict[str, str], filled=(), present=()) -> str:
    """One array with name, declared type and counts of each column, read by the metrics below."""

    def quoted(name: str) -> str:
        return "`" + name.replace("`", "``") + "`"

    cells = [
        f"named_struct('name', {_text(c)}, 'kind', {_text(kinds.get(c))}, "
        f"'filled', {quoted(_filled(c)) if c in filled else 'NULL'}, "
        f"'present', {quoted(_present(c)) if c in present else 'NULL'})"
        for c in columns
    ]
    return f"cast(array({', '.join(cells)}) AS {_CELL}) AS {CELLS}"


def _fields(cells: str, percent_of: str = "NULL", flag_of: str = "NULL") -> str:
    return f"transform({cells}, c -> named_struct('name', c.name, 'percent', {percent_of}, 'present', {flag_of}))"


def presence_metric(name: str, fields: Sequence[str]) -> Metric:
    """Which of the columns hold any value at all, and their share."""
    cells = f"filter({CELLS}, c -> c.name IN ({', '.join(map(_text, fields))}))"
    present = f"size(filter({cells}, c -> c.present > 0))"
    return Metric(
        "business_rule",
        name,
        percent=percent(present, str(len(fields))),
        fields=_fields(cells, flag_of="c.present > 0"),
    )


def profile_metrics() -> list[Metric]:
    """Filled, empty and gapped columns, from ``recordCount`` and the cell array."""
    texts = f"filter({CELLS}, c -> c.kind = 'string')"
    numbers = f"filter({CELLS}, c -> c.kind IN ({', '.join(map(_text, NUMERIC_TYPES))}))"

    def section(name: str, among: str, chosen: str) -> Metric:
        found = f"filter({among}, c -> {chosen})"
        total, count = f"size({among})", f"size({found})"
        return Metric("profile", name, percent=percent(count, total), total=total, count=count, fields=_fields(found))

    used = f"filter({CELLS}, c -> c.filled > 0)"
    gapped = f"filter({used}, c -> c.filled < recordCount)"
    return [
        section("fieldsFilled", CELLS, "c.filled > 0"),
        section("fieldsEmpty", CELLS, "c.filled = 0"),
        section("textFieldsEmpty", texts, "c.filled < recordCount"),
        section("numericFieldsEmpty", numbers, "c.filled < recordCount"),
        Metric(
            "profile",
            "missingRecords",
            percent=percent(f"size({used}) - size({gapped})", f"size({used})"),
            total=f"size({used})",
            count=f"size({gapped})",
            fields=_fields(gapped, percent_of=f"cast({percent('c.filled', 'recordCount')} AS int)"),
        ),
    ]


def _statistic(name: str, value: str | None = None) -> Metric:
    return Metric("statistical", name, value=value or name)


def _amount_statistic(name: str, column: str, exact: str) -> Metric:
    """A sum of amounts; a warning counts the cells that it leaves out."""
    left_out = f"`{column} uncounted`"
    return Metric(
        "statistical", name, value=f"coalesce(double({exact}), `{column} total`)",
        warning=f"CASE WHEN {left_out} > 0 THEN concat({left_out}, ' amounts are no finite number below 1e38') END",
    )


# ---- per entity -------------------------------------------------------------------------------------


def _ledger_parts():
    aggregates = [
        *amount_aggregates(named("amount"), "amountSum"),
        *amount_aggregates(named("localAmount"), "localAmountSum"),
        *amount_aggregates(signed(named("amount"), named("amountCreditDebitIndicator")), "net"),
    ]
    statistical = [
        _amount_statistic("amountSum", "amountSum", rounded("amountSum")),
        _amount_statistic("localAmountSum", "localAmountSum", rounded("localAmountSum")),
        _amount_statistic("debitCredits", "net", rounded("net")),
    ]
    return aggregates, statistical, [Metric("business_rule", "netting", outcome=netting("net"))]


def _trial_balance_parts():
    aggregates = [
        *amount_aggregates(named("amountBeginning"), "beginning"),
        *amount_aggregates(named("amountEnding"), "ending"),
    ]
    statistical = [
        _amount_statistic("amountBeginingSum", "beginning", rounded("beginning")),
        _amount_statistic("amountEndingSum", "ending", rounded(clamped("ending"))),
    ]
    return aggregates, statistical, [Metric("business_rule", "netting", outcome=netting("ending"))]


def _chart_of_accounts_parts():
    return [], [], []


_PARTS = {
    "glDetail": _ledger_parts,
    "trialBalance": _trial_balance_parts,
    "ChartOfAccounts": _chart_of_accounts_parts,
}
_PRESENCE_RULES = {
    "glDetail": (
        ("controlChecks", CONTROL_FIELDS),
        ("reversals", REVERSAL_FIELDS),
        ("manualJournals", MANUAL_JOURNAL_FIELDS),
    )
}
# Columns that the plain aggregates read.
_SUMMED = {
    "glDetail": ("amount", "localAmount", "amountCreditDebitIndicator"),
    "trialBalance": ("amountBeginning", "amountEnding"),
    "ChartOfAccounts": (),
}
SECTIONS = ("statistical", "business_rule", "profile")
_DISTINCT_COUNTS = {"glAccountCodeCount": "glAccountNumber", "businessUnitCounts": "businessUnitCode"}


def scorecard(
    df: DataFrame,
    entity: str,
    declared: Sequence[TypedField] = (),
    ord_col: str | None = None,
    sections: Sequence[str] = SECTIONS,
) -> DataFrame | None:
    """Metric table of one canonical table; None for entities without metrics.

    ``ord_col`` gives the file order for the journal sequence check and is not itself a field.
    """
    if entity not in _PARTS:
        return None
    columns = [c for c in df.columns if c != ord_col]
    # A field that the table lacks counts as never filled.
    needed = {*_SUMMED[entity], *_DISTINCT_COUNTS.values(), *[f for _, fs in _PRESENCE_RULES.get(entity, ()) for f in fs]}
    needed |= {"journalId"} if entity == "glDetail" else set()
    df = df.withColumns({c: F.lit(None).cast("string") for c in sorted(needed - set(columns))})
    aggregates, statistical, rules = _PARTS[entity]()
    presence = _PRESENCE_RULES.get(entity, ()) if "business_rule" in sections else ()
    checked = [f for _, fields in presence for f in fields]
    profiled = columns if "profile" in sections else []
    metrics: list[Metric] = []
    wide = [F.count(F.lit(1)).alias("recordCount"), *aggregates]
    if "statistical" in sections:
        metrics += [
            _statistic("recordCount"),
            _statistic("fieldCount", str(len(columns))),
            *statistical,
            *[_statistic(name, f"{DISTINCT}.{name}") for name in _DISTINCT_COUNTS],
        ]
    if "business_rule" in sections:
        metrics += rules + [presence_metric(name, fields) for name, fields in presence]
    if "profile" in sections:
        metrics += profile_metrics()
    one_row = df.agg(*wide, *presence_counts(checked), *fill_counts(df, profiled))
    kinds = {f.name: f.data_type for f in declared}
    derived = [F.expr(cell_array(columns, kinds, profiled, checked))] if profiled or checked else []
    if "statistical" in sections:
        derived.append(distinct_counts(df, _DISTINCT_COUNTS).alias(DISTINCT))
    one_row = one_row.select("*", *derived)
    result = metric_rows(one_row, entity, metrics)
    if entity == "glDetail" and "business_rule" in sections and ord_col:
        result = result.unionByName(sequence_metric(df, entity, ord_col))
    return result


def sequence_metric(df: DataFrame, entity: str, ord_col: str) -> DataFrame:
    found = sequence_gaps(df, "journalId", ord_col)
    metric = Metric(
        "business_rule",
        "missingSequentialItems",
        percent="percent",
        total="n",
        count="gaps",
        fields="array(named_struct('name', 'journalId', 'percent', NULL, 'present', complete))",
        warning="warning",
    )
    return metric_rows(found, entity, [metric])
