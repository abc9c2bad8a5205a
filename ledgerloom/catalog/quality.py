"""Scorecards, sequence gaps and journal line numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.catalog.registry import query
from ledgerloom.catalog.tables import (
    COA_SQL,
    GL_SQL,
    LINE_ORDER,
    TB_SQL,
    chart_of_accounts,
    general_ledger,
    table,
    trial_balance,
)
from ledgerloom.functions.numbers import money_sum, money_total, uncounted_amounts
from ledgerloom.operators.ordinals import dense_ordinal, journal_line_numbers, sequence_gaps
from ledgerloom.operators.quality import scorecard
from ledgerloom.spec import TypedField

_MONEY = "CAST({} AS DECIMAL(38,10))"


def _union(source: str, rows: list[tuple[str, ...]], columns: tuple[str, ...]) -> str:
    first = ", ".join(f"{v} AS {c}" for v, c in zip(rows[0], columns))
    rest = [", ".join(row) for row in rows[1:]]
    return " UNION ALL ".join(f"SELECT {r} FROM {source}" for r in [first, *rest])


def _money_sum(expression: str) -> str:
    return f"coalesce(sum({_MONEY.format(expression)}), 0)"


def _statistics_sql(cte: str, source: str, metrics: dict[str, str]) -> str:
    rows = [(f"'{name}'", f"({sql})::double") for name, sql in metrics.items()]
    return f"WITH {cte} " + _union(source, rows, ("metric", "value"))


def _distinct(column: str) -> str:
    return f"count(DISTINCT nullif(cast({column} AS varchar), ''))"


def _statistics(df: DataFrame, entity: str) -> DataFrame:
    return scorecard(df, entity, sections=["statistical"]).select("metric", "value")


_SIGNED = "CASE WHEN amountCreditDebitIndicator = 'C' THEN -amount ELSE amount END"


@query(
    "gl_statistical",
    _statistics_sql(
        GL_SQL,
        "gl",
        {
            "recordCount": "count(*)",
            "fieldCount": "max(16)",
            "amountSum": f"round({_money_sum('amount')}, 5)",
            "localAmountSum": f"round({_money_sum('localAmount')}, 5)",
            "debitCredits": f"round({_money_sum(_SIGNED)}, 5)",
            "glAccountCodeCount": _distinct("glAccountNumber"),
            "businessUnitCounts": _distinct("businessUnitCode"),
        },
    ),
)
def _(spark, sf_dir):
    return _statistics(general_ledger(spark, sf_dir), "glDetail")


@query(
    "tb_statistical",
    _statistics_sql(
        TB_SQL,
        "tb",
        {
            "recordCount": "count(*)",
            "fieldCount": "max(9)",
            "amountBeginingSum": f"round({_money_sum('amountBeginning')}, 5)",
            "amountEndingSum": f"round({_money_sum('amountEnding')}, 5)",
            "glAccountCodeCount": _distinct("glAccountNumber"),
            "businessUnitCounts": _distinct("businessUnitCode"),
        },
    ),
)
def _(spark, sf_dir):
    return _statistics(trial_balance(spark, sf_dir), "trialBalance")


@query(
    "coa_statistical",
    _statistics_sql(
        COA_SQL,
        "coa",
        {
            "recordCount": "count(*)",
            "fieldCount": "max(4)",
            "glAccountCodeCount": _distinct("glAccountNumber"),
            "businessUnitCounts": _distinct("businessUnitCode"),
        },
    ),
)
def _(spark, sf_dir):
    return _statistics(chart_of_accounts(spark, sf_dir), "ChartOfAccounts")


_NETTING = "CASE WHEN abs({}) <= 0.001 THEN 'pass' ELSE 'fail' END"


def _presence_sql(metric: str, columns: list[str]) -> str:
    """Rows ``metric, percent, field, present`` of one presence rule."""
    present = " + ".join(f"(count({c}) > 0)::int" for c in columns)
    share = f"round_even(100.0 * ({present}) / {len(columns)}, 0)::bigint"
    return " UNION ALL ".join(
        f"SELECT '{metric}' AS metric, {share} AS percent, '{c}' AS field, count({c}) > 0 AS present FROM gl"
        for c in columns
    )


_CONTROLS = ["enteredBy", "enteredDateTime", "approvedBy", "approvedDateTime", "lastModifiedBy"]
_REVERSALS = ["reversalIndicator", "reversalJournalId"]
_MANUAL = ["journalEntryType", "sourceId"]


def _presence(df: DataFrame, metric: str) -> DataFrame:
    rules = scorecard(df, "glDetail", sections=["business_rule"]).filter(F.col("metric") == metric)
    exploded = rules.select("metric", F.col("percent").cast("bigint").alias("share"), F.explode("fields").alias("f"))
    return exploded.select(
        "metric", F.col("share").alias("percent"), F.col("f.name").alias("field"), F.col("f.present").alias("present")
    )


for _name, _metric, _columns in (
    ("control_presence", "controlChecks", _CONTROLS),
    ("reversal_presence", "reversals", _REVERSALS),
    ("manual_journal_presence", "manualJournals", _MANUAL),
):
    query(_name, f"WITH {GL_SQL} " + _presence_sql(_metric, _columns))(
        lambda spark, sf_dir, metric=_metric: _presence(general_ledger(spark, sf_dir), metric)
    )


@query(
    "gl_business_rules",
    f"WITH {GL_SQL} SELECT 'netting' AS metric, {_NETTING.format(_money_sum(_SIGNED))} AS outcome FROM gl",
)
def _(spark, sf_dir):
    rules = scorecard(general_ledger(spark, sf_dir), "glDetail", sections=["business_rule"])
    return rules.filter("outcome is not null").select("metric", "outcome")


@query(
    "tb_netting",
    f"WITH {TB_SQL} SELECT 'netting' AS metric, {_NETTING.format(_money_sum('amountEnding'))} AS outcome FROM tb",
)
def _(spark, sf_dir):
    rules = scorecard(trial_balance(spark, sf_dir), "trialBalance", sections=["business_rule"])
    return rules.select("metric", "outcome")


# ---- profile ----------------------------------------------------------------------------------------

_TB_FIELDS = [
    TypedField("glAccountNumber", "integer"),
    TypedField("glAccountName", "string"),
    TypedField("accountGroup", "string"),
    TypedField("businessUnitCode", "string"),
    TypedField("amountEnding", "decimal"),
    TypedField("amountBeginning", "decimal"),
    TypedField("segment01", "string"),
    TypedField("segment02", "string"),
    TypedField("amountEndingLocal", "decimal"),
]


def _fill_sql(fields: list[TypedField]) -> str:
    """CTE with one row per field: its type, place, filled rows and all rows."""
    rows = [
        f"SELECT {i} AS place, '{f.name}' AS field, '{f.data_type}' AS kind, "
        rf"count(CASE WHEN NOT regexp_full_match(cast({f.name} AS varchar), '\s*') THEN 1 END) AS filled, "
        "count(*) AS n FROM tb"
        for i, f in enumerate(fields)
    ]
    return "fill AS (" + " UNION ALL ".join(rows) + ")"


def _share(count: str, total: str) -> str:
    return f"CASE WHEN {total} = 0 THEN 0 ELSE round_even(100.0 * {count} / {total}, 0) END::bigint"


def _profile_row(metric: str, among: str, chosen: str) -> str:
    count = f"count(CASE WHEN {chosen} THEN 1 END)"
    return (
        f"SELECT '{metric}' AS metric, {_share(count, 'count(*)')} AS percent, count(*) AS total, {count} AS count, "
        f"coalesce(string_agg(CASE WHEN {chosen} THEN field END, ',' ORDER BY place), '') AS fields "
        f"FROM fill WHERE {among}"
    )


_PROFILE_ROWS = [
    _profile_row("fieldsFilled", "true", "filled > 0"),
    _profile_row("fieldsEmpty", "true", "filled = 0"),
    _profile_row("textFieldsEmpty", "kind = 'string'", "filled < n"),
    _profile_row("numericFieldsEmpty", "kind IN ('decimal', 'integer', 'number')", "filled < n"),
]


def _profile(spark, sf_dir) -> DataFrame:
    return scorecard(trial_balance(spark, sf_dir), "trialBalance", _TB_FIELDS, sections=["profile"])


@query("profile_fields", f"WITH {TB_SQL}, {_fill_sql(_TB_FIELDS)} " + " UNION ALL ".join(_PROFILE_ROWS))
def _(spark, sf_dir):
    return _profile(spark, sf_dir).filter("metric <> 'missingRecords'").select(
        "metric",
        F.col("percent").cast("bigint").alias("percent"),
        "total",
        "count",
        F.array_join(F.transform("fields", lambda f: f["name"]), ",").alias("fields"),
    )


@query(
    "profile_missing",
    f"""WITH {TB_SQL}, {_fill_sql(_TB_FIELDS)}, s AS (
      SELECT count(CASE WHEN filled > 0 THEN 1 END) AS used,
             count(CASE WHEN filled > 0 AND filled < n THEN 1 END) AS gapped FROM fill)
    SELECT {_share("(used - gapped)", "used")} AS percent, used AS total, gapped AS count, field,
           {_share("filled", "n")} AS field_percent
    FROM s, fill WHERE filled > 0 AND filled < n""",
)
def _(spark, sf_dir):
    found = _profile(spark, sf_dir).filter("metric = 'missingRecords'")
    exploded = found.select("percent", "total", "count", F.explode("fields").alias("f"))
    return exploded.select(
        F.col("percent").cast("bigint").alias("percent"),
        "total",
        "count",
        F.col("f.name").alias("field"),
        F.col("f.percent").cast("bigint").alias("field_percent"),
    )


@query(
    "scorecard",
    f"""WITH {TB_SQL}, {_fill_sql(_TB_FIELDS)},
    stats AS ({_statistics_sql("x AS (SELECT 1)", "tb", {
        "recordCount": "count(*)",
        "fieldCount": "max(9)",
        "amountBeginingSum": f"round({_money_sum('amountBeginning')}, 5)",
        "amountEndingSum": f"round({_money_sum('amountEnding')}, 5)",
        "glAccountCodeCount": _distinct("glAccountNumber"),
        "businessUnitCounts": _distinct("businessUnitCode"),
    })}),
    profile AS ({" UNION ALL ".join(_PROFILE_ROWS)})
    SELECT 'statistical' AS section, metric, value, NULL::varchar AS outcome, NULL::bigint AS percent FROM stats
    UNION ALL SELECT 'business_rule', 'netting', NULL, {_NETTING.format(_money_sum("amountEnding"))}, NULL FROM tb
    UNION ALL SELECT 'profile', metric, NULL, NULL, percent FROM profile
    UNION ALL SELECT 'profile', 'missingRecords', NULL, NULL,
      {_share("count(CASE WHEN filled > 0 AND filled = n THEN 1 END)", "count(CASE WHEN filled > 0 THEN 1 END)")}
      FROM fill""",
)
def tb_scorecard(spark, sf_dir):
    card = scorecard(trial_balance(spark, sf_dir), "trialBalance", _TB_FIELDS)
    return card.select("section", "metric", "value", "outcome", F.col("percent").cast("bigint").alias("percent"))


# ---- order ------------------------------------------------------------------------------------------

_SEQUENCE = "CASE WHEN event_type = 'error' THEN event_id + 1 ELSE event_id END"


@query(
    "sequence_gaps",
    f"""WITH e AS (SELECT event_id, {_SEQUENCE} AS j FROM events),
    d AS (SELECT j, lag(j) OVER (ORDER BY event_id) AS p, row_number() OVER (ORDER BY event_id) AS i FROM e)
    SELECT count(*) AS n, count(CASE WHEN i > 1 AND (j - p) IS DISTINCT FROM 1 THEN 1 END) AS gaps,
      floor(100.0 * (count(*) - count(CASE WHEN i > 1 AND (j - p) IS DISTINCT FROM 1 THEN 1 END)) / count(*))::bigint
        AS percent, false AS complete, NULL::varchar AS warning FROM d""",
)
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events").selectExpr("event_id", f"{_SEQUENCE} AS journalId")
    return sequence_gaps(events, "journalId", "event_id").withColumn("percent", F.col("percent").cast("bigint"))


@query(
    "sequence_not_numeric",
    """SELECT count(*) AS n, NULL::bigint AS gaps, 0::bigint AS percent, false AS complete,
    'JournalId does not appear to be a numeric sequence' AS warning FROM events""",
)
def _(spark, sf_dir):
    found = sequence_gaps(table(spark, sf_dir, "events"), "props", "event_id")
    return found.withColumn("percent", F.col("percent").cast("bigint"))


# Ids of 22 digits that jump by two once in a thousand.
_LONG_IDS = "concat('9007199254740993', lpad(cast(event_id + {} AS {}), 6, '0'))"


@query(
    "sequence_gaps_long_ids",
    f"""WITH e AS (SELECT event_id, CAST({_LONG_IDS.format("event_id // 1000", "varchar")} AS HUGEINT) AS j FROM events),
    d AS (SELECT j - lag(j) OVER (ORDER BY event_id) AS step FROM e)
    SELECT count(*) AS n, count(CASE WHEN step <> 1 THEN 1 END) AS gaps,
      floor(100.0 * (count(*) - count(CASE WHEN step <> 1 THEN 1 END)) / count(*))::bigint AS percent,
      count(CASE WHEN step <> 1 THEN 1 END) = 0 AS complete, NULL::varchar AS warning FROM d""",
)
def _(spark, sf_dir):
    ids = _LONG_IDS.format("event_id div 1000", "string")
    found = sequence_gaps(table(spark, sf_dir, "events").selectExpr("event_id", f"{ids} AS id"), "id", "event_id")
    return found.withColumn("percent", F.col("percent").cast("bigint"))


_SMALL = "gl AS (SELECT l_extendedprice * 1e-7 AS amount, l_returnflag FROM lineitem)"


@query(
    "gl_small_amounts",
    f"WITH {_SMALL} SELECT l_returnflag, round({_money_sum('amount')}, 8)::double AS total FROM gl GROUP BY l_returnflag",
)
def _(spark, sf_dir):
    small = table(spark, sf_dir, "lineitem").selectExpr("l_extendedprice * 1e-7 AS amount", "l_returnflag")
    return small.groupBy("l_returnflag").agg(money_sum(F.col("amount")).cast("double").alias("total"))


# Huge amounts that cancel beside tiny ones that do not, and cells that are no amount.
_HUGE = """SELECT l_orderkey % 5 AS k, unnest([1e27, -1e27, 1e30, -1e30, 9e27, 9e27, -9e27, -9e27]) AS amount, 'D' AS side FROM lineitem
    UNION ALL SELECT l_orderkey % 5, l_linenumber * 1e-7, 'D' FROM lineitem
    UNION ALL SELECT 0, unnest(['Infinity'::double, '-Infinity'::double, 1e300, 'NaN'::double]), 'D' FROM nation"""


@query(
    "gl_huge_amounts",
    f"""WITH h AS ({_HUGE}), t AS (SELECT k, round(sum(CASE WHEN abs(amount) < 1 THEN amount::decimal(38,10) END), 8)::double AS total,
      count(*) FILTER (abs(amount) >= 1e38) AS uncounted FROM h WHERE NOT isnan(amount) GROUP BY k)
    SELECT k, total, total AS any_size, uncounted FROM t""",
)
def _(spark, sf_dir):
    """Sums over amounts of 30 digits and more keep places and neither stop nor skip unseen."""
    lines = table(spark, sf_dir, "lineitem").selectExpr("l_orderkey % 5 AS k", "l_linenumber * 1e-7D AS tiny")
    huge = "array(1e27D, -1e27D, 1e30D, -1e30D, 9e27D, 9e27D, -9e27D, -9e27D)"
    odd = "explode(array(double('Infinity'), double('-Infinity'), 1e300D, double('NaN'))) AS amount"
    amounts = lines.selectExpr("k", f"explode({huge}) AS amount").unionByName(lines.selectExpr("k", "tiny AS amount"))
    amounts = amounts.unionByName(table(spark, sf_dir, "nation").selectExpr("0L AS k", odd))
    sums = amounts.groupBy("k").agg(
        money_sum(F.col("amount")).cast("double").alias("total"),
        F.round(money_total(F.col("amount")), 8).alias("any_size"),
        uncounted_amounts(F.col("amount")).alias("uncounted"),
    )
    return sums


@query(
    "gl_huge_scorecard",
    """SELECT 'amountSum' AS metric, count(*) * 3e36 AS value, '25 amounts are no finite number below 1e38' AS warning FROM region
    UNION ALL SELECT 'netting', NULL, NULL""",
)
def _(spark, sf_dir):
    """A sum beyond every decimal is still shown, and what no sum holds is counted in its warning."""
    entries = table(spark, sf_dir, "region").selectExpr("explode(array(1e36D, 2e36D)) AS amount", "'D' AS amountCreditDebitIndicator")
    odd = table(spark, sf_dir, "nation").selectExpr("double('Infinity') AS amount", "'D' AS amountCreditDebitIndicator")
    rules = scorecard(entries.unionByName(odd), "glDetail", sections=["statistical", "business_rule"])
    return rules.where("metric = 'amountSum' OR (metric = 'netting' AND outcome = 'fail')").select("metric", "value", "warning")


@query(
    "gl_netting_pass",
    f"""WITH gl AS (SELECT l_extendedprice AS amount, unnest(['C', 'D']) AS side FROM lineitem),
    s AS (SELECT {_money_sum("CASE WHEN side = 'C' THEN -amount ELSE amount END")} AS net FROM gl)
    SELECT 'netting' AS metric, CASE WHEN abs(net) <= 0.001 THEN 'pass' ELSE 'fail' END AS outcome FROM s""",
)
def _(spark, sf_dir):
    """Every entry is booked on both sides."""
    both = general_ledger(spark, sf_dir).withColumn(
        "amountCreditDebitIndicator", F.explode(F.array(F.lit("C"), F.lit("D")))
    )
    rules = scorecard(both, "glDetail", sections=["business_rule"])
    return rules.filter("metric = 'netting'").select("metric", "outcome")


@query(
    "tb_zero_clamp",
    f"""WITH tb AS (SELECT unnest([c_acctbal, -c_acctbal + 2e-10]) AS amountEnding FROM customer),
    s AS (SELECT {_money_sum("amountEnding")} AS total FROM tb)
    SELECT 'amountEndingSum' AS metric, (CASE WHEN abs(total) < 0.000001 THEN 0 ELSE round(total, 5) END)::double AS value FROM s""",
)
def _(spark, sf_dir):
    """Balances that cancel but for a rest near zero."""
    sides = F.array(F.col("amountEnding"), -F.col("amountEnding") + F.lit(2e-10))
    rows = _statistics(trial_balance(spark, sf_dir).withColumn("amountEnding", F.explode(sides)), "trialBalance")
    return rows.filter("metric = 'amountEndingSum'").select("metric", "value")


@query(
    "dense_ordinal_sparse",
    """SELECT o_orderkey, row_number() OVER (ORDER BY spread) - 1 AS place FROM (SELECT o_orderkey,
      CASE WHEN o_orderkey % 1000 = 0 THEN o_orderkey * 1000000000 ELSE o_orderkey END AS spread FROM orders)""",
)
def _(spark, sf_dir):
    """Most keys lie close together, a few far out."""
    orders = table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "CASE WHEN o_orderkey % 1000 = 0 THEN o_orderkey * 1000000000 ELSE o_orderkey END AS spread"
    )
    return dense_ordinal(orders, "spread", "place").select("o_orderkey", "place")


_LINES = ", ".join(LINE_ORDER)


@query(
    "journal_line_number",
    f"""SELECT l_orderkey, {_LINES.replace("l_shipdate, ", "")},
    row_number() OVER (PARTITION BY l_orderkey ORDER BY {_LINES}) AS "lineNumber" FROM lineitem""",
)
def _(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_ORDER)
    numbered = journal_line_numbers(lines, "l_orderkey", LINE_ORDER, "lineNumber")
    return numbered.drop("l_shipdate")


@query(
    "journal_line_number_by_user",
    """SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS "lineNumber"
    FROM events""",
)
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "user_id")
    return journal_line_numbers(events, "user_id", ["event_id"], "lineNumber")


@query("dense_ordinal", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey * 7) - 1 AS place FROM orders")
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_orderkey * 7 AS spread")
    return dense_ordinal(orders, "spread", "place").select("o_orderkey", "place")
