"""Cleaning of raw rows and type validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import query
from ledgerloom.catalog.tables import MESSY_LINES_SQL, PARSED_SQL, messy_lines, table
from ledgerloom.operators import clean, validate
from ledgerloom.operators.ordinals import dense_ordinal
from ledgerloom.runtime import durable
from ledgerloom.spec import Exclusion, ExclusionRule, TypedField

# Event rows as a raw report: null tokens, blanks, and rows without any value.
_RAW = [
    "event_id AS _ord",
    "CASE event_type WHEN 'error' THEN 'NULL' WHEN 'view' THEN ' ' ELSE event_type END AS kind",
    "CASE WHEN event_type = 'error' THEN 'n/a' WHEN value < 5 THEN 'BLANK' ELSE cast(value AS {t}) END AS amount",
    "CASE WHEN event_type IN ('error', 'view') THEN '' ELSE 'Null' END AS note",
]
_RAW_SQL = "raw AS (SELECT " + ", ".join(c.format(t="varchar") for c in _RAW) + " FROM events)"
_TOKENS_SQL = ", ".join(f"'{t}'" for t in clean.NULL_TOKENS)


def _token_sql(column: str) -> str:
    return f"CASE WHEN {column} NOT IN ({_TOKENS_SQL}) THEN {column} END AS {column}"


_CLEAN_SQL = f"{_RAW_SQL}, cleaned AS (SELECT _ord, {', '.join(map(_token_sql, ('kind', 'amount', 'note')))} FROM raw)"
_KEEP = ["_ord"]


def _raw(spark, sf_dir):
    return table(spark, sf_dir, "events").selectExpr(*[c.format(t="string") for c in _RAW])


def _cleaned(spark, sf_dir):
    return clean.null_tokens_to_null(_raw(spark, sf_dir), _KEEP)


@query("null_tokens", f"WITH {_CLEAN_SQL} SELECT * FROM cleaned")
def _(spark, sf_dir):
    return _cleaned(spark, sf_dir)


@query(
    "drop_all_null",
    f"WITH {_CLEAN_SQL} SELECT * FROM cleaned WHERE kind IS NOT NULL OR amount IS NOT NULL OR note IS NOT NULL",
)
def _(spark, sf_dir):
    return clean.drop_all_null(_cleaned(spark, sf_dir), _KEEP)


@query("prune_columns", f"WITH {_CLEAN_SQL} SELECT _ord, note FROM cleaned WHERE note IS NOT NULL")
def _(spark, sf_dir):
    return clean.prune(_cleaned(spark, sf_dir), ["note"], _KEEP)


def _exclusion(name, rules, aggr, sql):
    @query(name, f"WITH {_CLEAN_SQL} SELECT * FROM cleaned WHERE NOT ({sql})")
    def build(spark, sf_dir):
        exclusion = Exclusion(tuple(ExclusionRule(*r) for r in rules), aggr)
        return clean.exclude_rows(_cleaned(spark, sf_dir), exclusion, _KEEP)


_CLICK = "contains(lower(coalesce(kind, 'nan')), 'click')"
_exclusion("exclude_contains", [(1, "CLICK")], "and", _CLICK)
# A null cell takes part as the text "nan".
_exclusion("exclude_contains_nan", [(1, "An")], "or", "contains(lower(coalesce(kind, 'nan')), 'an')")
_exclusion("exclude_null", [(2, "NULL")], "or", "amount IS NULL")
_exclusion("exclude_not_null", [(2, "NOT_NULL")], "or", "amount IS NOT NULL")
_exclusion("exclude_or", [(1, "click"), (2, "NULL")], "or", f"{_CLICK} OR amount IS NULL")
_exclusion("exclude_and", [(1, "click"), (2, "NULL")], "and", f"{_CLICK} AND amount IS NULL")
_exclusion("exclude_unknown_aggr", [(1, "click"), (2, "NULL")], "xor", "false")


@query(
    "drop_total_row",
    """WITH t AS (SELECT event_id AS _ord, CASE WHEN event_id = (SELECT max(event_id) FROM events)
      OR event_type = 'error' THEN 'Grand TOTAL' ELSE event_type END AS account, value FROM events)
    SELECT * FROM t WHERE _ord < (SELECT max(_ord) FROM t)""",
)
def _(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    last = events.agg(F.max("event_id")).scalar()
    is_total = (F.col("event_id") == last) | (F.col("event_type") == "error")
    report = events.select(
        F.col("event_id").alias("_ord"),
        F.when(is_total, "Grand TOTAL").otherwise(F.col("event_type")).alias("account"),
        "value",
    )
    return clean.drop_trailing_total(report, "_ord")


# ---- validation -------------------------------------------------------------------------------------

_KEYS = ["l_orderkey", "l_linenumber"]
_NUMBER_SQL = PARSED_SQL.format("amount_text")


def _check(name, column, data_type, value_sql, valid_sql):
    @query(name, f"WITH {MESSY_LINES_SQL} SELECT l_orderkey, l_linenumber, {value_sql} AS value, {valid_sql} AS valid FROM messy")
    def build(spark, sf_dir):
        value, valid = validate.checked(F.col(column), data_type)
        return messy_lines(spark, sf_dir).select(*_KEYS, value.alias("value"), valid.alias("valid"))


_check("currency_check", "amount_text", "decimal", _NUMBER_SQL, f"(amount_text IS NULL OR ({_NUMBER_SQL}) IS NOT NULL)")
_check("string_check", "amount_text", "string", "coalesce(nullif(amount_text, 'nan'), '')", "true")
_BOOL = "coalesce(lower(flag_text) IN ('true', 'false'), false)"
_check("bool_check", "flag_text", "boolean", f"CASE WHEN {_BOOL} THEN lower(flag_text) = 'true' END", _BOOL)
_DATE = (
    "(date_text IS NULL OR try_strptime(date_text, "
    "['%Y-%m-%d', '%d/%m/%Y', '%d %b %Y', '%d-%b-%y']) IS NOT NULL)"
)
_check("date_check", "date_text", "date", "coalesce(date_text, '')", _DATE)
_check("unknown_type_check", "flag_text", "colour", "flag_text", "false")


# Order dates as people write them: each form for Spark, for the check, and whether it is a date.
_WRITTEN = [
    ("concat(date_format(d, 'yyyyMMdd'), 'T101112')", "strftime(d, '%Y%m%dT101112')", "true"),
    ("concat(date_format(d, 'yyyyMMdd'), '101112')", "strftime(d, '%Y%m%d101112')", "true"),
    ("date_format(d, 'MMM d')", "strftime(d, '%b %-d')", "true"),
    ("date_format(d, \"d'th' MMMM yyyy\")", "strftime(d, '%-dth %B %Y')", "true"),
    ("date_format(d, \"d MMMM yyyy 'at' 10:00\")", "strftime(d, '%-d %B %Y at 10:00')", "true"),
    ("date_format(d, \"yyyy-MM-dd 10:30 'EST'\")", "strftime(d, '%Y-%m-%d 10:30 EST')", "true"),
    ("'10:30'", "'10:30'", "true"),
    ("date_format(d, 'M/d')", "strftime(d, '%-m/%-d')", "true"),
    ("date_format(d, \"EEEE, d MMM yyyy 10 'pm'\")", "strftime(d, '%A, %-d %b %Y 10 pm')", "true"),
    ("date_format(d, \"'29 February' yyyy 'at' 9:15\")", "strftime(d, '29 February %Y at 9:15')", "month(last_day(make_date(year(d), 2, 1))) = 2 AND day(last_day(make_date(year(d), 2, 1))) = 29"),
    ("date_format(d, \"'31 April' yyyy\")", "strftime(d, '31 April %Y')", "false"),
    ("date_format(d, \"yyyy'0230T101112'\")", "strftime(d, '%Y0230T101112')", "false"),
    ("date_format(d, 'MMM d 25:00')", "strftime(d, '%b %-d 25:00')", "false"),
    ("date_format(d, \"d'th of nowhere'\")", "strftime(d, '%-dth of nowhere')", "false"),
    ("'Feb 30'", "'Feb 30'", "false"),
    ("'13/32'", "'13/32'", "false"),
    ("'10:30 EST EST'", "'10:30 EST EST'", "false"),
]


def _written(form: int) -> str:
    cases = " ".join(f"WHEN {k} THEN {w[form]}" for k, w in enumerate(_WRITTEN))
    return f"CASE o_orderkey % {len(_WRITTEN)} {cases} END"


@query(
    "date_check_forms",
    f"""WITH t AS (SELECT o_orderkey, o_orderdate AS d FROM orders)
    SELECT o_orderkey, {_written(1)} AS value, {_written(2)} AS valid FROM t""",
)
def _(spark, sf_dir):
    """Written dates of many forms, and text that only looks like dates."""
    rows = table(spark, sf_dir, "orders").selectExpr("o_orderkey", "o_orderdate AS d").selectExpr("o_orderkey", f"{_written(0)} AS text")
    value, valid = validate.checked(F.col("text"), "date")
    return rows.select("o_orderkey", value.alias("value"), valid.alias("valid"))


@query(
    "number_check",
    f"""WITH t AS (SELECT event_id, CASE WHEN user_id % 3 = 0 THEN cast(user_id AS varchar)
      WHEN event_type = 'click' THEN cast(value AS varchar) ELSE event_type END AS text FROM events)
    SELECT event_id, {PARSED_SQL.format("text")} AS value FROM t""",
)
def _(spark, sf_dir):
    text = F.expr(
        "CASE WHEN user_id % 3 = 0 THEN cast(user_id AS string)"
        " WHEN event_type = 'click' THEN cast(value AS string) ELSE event_type END"
    )
    value, _ = validate.checked(F.col("text"), "number")
    rows = table(spark, sf_dir, "events").select("event_id", text.alias("text"))
    return rows.select("event_id", value.alias("value"))


_FIELDS = (
    TypedField("amount_text", "decimal"),
    TypedField("flag_text", "boolean"),
    TypedField("date_text", "date"),
)
_BAD_AMOUNT = f"(amount_text IS NOT NULL AND ({_NUMBER_SQL}) IS NULL)"
_MARKS_SQL = f"""marks AS (SELECT *, concat_ws('|', CASE WHEN {_BAD_AMOUNT} THEN 'amount_text (decimal)' END,
  CASE WHEN NOT {_BOOL} THEN 'flag_text (boolean)' END,
  CASE WHEN NOT {_DATE} THEN 'date_text (date)' END) AS field_name FROM messy)"""


def _validated(spark, sf_dir, keep=("l_orderkey", "l_linenumber", "l_suppkey")):
    return validate.validate(messy_lines(spark, sf_dir), _FIELDS, keep)


@query(
    "bad_rows",
    f"WITH {MESSY_LINES_SQL}, {_MARKS_SQL} SELECT l_orderkey, l_linenumber, field_name FROM marks WHERE field_name <> ''",
)
def _(spark, sf_dir):
    return validate.bad_rows(_validated(spark, sf_dir), _FIELDS, _KEYS)


@query(
    "valid_rows",
    f"""WITH {MESSY_LINES_SQL}, {_MARKS_SQL} SELECT l_orderkey, l_linenumber, {_NUMBER_SQL} AS amount_text,
    lower(flag_text) = 'true' AS flag_text, coalesce(date_text, '') AS date_text FROM marks WHERE field_name = ''""",
)
def _(spark, sf_dir):
    return validate.valid_rows(_validated(spark, sf_dir), _FIELDS, _KEYS)


_EVENT_FIELDS = (TypedField("kind", "boolean"), TypedField("amount", "decimal"), TypedField("note", "integer"))
_KEPT_EVENTS_SQL = f"""{_CLEAN_SQL}, kept AS (SELECT *, row_number() OVER (ORDER BY _ord) AS data_row FROM cleaned
  WHERE kind IS NOT NULL OR amount IS NOT NULL OR note IS NOT NULL)"""
_EVENT_ERRORS_SQL = f"""WITH {_KEPT_EVENTS_SQL}, marks AS (SELECT data_row, concat_ws('|', 'kind (boolean)',
    CASE WHEN amount IS NOT NULL AND ({PARSED_SQL.format("amount")}) IS NULL THEN 'amount (decimal)' END,
    CASE WHEN note IS NOT NULL AND ({PARSED_SQL.format("note")}) IS NULL THEN 'note (integer)' END) AS field_name FROM kept)
  SELECT 'events' AS report_name, NULL::varchar AS cdm_field, 'events.csv' AS file_name, field_name, data_row,
    'Invalid Data Type' AS error FROM marks"""


def _event_errors(spark, sf_dir):
    kept = clean.drop_all_null(_cleaned(spark, sf_dir), _KEEP)
    checked = validate.validate(kept, _EVENT_FIELDS, _KEEP)
    return validate.type_errors(checked, _EVENT_FIELDS, "events", "events.csv", "_ord")


@query("type_errors", _EVENT_ERRORS_SQL)
def _(spark, sf_dir):
    return _event_errors(spark, sf_dir)


@query(
    "error_sort",
    f"""WITH e AS ({_EVENT_ERRORS_SQL} UNION ALL
      SELECT 'nations', 'name', 'nations.csv', n_name, n_nationkey, 'Using fields of different input files' FROM nation)
    SELECT *, row_number() OVER (ORDER BY report_name, data_row) AS place FROM e""",
)
def _(spark, sf_dir):
    nations = table(spark, sf_dir, "nation").select(
        F.lit("nations").alias("report_name"),
        F.lit("name").alias("cdm_field"),
        F.lit("nations.csv").alias("file_name"),
        F.col("n_name").alias("field_name"),
        F.col("n_nationkey").cast("bigint").alias("data_row"),
        F.lit("Using fields of different input files").alias("error"),
    )
    ordered = validate.sorted_errors(_event_errors(spark, sf_dir), nations)
    return _placed(ordered)


def _placed(ordered):
    """Adds each row's place in a sorted table."""
    stored = durable(ordered.withColumn("_at", F.monotonically_increasing_id()))
    return dense_ordinal(stored, "_at", "place", start=1).drop("_at")


@query(
    "report_gate",
    f"""WITH {MESSY_LINES_SQL}, bad AS (SELECT DISTINCT l_orderkey FROM messy WHERE {_BAD_AMOUNT})
    SELECT l_orderkey, l_linenumber, amount_text FROM messy
    WHERE l_orderkey NOT IN (SELECT l_orderkey FROM bad)""",
)
def _(spark, sf_dir):
    rows = messy_lines(spark, sf_dir).select("l_orderkey", "l_linenumber", "amount_text")
    _, valid = validate.checked(F.col("amount_text"), "decimal")
    return validate.passing_reports(rows, rows.filter(~valid), "l_orderkey")
