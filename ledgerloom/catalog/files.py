"""Sources, sinks and whole jobs: the given tables are written as reports and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import query
from ledgerloom.catalog.tables import GL_SQL, general_ledger, table
from ledgerloom.operators.quality import scorecard
from ledgerloom.plans.analyse import write_steps
from ledgerloom.plans.conform import check_file, map_report
from ledgerloom.runtime import scratch_path
from ledgerloom.sinks.writers import METRIC_ORDER, preview, scorecard_document, write_table
from ledgerloom.sources.groupings import read_grouping_lines, read_groupings
from ledgerloom.sources.reports import read_headed_csv, read_report
from ledgerloom.spec import Condition, FileTemplate, ReportSpec, Step, reports_from_mapping

_FILE = "trialBalance_report.csv"


def _report_rows(spark, sf_dir):
    """Customers as a trial-balance export: names with codes, amounts with currency signs and commas."""
    return table(spark, sf_dir, "customer").selectExpr(
        "concat(c_name, ' & söhne, ', c_mktsegment, ' (', cast(c_custkey AS string), ')') AS `Account`",
        "CASE WHEN c_acctbal < 0 THEN concat('-£', format_number(-c_acctbal, 2))"
        " ELSE concat('£', format_number(c_acctbal, 2)) END AS `YTD Balance`",
        "CASE WHEN c_nationkey = 0 THEN 'NULL' ELSE cast(c_nationkey AS string) END AS `Unit`",
    )


def _written_report(spark, sf_dir, encoding="UTF-8"):
    path = scratch_path(spark, "export")
    _report_rows(spark, sf_dir).write.option("header", True).option("encoding", encoding).csv(path)
    return path


_REPORT_SQL = """r AS (SELECT c_custkey, c_name || ' & söhne, ' || c_mktsegment || ' (' || c_custkey || ')' AS account,
  c_acctbal AS balance, CASE WHEN c_nationkey <> 0 THEN c_nationkey::varchar END AS unit FROM customer)"""


_READ_SQL = f"""WITH {_REPORT_SQL} SELECT account AS "Account", CASE WHEN balance < 0
  THEN '-£' || format('{{:,.2f}}', -balance) ELSE '£' || format('{{:,.2f}}', balance) END AS "YTD Balance",
  unit AS "Unit" FROM r"""


@query("read_latin1_report", _READ_SQL)
def _(spark, sf_dir):
    """No encoding is given: the file does not decode as UTF-8, so every line is read as ISO-8859-1."""
    return read_report(spark, _written_report(spark, sf_dir, "ISO-8859-1"), 1).drop("_ord")


@query(
    "read_multiline_report",
    """SELECT c_custkey::varchar AS code, CASE WHEN c_nationkey = 1
      THEN c_name || chr(10) || 'see "' || c_mktsegment || '"' || chr(10) ELSE c_name END AS name FROM customer""",
)
def _(spark, sf_dir):
    """Cells with line breaks and quote signs."""
    path = scratch_path(spark, "multiline")
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS code",
        r"""CASE WHEN c_nationkey = 1 THEN concat(c_name, '\n', 'see "', c_mktsegment, '"', '\n') ELSE c_name END AS name""",
    )
    write_table(rows, path)
    return read_report(spark, path, 1).drop("_ord")


@query("read_report", _READ_SQL)
def _(spark, sf_dir):
    return read_report(spark, _written_report(spark, sf_dir), 1).drop("_ord")


def _source(field):
    return [{"file_name": _FILE, "field_name": field, "order": 1}]


_MAPPING = {
    "fields": [
        {"map_type": "calculated", "cdm_field": "glAccountNumber", "data_type": "string", "operation": "SGLAN",
         "erp_fields": _source("Account"), "report_type": "trialBalance",
         "extract_split_fields": {"opening_char": "(", "closing_char": ")", "inside_outside": "inside"}},
        {"map_type": "calculated", "cdm_field": "glAccountName", "data_type": "string", "operation": "SGLAN",
         "erp_fields": _source("Account"), "report_type": "trialBalance",
         "extract_split_fields": {"opening_char": "(", "closing_char": ")", "inside_outside": "outside"}},
        {"map_type": "direct", "cdm_field": "amountEnding", "data_type": "decimal",
         "erp_fields": _source("YTD Balance"), "report_type": "trialBalance"},
        {"map_type": "calculated", "cdm_field": "fiscalYear", "data_type": "string", "operation": "FT",
         "erp_fields": [], "free_text": "2023", "report_type": "trialBalance"},
        {"map_type": "direct", "cdm_field": "businessUnitCode", "data_type": "string",
         "erp_fields": _source("Unit"), "report_type": "trialBalance"},
        {"map_type": "dummy", "cdm_field": "period", "data_type": "string", "erp_fields": [],
         "report_type": "trialBalance"},
    ]
}


def _report() -> ReportSpec:
    return reports_from_mapping(_MAPPING, {_FILE: FileTemplate(1)})[0]


@query(
    "conform_report",
    f"""WITH {_REPORT_SQL} SELECT c_custkey::varchar AS "glAccountNumber",
      regexp_replace(account, '\\([0-9]+\\)$', '') AS "glAccountName", balance AS "amountEnding",
      '2023' AS "fiscalYear", coalesce(unit, '') AS "businessUnitCode", NULL::varchar AS period FROM r""",
)
def _(spark, sf_dir):
    report = _report()
    fields = report.file_fields()[_FILE]
    raw = read_report(spark, _written_report(spark, sf_dir), 1)
    return map_report(report, {_FILE: check_file(raw, _FILE, fields, FileTemplate(1))}).canonical()


@query("read_headed_csv", "SELECT p_partkey::varchar AS p_partkey, p_name, p_size::varchar AS p_size FROM part")
def _(spark, sf_dir):
    path = scratch_path(spark, "parts")
    write_table(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"), path)
    return read_headed_csv(spark, path)


@query(
    "write_step_results",
    f"""WITH {GL_SQL} SELECT count(*) AS rows, round(sum(amount), 2) AS amount FROM gl
    WHERE amount > 50000 AND amountCreditDebitIndicator = 'C'""",
)
def _(spark, sf_dir):
    folder = scratch_path(spark, "steps")
    conditions = (Condition("amount", "gt", "50000"), Condition("amountCreditDebitIndicator", "eq", "C"))
    steps = [
        Step("1", "Filter", "", conditions),
        Step("2", "Sum", "1", (Condition("amount"),)),
        Step("3", "Count", "1", (Condition("journalId"),)),
    ]
    write_steps(general_ledger(spark, sf_dir).select("journalId", "amount", "amountCreditDebitIndicator"), steps, folder)
    written = read_headed_csv(spark, f"{folder}/tmp_Filter_1.csv")
    return written.agg(
        F.count(F.lit(1)).alias("rows"), F.round(F.sum(F.col("amount").try_cast("double")), 2).alias("amount")
    )


@query(
    "read_step_results",
    f"""WITH {GL_SQL}, picked AS (SELECT * FROM gl WHERE amount > 50000 AND amountCreditDebitIndicator = 'C')
    SELECT 'sum' AS file, round(sum(amount), 2)::double AS value FROM picked
    UNION ALL SELECT 'sum preview', round(sum(amount), 2) FROM picked
    UNION ALL SELECT 'count', count(DISTINCT journalId) FROM picked
    UNION ALL SELECT 'count preview', count(DISTINCT journalId) FROM picked
    UNION ALL SELECT 'net', round(-sum(amount), 2) FROM picked
    UNION ALL SELECT 'filter preview rows', least(count(*), 10) FROM picked""",
)
def _(spark, sf_dir):
    """Every kind of step result as CSV and as JSON preview, read back."""
    folder = scratch_path(spark, "steps")
    conditions = (Condition("amount", "gt", "50000"), Condition("amountCreditDebitIndicator", "eq", "C"))
    steps = [
        Step("1", "Filter", "", conditions),
        Step("2", "Sum", "1", (Condition("amount"),)),
        Step("3", "Count", "1", (Condition("journalId", unique=True),)),
        Step("4", "Net", "1"),
    ]
    write_steps(general_ledger(spark, sf_dir).select("journalId", "amount", "amountCreditDebitIndicator"), steps, folder)

    def cell(kind: str, order: int, column: str) -> tuple:
        written = read_headed_csv(spark, f"{folder}/tmp_{kind}_{order}.csv")
        shown = spark.read.text(f"{folder}/tmp_{kind}_{order}.json")
        return written.select(F.col(column).alias("value")), shown.select(F.get_json_object("value", f"$.data[0].{column}").alias("value"))

    (total, total_shown), (count, count_shown), (net, _) = cell("Sum", 2, "sum"), cell("Count", 3, "count"), cell("Net", 4, "total_credit_amount")
    first = spark.read.text(f"{folder}/tmp_Filter_1.json")
    rows = first.select(F.size(F.from_json(F.get_json_object("value", "$.data"), "array<string>")).cast("string").alias("value"))
    found = None
    for name, part in (
        ("sum", total), ("sum preview", total_shown), ("count", count), ("count preview", count_shown), ("net", net), ("filter preview rows", rows),
    ):
        one = part.select(F.lit(name).alias("file"), F.round(F.col("value").cast("double"), 2).alias("value"))
        found = one if found is None else found.unionByName(one)
    return found


@query(
    "read_groupings",
    """SELECT n_nationkey::varchar AS "nominalCode", n_name AS description, r_name AS account
    FROM nation JOIN region ON n_regionkey = r_regionkey""",
)
def _(spark, sf_dir):
    """The grouping table as one nested response, written and flattened again."""
    path = scratch_path(spark, "grouping")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    rows = nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "named_struct('nominalCode', cast(n_nationkey AS string), 'description', n_name, 'account', r_name) AS g"
    )
    nested = rows.agg(F.struct(F.struct(F.collect_list("g").alias("grouping")).alias("nominalCodeMappings")).alias("data"))
    nested.write.json(path)
    return read_groupings(spark, path).select("nominalCode", "description", "account")


@query(
    "read_groupings_mixed",
    """SELECT s_suppkey::varchar AS "nominalCode", s_name AS description, n_name AS account,
      CASE WHEN s_nationkey % 2 = 0 THEN trunc(s_acctbal)::int::varchar END AS "accountSubtype" FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def _(spark, sf_dir):
    """Many responses as JSON lines in several files, one per nation, both shapes in one folder."""
    path = scratch_path(spark, "responses")
    suppliers = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    flat = suppliers.where("s_nationkey % 2 = 0").groupBy("s_nationkey").agg(
        F.expr("collect_list(named_struct('nominalCode', s_suppkey, 'description', s_name, 'account', n_name, 'accountSubtype', cast(s_acctbal AS int)))").alias("g")
    )
    nested = suppliers.where("s_nationkey % 2 = 1").groupBy("s_nationkey", (F.col("s_suppkey") % 3).alias("grouper")).agg(
        F.expr("collect_list(named_struct('nominalCode', cast(s_suppkey AS string), 'glAccountName', s_name, 'accountType', n_name, 'grouperId', 1))").alias("g")
    )
    nested = nested.groupBy("s_nationkey").agg(F.expr("collect_list(named_struct('id', grouper, 'grouper', named_struct('groupingCodes', g)))").alias("g"))
    first = flat.selectExpr("to_json(named_struct('data', named_struct('nominalCodeMappings', named_struct('grouping', g)))) AS value")
    second = nested.selectExpr("to_json(named_struct('data', named_struct('getDataIngestionGroupings', g))) AS value")
    first.unionByName(second).repartition(4).write.text(path)
    return read_grouping_lines(spark, path).select("nominalCode", "description", "account", "accountSubtype")


# Events as a report whose cells partly cannot be mapped.
_EVENT_FIELDS = {
    "fields": [
        {"map_type": "date-mask", "cdm_field": "effectiveDate", "data_type": "string", "date_format": "%Y-%m-%d",
         "erp_fields": [{"file_name": "events.csv", "field_name": "day"}], "report_type": "glDetail"},
        {"map_type": "calculated", "cdm_field": "sourceId", "data_type": "string", "operation": "SPLIT",
         "characters": "5", "extra": "tags",
         "erp_fields": [{"file_name": "events.csv", "field_name": "kind"}], "report_type": "glDetail"},
        {"map_type": "dummy", "cdm_field": "tags", "data_type": "string", "erp_fields": [], "report_type": "glDetail"},
        {"map_type": "calculated", "cdm_field": "journalIdLineNumber", "data_type": "string",
         "operation": "Journal Line Number",
         "erp_fields": [{"file_name": "events.csv", "field_name": "user"}], "report_type": "glDetail"},
        {"map_type": "direct", "cdm_field": "journalId", "data_type": "string",
         "erp_fields": [{"file_name": "events.csv", "field_name": "user"}], "report_type": "glDetail"},
    ]
}
_DAY = "CASE WHEN user_id % 7 = 0 THEN 'no day' WHEN user_id % 7 = 1 THEN '' ELSE {day} END"


def _mapped_events(spark, sf_dir):
    path = scratch_path(spark, "events")
    day = _DAY.format(day="date_format(ts, 'yyyy-MM-dd')")
    # Line numbers of the report follow the order of the events.
    events = table(spark, sf_dir, "events").orderBy("event_id")
    rows = events.selectExpr(f"{day} AS day", "event_type AS kind", "user_id AS user")
    write_table(rows, path)
    report = reports_from_mapping(_EVENT_FIELDS)[0]
    fields = report.file_fields()["events.csv"]
    return map_report(report, {"events.csv": check_file(read_report(spark, path), "events.csv", fields, FileTemplate())})


@query(
    "conform_errors",
    """SELECT 'glDetail' AS report_name, 'effectiveDate' AS cdm_field, 'events.csv' AS file_name, 'day' AS field_name,
      event_id + 1 AS data_row, 'The value no day is not in the proper Date Format' AS error
    FROM events WHERE user_id % 7 = 0
    UNION ALL SELECT 'glDetail', 'sourceId', 'events.csv', 'kind', event_id + 1,
      'Could not split the value ' || event_type || ' for 5 characters' FROM events WHERE length(event_type) < 5""",
)
def _(spark, sf_dir):
    return _mapped_events(spark, sf_dir).errors


@query(
    "conform_ledger",
    f"""SELECT strftime(try_strptime({_DAY.format(day="strftime(ts, '%Y-%m-%d')")}, '%Y-%m-%d'), '%Y-%m-%dT%H:%M:%SZ')
        AS "effectiveDate",
      event_type[1:5] AS "sourceId", CASE WHEN length(event_type) >= 5 THEN event_type[6:] END AS tags,
      row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS "journalIdLineNumber",
      user_id::varchar AS "journalId" FROM events""",
)
def _(spark, sf_dir):
    return _mapped_events(spark, sf_dir).canonical()


@query(
    "preview_json",
    """SELECT '{"data": [' || string_agg('{"o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority
      || '"}', ', ' ORDER BY o_orderkey) || ']}' AS value
    FROM (SELECT * FROM orders ORDER BY o_orderkey LIMIT 10)""",
)
def _(spark, sf_dir):
    """A preview holds the first ten rows; the limit is the feature."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", F.col("o_orderkey").alias("_ord"))
    return preview(orders, order_by="_ord")


@query(
    "scorecard_document",
    f"""WITH {GL_SQL} SELECT count(*)::double AS records, count(DISTINCT glAccountNumber)::double AS codes,
      'fail' AS netting, 40.0::double AS controls, 16::bigint AS fields FROM gl""",
)
def _(spark, sf_dir):
    """Values picked out of the scorecard's JSON text."""
    document = scorecard_document(scorecard(general_ledger(spark, sf_dir), "glDetail"), METRIC_ORDER)
    paths = {
        "records": ("statistical[0].recordCount", "double"),
        "codes": ("statistical[5].glAccountCodeCount", "double"),
        "netting": ("business_rule[0].netting", "string"),
        "controls": ("business_rule[1].controlChecks.overall", "double"),
        "fields": ("profile[0].fieldsFilled.total", "bigint"),
    }
    return document.select(
        *[F.get_json_object("value", f"$.glDetail.{path}").cast(kind).alias(name) for name, (path, kind) in paths.items()]
    )


@query(
    "scorecard_names",
    r"""SELECT name, filled FROM (SELECT unnest([{'name': 'a"b', 'filled': count(p_size)}, {'name': 'back\slash', 'filled': count(p_name)},
      {'name': 'two' || chr(10) || 'lines', 'filled': count(p_brand)}, {'name': 'glAccountNumber', 'filled': count(p_partkey)}], recursive := true) FROM part)
      WHERE filled > 0""",
)
def _(spark, sf_dir):
    """Field names with signs that JSON escapes, picked out of the scorecard's text."""
    parts = table(spark, sf_dir, "part").select(
        F.col("p_size").alias('a"b'), F.col("p_name").alias("back\\slash"), F.col("p_brand").alias("two\nlines"), F.col("p_partkey").alias("glAccountNumber")
    )
    document = scorecard_document(scorecard(parts, "ChartOfAccounts"), METRIC_ORDER)
    listed = F.from_json(F.get_json_object("value", "$.ChartOfAccounts.profile[0].fieldsFilled.fields"), "array<string>")
    names = document.select(F.explode(listed).alias("name"))
    counts = parts.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in parts.columns]).selectExpr("explode(map(" + ", ".join(
        f"'{k}', `{c}`" for k, c in zip("1234", parts.columns)) + ")) AS (k, filled)")
    order = F.array(*[F.lit(c) for c in parts.columns])
    return names.join(counts, F.array_position(order, names["name"]) == counts["k"].cast("int")).select("name", "filled")
