"""Mapping operators, each compiled from a mapping row."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import query
from ledgerloom.catalog.tables import MESSY_LINES_SQL, PARSED_SQL, messy_lines, table
from ledgerloom.functions import codes
from ledgerloom.functions.indicators import indicator_by_rule
from ledgerloom.functions.numbers import parse_number
from ledgerloom.operators.align import align_by_position
from ledgerloom.operators.clean import project
from ledgerloom.operators.mapping import compile_row
from ledgerloom.operators.ranges import lookup_range, stretches
from ledgerloom.spec import AccountRange, CodeSplit, MappingRow, SourceField

_LINE_KEYS = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def _row(operation, *fields, map_type="calculated", data_type="string", **options) -> MappingRow:
    sources = tuple(SourceField("f.csv", name, i + 1) for i, name in enumerate(fields))
    return MappingRow(map_type, "value", "report", data_type, sources, operation, **options)


def _mapped(df, row, kinds, keys):
    """Key columns, the value and, where the operator can fail, the error text."""
    columns = [F.col(k) for k in keys]
    for mapped in compile_row(row, kinds):
        columns.append(mapped.value.alias(mapped.target))
        if mapped.error is not None:
            columns.append(mapped.error.alias("error"))
    return df.select(*columns)


# ---- numbers ----------------------------------------------------------------------------------------

# Line items with typed numbers, some of them missing.
_NUMBERS = [
    "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
    "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice * (CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END)"
    " END AS amount",
    "CASE WHEN l_linenumber = 6 THEN NULL ELSE l_quantity END AS quantity",
    "l_discount AS discount",
    "cast(l_partkey AS double) AS account",
]
_NUMBERS_SQL = "t AS (SELECT " + ", ".join(_NUMBERS) + " FROM lineitem)"
_NUMBER_KINDS = {n: "decimal" for n in ("amount", "quantity", "discount", "account")}
_KEYS_SQL = ", ".join(_LINE_KEYS)


def _numbers(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").selectExpr(*_NUMBERS)


def _number_query(name, row, value_sql, error_sql=None):
    error = f", {error_sql} AS error" if error_sql else ""

    @query(name, f"WITH {_NUMBERS_SQL} SELECT {_KEYS_SQL}, {value_sql} AS value{error} FROM t")
    def build(spark, sf_dir):
        return _mapped(_numbers(spark, sf_dir), row, _NUMBER_KINDS, _LINE_KEYS)


_AMOUNT, _QUANTITY = "coalesce(amount, 0)", "coalesce(quantity, 0)"
_number_query("map_sum", _row("SUM", "amount", "quantity", "discount"), f"{_AMOUNT} + {_QUANTITY} + discount", "NULL::varchar")
_number_query("map_diff", _row("DIFF", "amount", "quantity"), f"{_AMOUNT} - {_QUANTITY}", "NULL::varchar")
_number_query("map_prod", _row("PROD", "amount", "quantity"), f"{_AMOUNT} * {_QUANTITY}", "NULL::varchar")
_number_query("map_dc", _row("DC", "amount", "quantity"), f"{_AMOUNT} + {_QUANTITY}")
_number_query("map_abs", _row("ABS", "amount"), "abs(amount)")
_number_query(
    "map_div",
    _row("DIV", "amount", "discount"),
    "CASE WHEN discount <> 0 THEN amount / discount END",
    "CASE WHEN discount = 0 AND amount IS NOT NULL THEN "
    "'Could not divide the value ' || cast(amount AS varchar) || ' by 0.0' END",
)
_number_query(
    "map_dci1", _row("DCI1", "amount"), "CASE WHEN amount >= 0 THEN 'D' ELSE 'C' END", "NULL::varchar"
)
_number_query(
    "map_dci2",
    _row("DCI2", "amount", "quantity"),
    f"CASE WHEN {_AMOUNT} > {_QUANTITY} THEN 'D' ELSE 'C' END",
    "NULL::varchar",
)
_number_query(
    "map_formula",
    _row("MC", "amount", "quantity", expression="(<1> - <2>) ^ 2 / 700 + <1> / 3"),
    f"round_even(power({_AMOUNT} - {_QUANTITY}, 2) / 700 + {_AMOUNT} / 3, 4)",
    "NULL::varchar",
)
_number_query("map_integer", _row(None, "amount", map_type="direct", data_type="integer"), "trunc(amount)::bigint")
_number_query("map_decimal", _row(None, "amount", map_type="direct", data_type="decimal"), "amount")
_number_query("map_dummy", _row(None, map_type="dummy"), "NULL::varchar")
_number_query("map_free_text", _row("FT", free_text="2023"), "'2023'")

# Overlapping account ranges: the last one that covers an account decides.
_RANGES = (
    AccountRange(0, 400, "Debit"),
    AccountRange(300, 900, "Credit"),
    AccountRange(500, 500, "Debit"),
    AccountRange(1200, 1600, "Credit"),
    AccountRange(1300, 1310, "Other"),
)
_RULE_SQL = """CASE WHEN account BETWEEN 1200 AND 1600 THEN 'Credit' WHEN account = 500 THEN 'Debit'
  WHEN account BETWEEN 300 AND 900 THEN 'Credit' WHEN account BETWEEN 0 AND 400 THEN 'Debit' END"""
_number_query(
    "map_dci3",
    _row("DCI3", "account", "amount", ranges=_RANGES),
    f"""CASE {_RULE_SQL} WHEN 'Debit' THEN CASE WHEN amount < 0 THEN 'D' ELSE 'C' END
      WHEN 'Credit' THEN CASE WHEN amount < 0 THEN 'C' ELSE 'D' END END""",
    f"""CASE WHEN {_RULE_SQL} IS NULL THEN
      'Could not determine DC Indicator. Reference not in range | Data: A/C No - ' || cast(account AS varchar)
      || ', Amount - ' || coalesce(cast(amount AS varchar), 'nan') END""",
)

# One range per part, most overlapping others; only some rules count.
_PART_RANGES = [
    "p_partkey AS position",
    "cast(p_partkey - p_size % 7 AS double) AS low",
    "cast(p_partkey + p_size * (CASE WHEN p_partkey % 50 = 0 THEN 20 ELSE 1 END) AS double) AS high",
    "CASE p_partkey % 5 WHEN 0 THEN 'Other' WHEN 1 THEN 'Credit' WHEN 2 THEN 'Credit' ELSE 'Debit' END AS negatives",
]


@query(
    "map_dci3_many_ranges",
    f"""WITH t AS (SELECT {_KEYS_SQL}, l_partkey + (CASE WHEN l_linenumber > 4 THEN 0.5 ELSE 0 END) AS account,
        CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS amount FROM lineitem),
      r AS (SELECT {", ".join(_PART_RANGES)} FROM part WHERE p_size < 20),
      best AS (SELECT account, arg_max(negatives, position) AS rule FROM (SELECT DISTINCT account FROM t) JOIN r
        ON account BETWEEN low AND high WHERE negatives IN ('Debit', 'Credit') GROUP BY account)
    SELECT {_KEYS_SQL}, CASE rule WHEN 'Debit' THEN CASE WHEN amount < 0 THEN 'D' ELSE 'C' END
      WHEN 'Credit' THEN CASE WHEN amount < 0 THEN 'C' ELSE 'D' END END AS value FROM t LEFT JOIN best USING (account)""",
)
def _(spark, sf_dir):
    """Range rules held in a table of their own."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        *_LINE_KEYS,
        "l_partkey + (CASE WHEN l_linenumber > 4 THEN 0.5D ELSE 0D END) AS account",
        "CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END AS amount",
    )
    ranges = table(spark, sf_dir, "part").where("p_size < 20").selectExpr(*_PART_RANGES)
    rules = stretches(ranges.where("negatives IN ('Debit', 'Credit')"), "low", "high", "position", "negatives")
    ruled = lookup_range(lines, "account", rules, "rule")
    return ruled.select(*_LINE_KEYS, indicator_by_rule(F.col("rule"), F.col("amount")).alias("value"))


# ---- text -------------------------------------------------------------------------------------------


def _text_query(name, source, columns, row, value_sql, error_sql=None, extra=None):
    """``columns`` build the text fields from a given table; its first one is the key."""
    spark_columns = [c.format(t="string") for c in columns]
    cte = f"t AS (SELECT {', '.join(c.format(t='varchar') for c in columns)} FROM {source})"
    key = columns[0].split(" AS ")[-1]
    more = f", {extra}" if extra else ""
    more += f", {error_sql} AS error" if error_sql else ""

    @query(name, f"WITH {cte} SELECT {key}, {value_sql} AS value{more} FROM t")
    def build(spark, sf_dir):
        rows = table(spark, sf_dir, source).selectExpr(*spark_columns)
        return _mapped(rows, row, {}, [key])


_NAME = ["p_partkey", "CASE WHEN p_size = 1 THEN '' WHEN p_size = 2 THEN 'ab' ELSE p_name END AS name", "p_type"]
_SHORT = "length(name) BETWEEN 1 AND 3"
_SPLIT_ERROR = f"CASE WHEN {_SHORT} THEN 'Could not split the value ' || name || ' for 4 characters' END"
_text_query("map_direct", "part", _NAME, _row(None, "name", map_type="direct"), "name")
_text_query("map_split", "part", _NAME, _row("SPLIT", "name", characters=4), "name[1:4]", _SPLIT_ERROR)
_text_query(
    "map_split_extra",
    "part",
    _NAME,
    _row("SPLIT", "name", characters=4, extra="rest"),
    "name[1:4]",
    _SPLIT_ERROR,
    f"CASE WHEN NOT ({_SHORT}) THEN name[5:] END AS rest",
)
_text_query(
    "map_concat",
    "part",
    ["p_partkey", "p_brand", "CASE WHEN p_size > 10 THEN p_type END AS kind", "p_name"],
    _row("CONCAT", "p_brand", "kind", "p_name"),
    "p_brand || '-' || coalesce(kind, '') || '-' || p_name",
)
_text_query(
    "map_coalesce",
    "part",
    ["p_partkey", "CASE WHEN p_size > 10 THEN p_type END AS kind", "p_name"],
    _row("CS", "kind", "p_name"),
    "coalesce(kind, p_name)",
)
_DATE = (
    "CASE p_partkey % 5 WHEN 0 THEN concat(cast(1 + p_size % 28 AS {t}), '-Nov-', cast(20 + p_size AS {t}))"
    " WHEN 1 THEN '07-feb-99' WHEN 2 THEN '30-Feb-20' WHEN 3 THEN '' END AS day"
)
_text_query(
    "map_date_mask",
    "part",
    ["p_partkey", _DATE, "p_size"],
    _row(None, "day", map_type="date-mask", date_format="%d-%b-%y"),
    "strftime(try_strptime(nullif(day, ''), '%d-%b-%y'), '%Y-%m-%dT%H:%M:%SZ')",
    "CASE WHEN day <> '' AND try_strptime(day, '%d-%b-%y') IS NULL "
    "THEN 'The value ' || day || ' is not in the proper Date Format' END",
)

# Weekday, month name, fraction and zone beside the date; every fifth cell lacks its weekday.
_LONG_DATE = [
    "p_partkey",
    "CASE p_partkey % 5 WHEN 0 THEN '7 March 2021 10:20:30.25 +0100' WHEN 1 THEN 'Sunday, 7 March 2021 10:20:30.25 +0100'"
    " WHEN 2 THEN concat('Fri, ', 1 + p_size % 28, ' Jan 2021 03:04:05.000001 Z') WHEN 3 THEN ''"
    " ELSE concat('Monday, ', 1 + p_size % 40, ' April 1998 23:59:59.9 -03:30') END AS day",
    "p_size",
]
_LONG_VALUE = """CASE p_partkey % 5 WHEN 1 THEN '2021-03-07T10:20:30Z'
    WHEN 4 THEN CASE WHEN p_size % 40 < 30 THEN '1998-04-' || printf('%02d', 1 + p_size % 40) || 'T23:59:59Z' END END"""
_text_query(
    "map_date_mask_codes",
    "part",
    _LONG_DATE,
    _row(None, "day", map_type="date-mask", date_format="%A, %d %B %Y %H:%M:%S.%f %z"),
    _LONG_VALUE,
    f"CASE WHEN day <> '' AND ({_LONG_VALUE}) IS NULL THEN 'The value ' || day || ' is not in the proper Date Format' END",
)
_text_query(
    "map_date_mask_unknown",
    "part",
    _LONG_DATE,
    _row(None, "day", map_type="date-mask", date_format="%Q %d"),
    "NULL::varchar",
    "CASE WHEN day <> '' THEN 'The value ' || day || ' is not in the proper Date Format' END",
)

# Account names with codes in the forms exports use.
_ACCOUNT = [
    "p_partkey",
    "CASE p_partkey % 6 WHEN 0 THEN concat(p_name, ' (', cast(p_size AS {t}), ')')"
    " WHEN 1 THEN concat(p_name, ' - ', p_type, ' (', cast(p_size AS {t}), ')')"
    " WHEN 2 THEN concat(p_name, ' (', cast(p_size AS {t}), ') (abc)')"
    " WHEN 3 THEN concat(p_name, ' (', p_type, ')') WHEN 4 THEN p_name"
    " ELSE concat(cast(p_size AS {t}), ' - ', p_name, ' - ', p_type) END AS account",
    "p_size", "p_name", "p_type",
]
_PARENTHESES = CodeSplit("(", ")", "inside")
_text_query(
    "map_code_inside",
    "part",
    _ACCOUNT,
    _row("SGLAN", "account", code_split=_PARENTHESES),
    """CASE p_partkey % 6 WHEN 0 THEN cast(p_size AS varchar)
      WHEN 1 THEN ' ' || p_type || ' (' || cast(p_size AS varchar) || ')'
      WHEN 2 THEN cast(p_size AS varchar) || ' ' WHEN 3 THEN p_name || ' ' END""",
)
_text_query(
    "map_code_outside",
    "part",
    _ACCOUNT,
    _row("SGLAN", "account", code_split=CodeSplit("(", ")", "outside")),
    """CASE p_partkey % 6 WHEN 0 THEN p_name || ' ' WHEN 1 THEN p_name || ' - ' || p_type || ' '
      WHEN 2 THEN p_name || '  (abc)' WHEN 3 THEN account END""",
)


@query(
    "map_numeric_pieces",
    """SELECT p_partkey, CASE WHEN p_partkey % 6 = 5 THEN cast(p_size AS varchar)
      WHEN p_partkey % 6 = 1 THEN '' END AS pieces FROM part""",
)
def _(spark, sf_dir):
    accounts = table(spark, sf_dir, "part").selectExpr(*[c.format(t="string") for c in _ACCOUNT])
    found = codes.numeric_pieces(F.col("account"), "-")
    return accounts.select("p_partkey", F.array_join(found, "|").alias("pieces"))


@query(
    "map_trim_name",
    """SELECT c_custkey, CASE c_nationkey % 3 WHEN 0 THEN c_name WHEN 1 THEN c_name ELSE ' ' || c_name END AS name
    FROM customer""",
)
def _(spark, sf_dir):
    raw = F.expr(
        "CASE c_nationkey % 3 WHEN 0 THEN concat(' - ', c_name, ' ') WHEN 1 THEN concat('-', c_name)"
        " ELSE concat('-  ', c_name) END"
    )
    return table(spark, sf_dir, "customer").select("c_custkey", codes.trimmed_account_name(raw).alias("name"))


@query(
    "map_text_sum",
    f"""WITH {MESSY_LINES_SQL}, n AS (SELECT *, {PARSED_SQL.format("amount_text")} AS parsed FROM messy)
    SELECT l_orderkey, l_linenumber, CASE WHEN amount_text IS NULL THEN 1.0 ELSE parsed + 1.0 END::double AS value
    FROM n""",
)
def _(spark, sf_dir):
    row = _row("SUM", "amount_text", "one")
    rows = messy_lines(spark, sf_dir).withColumn("one", F.lit(1.0))
    mapped = compile_row(row, {"one": "decimal"})[0]
    return rows.select("l_orderkey", "l_linenumber", mapped.value.alias("value"))


@query(
    "map_text_sign",
    f"""WITH {MESSY_LINES_SQL}, n AS (SELECT *, {PARSED_SQL.format("amount_text")} AS parsed FROM messy)
    SELECT l_orderkey, l_linenumber,
      CASE WHEN amount_text IS NULL THEN 'C' WHEN parsed >= 0 THEN 'D' WHEN parsed < 0 THEN 'C' END AS value,
      CASE WHEN amount_text IS NOT NULL AND parsed IS NULL THEN 'The value ' || amount_text ||
        ' is not numeric to convert to float/int for DbCrInd1 function' END AS error FROM n""",
)
def _(spark, sf_dir):
    return _mapped(messy_lines(spark, sf_dir), _row("DCI1", "amount_text"), {}, ["l_orderkey", "l_linenumber"])


@query(
    "map_project",
    f"""WITH {MESSY_LINES_SQL} SELECT {PARSED_SQL.format("amount_text")} AS amount, l_orderkey AS "journalId" FROM messy""",
)
def _(spark, sf_dir):
    mapped = messy_lines(spark, sf_dir).select(
        F.col("l_orderkey").alias("journalId"), parse_number(F.col("amount_text")).alias("amount")
    )
    return project(mapped, ["amount", "journalId"])


@query(
    "map_align",
    """WITH o AS (SELECT o_orderkey, o_totalprice, row_number() OVER (ORDER BY o_orderkey) AS i FROM orders),
    c AS (SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) AS i FROM customer)
    SELECT o_orderkey, o_totalprice, c_custkey, c_name FROM o FULL JOIN c USING (i)""",
)
def _(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey AS a", "o_orderkey", "o_totalprice")
    customers = table(spark, sf_dir, "customer").selectExpr("c_custkey AS b", "c_custkey", "c_name")
    return align_by_position([(orders, "a"), (customers, "b")]).drop("_position")
