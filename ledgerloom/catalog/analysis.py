"""Filters, counts, sums, nets and step lists."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import query
from ledgerloom.catalog.tables import GL_SQL, general_ledger, table
from ledgerloom.operators.aggregates import count_values, net_amounts, sum_values
from ledgerloom.operators.filters import filter_all, filter_any
from ledgerloom.plans.analyse import run_chain, run_steps
from ledgerloom.spec import Condition, Step


def _filter_query(name, source, condition, where, columns):
    @query(name, f"SELECT {', '.join(columns)} FROM {source} WHERE {where}")
    def build(spark, sf_dir):
        return filter_all(table(spark, sf_dir, source), [condition]).select(*columns)


_ORDER_COLUMNS = ["o_orderkey", "o_totalprice"]
_filter_query("filter_lt", "orders", Condition("o_totalprice", "lt", "1500.5"), "o_totalprice < 1500.5", _ORDER_COLUMNS)
_filter_query("filter_gt", "orders", Condition("o_totalprice", "gt", "400000"), "o_totalprice > 400000", _ORDER_COLUMNS)
_filter_query("filter_lte", "orders", Condition("o_custkey", "lte", "7"), "o_custkey <= 7", ["o_orderkey", "o_custkey"])
_filter_query("filter_gte", "orders", Condition("o_custkey", "gte", "100"), "o_custkey >= 100", ["o_orderkey", "o_custkey"])
_filter_query("filter_like", "part", Condition("p_name", "like", "ring"), "p_name LIKE '%ring%'", ["p_partkey", "p_name"])
_filter_query("filter_eq_text", "part", Condition("p_type", "eq", "ECONOMY"), "p_type = 'ECONOMY'", ["p_partkey", "p_type"])
_filter_query("filter_neq_text", "part", Condition("p_type", "neq", "ECONOMY"), "p_type <> 'ECONOMY'", ["p_partkey", "p_type"])
_filter_query("filter_eq_num", "part", Condition("p_size", "eq", "25"), "p_size = 25", ["p_partkey", "p_size"])

# Text forms of one number: only cells that denote the number match, other text never does.
_CODE_TEXT = (
    "CASE l_linenumber WHEN 1 THEN cast(l_suppkey AS {t}) WHEN 2 THEN concat(cast(l_suppkey AS {t}), '.0') "
    "WHEN 3 THEN concat('0', cast(l_suppkey AS {t})) WHEN 4 THEN concat('x', cast(l_suppkey AS {t})) "
    "WHEN 5 THEN concat(' +', cast(l_suppkey AS {t}), '.7 ') WHEN 6 THEN '' END"
)


def _text_codes(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.selectExpr("l_orderkey", f"{_CODE_TEXT.format(t='string')} AS code")


_TEXT_CODES_SQL = f"t AS (SELECT l_orderkey, {_CODE_TEXT.format(t='varchar')} AS code FROM lineitem)"
_WHOLE_SQL = r"try_cast(nullif(regexp_extract(code, '^\s*([+-]?\d+)(\.\d*)?\s*$', 1), '') AS bigint)"


@query("filter_eq_text_number", f"WITH {_TEXT_CODES_SQL} SELECT l_orderkey, code FROM t WHERE {_WHOLE_SQL} = 13")
def _(spark, sf_dir):
    return filter_all(_text_codes(spark, sf_dir), [Condition("code", "eq", "13")])


@query("filter_neq", f"WITH {_TEXT_CODES_SQL} SELECT l_orderkey, code FROM t WHERE {_WHOLE_SQL} <> 13")
def _(spark, sf_dir):
    return filter_all(_text_codes(spark, sf_dir), [Condition("code", "neq", "13")])


@query("filter_gt_text", f"WITH {_TEXT_CODES_SQL} SELECT l_orderkey, code FROM t WHERE try_cast(trim(code) AS double) > 97")
def _(spark, sf_dir):
    return filter_all(_text_codes(spark, sf_dir), [Condition("code", "gt", "97")])


_CHAIN = [Condition("l_extendedprice", "gt", "1000"), Condition("l_linenumber", "eq", "1")]
_EITHER = [Condition("l_extendedprice", "gt", "90000"), Condition("l_returnflag", "eq", "R")]
_LINE_COLUMNS = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_returnflag"]
_LINE_SQL = f"SELECT {', '.join(_LINE_COLUMNS)} FROM lineitem"


@query("filter_chain", f"{_LINE_SQL} WHERE l_extendedprice > 1000 AND l_linenumber = 1")
def _(spark, sf_dir):
    return filter_all(table(spark, sf_dir, "lineitem"), _CHAIN).select(*_LINE_COLUMNS)


@query(
    "filter_union_bag",
    f"{_LINE_SQL} WHERE l_extendedprice > 90000 UNION ALL {_LINE_SQL} WHERE l_returnflag = 'R'",
)
def _(spark, sf_dir):
    return filter_any(table(spark, sf_dir, "lineitem"), _EITHER, "bag").select(*_LINE_COLUMNS)


@query("filter_union_set", f"{_LINE_SQL} WHERE l_extendedprice > 90000 OR l_returnflag = 'R'")
def _(spark, sf_dir):
    return filter_any(table(spark, sf_dir, "lineitem"), _EITHER, "set").select(*_LINE_COLUMNS)


def _rounded(df, *columns):
    """Floating sums depend on row order, so both sides of the check round to cents."""
    for c in columns:
        df = df.withColumn(c, F.round(c, 2))
    return df


@query("sum_amount", "SELECT 1::bigint AS condition_no, round(sum(l_extendedprice), 2) AS sum FROM lineitem")
def _(spark, sf_dir):
    df = sum_values(table(spark, sf_dir, "lineitem"), [Condition("l_extendedprice")])
    return _rounded(df, "sum").withColumn("condition_no", F.col("condition_no").cast("bigint"))


@query(
    "sum_text_amount",
    f"WITH {_TEXT_CODES_SQL} SELECT 1::bigint AS condition_no, round(sum(try_cast(trim(code) AS double)), 2) AS sum FROM t",
)
def _(spark, sf_dir):
    df = sum_values(_text_codes(spark, sf_dir), [Condition("code")])
    return _rounded(df, "sum").withColumn("condition_no", F.col("condition_no").cast("bigint"))


@query("count_col", f"WITH {GL_SQL} SELECT count(enteredBy) AS count FROM gl")
def _(spark, sf_dir):
    return count_values(general_ledger(spark, sf_dir), [Condition("enteredBy")]).select("count")


@query("count_distinct", f"WITH {GL_SQL} SELECT count(DISTINCT glAccountNumber) AS count FROM gl")
def _(spark, sf_dir):
    return count_values(general_ledger(spark, sf_dir), [Condition("glAccountNumber", unique=True)]).select("count")


def _net_sql(net):
    return f"""WITH {GL_SQL}, s AS (
      SELECT sum(CASE WHEN amountCreditDebitIndicator = 'D' THEN amount END) AS d,
             -sum(CASE WHEN amountCreditDebitIndicator = 'C' THEN amount END) AS c FROM gl)
    SELECT round(d, 2) AS total_debit_amount, round(c, 2) AS total_credit_amount, round({net}, 2) AS net FROM s"""


_NET_COLUMNS = ("total_debit_amount", "total_credit_amount", "net")


@query("net_amount", _net_sql("d - c"))
def _(spark, sf_dir):
    return _rounded(net_amounts(general_ledger(spark, sf_dir)), *_NET_COLUMNS)


@query("net_signed", _net_sql("d + c"))
def _(spark, sf_dir):
    return _rounded(net_amounts(general_ledger(spark, sf_dir), signed=True), *_NET_COLUMNS)


_STEPS = [
    Step("a", "Filter", "", (Condition("amountCreditDebitIndicator", "eq", "D"), Condition("journalIdLineNumber", "lte", "5"))),
    Step("b", "Filter", "a", (Condition("localAmount", "lt", "20000"),)),
    Step("c", "Count", "b", (Condition("journalId", unique=True), Condition("enteredBy"), Condition("businessUnitCode", unique=True))),
    Step("d", "Sum", "b", (Condition("localAmount"), Condition("amount"))),
]
_STEP_SOURCE = f"""WITH {GL_SQL}, picked AS (
  SELECT * FROM gl WHERE localAmount < 20000 AND journalIdLineNumber <= 5 AND amountCreditDebitIndicator = 'D')"""


@query(
    "step_dag",
    _STEP_SOURCE
    + """ SELECT 'd' AS step, 1::bigint AS condition_no, round(sum(localAmount), 2) AS result FROM picked
    UNION ALL SELECT 'd', 2, round(sum(amount), 2) FROM picked
    UNION ALL SELECT 'c', 1, count(DISTINCT journalId) FROM picked
    UNION ALL SELECT 'c', 2, count(enteredBy) FROM picked
    UNION ALL SELECT 'c', 3, count(DISTINCT businessUnitCode) FROM picked""",
)
def _(spark, sf_dir):
    results = run_steps(general_ledger(spark, sf_dir), _STEPS)

    def labelled(step, column):
        return results[step].select(
            F.lit(step).alias("step"),
            F.col("condition_no").cast("bigint").alias("condition_no"),
            F.round(F.col(column).cast("double"), 2).alias("result"),
        )

    return labelled("d", "sum").unionByName(labelled("c", "count"))


# Steps of several sources, one of them keeping a row once per condition it meets.
_SHARED_STEPS = [
    Step("1", "Net"),
    Step("2", "Filter", "", (Condition("businessUnitCode", "eq", "3"), Condition("localAmount", "gt", "50000")), "or"),
    Step("3", "Count", "2", (Condition("enteredBy"), Condition("glAccountNumber", unique=True))),
    Step("4", "Filter", "2", (Condition("amountCreditDebitIndicator", "eq", "C"),)),
    Step("5", "Sum", "4", (Condition("localAmount"),)),
    Step("6", "Count", "4", (Condition("businessUnitCode", unique=True), Condition("journalId"))),
]


@query(
    "step_dag_shared",
    f"""WITH {GL_SQL}, u AS (
      SELECT * FROM gl WHERE try_cast(businessUnitCode AS double) = 3 UNION ALL SELECT * FROM gl WHERE localAmount > 50000),
    v AS (SELECT * FROM u WHERE amountCreditDebitIndicator = 'C')
    SELECT '1' AS step, 1::bigint AS condition_no, round(sum(CASE WHEN amountCreditDebitIndicator = 'D' THEN amount
      WHEN amountCreditDebitIndicator = 'C' THEN amount END), 0) AS result FROM gl
    UNION ALL SELECT '3', 1, count(enteredBy) FROM u UNION ALL SELECT '3', 2, count(DISTINCT glAccountNumber) FROM u
    UNION ALL SELECT '5', 1, round(sum(localAmount), 0) FROM v
    UNION ALL SELECT '6', 1, count(DISTINCT businessUnitCode) FROM v UNION ALL SELECT '6', 2, count(journalId) FROM v""",
)
def _(spark, sf_dir):
    results = run_steps(general_ledger(spark, sf_dir), _SHARED_STEPS)
    net = results["1"].select(F.lit(1).alias("condition_no"), F.col("net").alias("result"))
    labelled = [
        df.select(F.lit(step).alias("step"), F.col("condition_no").cast("bigint"), F.round(F.col(column).cast("double"), 0).alias("result"))
        for step, df, column in (
            ("1", net, "result"), ("3", results["3"], "count"), ("5", results["5"], "sum"), ("6", results["6"], "count")
        )
    ]
    return reduce(lambda a, b: a.unionByName(b), labelled)


@query(
    "step_union",
    f"""WITH {GL_SQL} SELECT 1::bigint AS condition_no, count(enteredBy) AS count FROM gl
    UNION ALL SELECT 2, count(DISTINCT enteredBy) FROM gl UNION ALL SELECT 3, count(journalId) FROM gl""",
)
def _(spark, sf_dir):
    conditions = [Condition("enteredBy"), Condition("enteredBy", unique=True), Condition("journalId")]
    df = count_values(general_ledger(spark, sf_dir), conditions)
    return df.withColumn("condition_no", F.col("condition_no").cast("bigint"))


@query(
    "step_chain",
    f"""WITH {GL_SQL} SELECT round(sum(amount), 2) AS sum FROM gl
    WHERE amountCreditDebitIndicator = 'D' AND journalIdLineNumber >= 3""",
)
def _(spark, sf_dir):
    steps = [
        Step("1", "Filter", "", (Condition("amountCreditDebitIndicator", "eq", "D"),)),
        Step("2", "Filter", "", (Condition("journalIdLineNumber", "gte", "3"),)),
        Step("3", "Sum", "", (Condition("amount"),)),
    ]
    return _rounded(run_chain(general_ledger(spark, sf_dir), steps)["3"], "sum").select("sum")
