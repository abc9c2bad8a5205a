"""The given tables seen as ledgers, once as DataFrames and once as SQL for the check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.runtime import scratch_path

# Beyond the posting date, because (l_orderkey, l_linenumber) repeats.
LINE_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def general_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(*_GL_SPARK)


_GL_SPARK = [
    "l_orderkey AS journalId",
    "l_linenumber AS journalIdLineNumber",
    "l_extendedprice AS amount",
    "l_extendedprice * (1 - l_discount) AS localAmount",
    "CASE WHEN l_returnflag = 'R' THEN 'C' ELSE 'D' END AS amountCreditDebitIndicator",
    "l_partkey AS glAccountNumber",
    "CASE WHEN l_linestatus = 'F' AND l_linenumber = 1 THEN '' ELSE cast(l_suppkey AS string) END"
    " AS businessUnitCode",
    "CASE WHEN l_linestatus = 'O' THEN 'clerk' END AS enteredBy",
    "cast(NULL AS string) AS enteredDateTime",
    "CASE WHEN l_linenumber = 7 THEN '' END AS approvedBy",
    "cast(NULL AS string) AS approvedDateTime",
    "cast(NULL AS string) AS lastModifiedBy",
    "CASE WHEN l_returnflag = 'R' THEN 'Y' END AS reversalIndicator",
    "cast(NULL AS string) AS reversalJournalId",
    "l_linestatus AS journalEntryType",
    "CASE WHEN l_linenumber > 3 THEN l_returnflag ELSE '  ' END AS sourceId",
]
GL_SQL = "gl AS (SELECT " + ", ".join(_GL_SPARK).replace("AS string)", "AS varchar)") + " FROM lineitem)"


def trial_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(*_TB_SPARK)


_TB_SPARK = [
    "c_custkey AS glAccountNumber",
    "c_name AS glAccountName",
    "c_mktsegment AS accountGroup",
    "c_nationkey AS businessUnitCode",
    "c_acctbal AS amountEnding",
    "CASE WHEN c_acctbal > 0 THEN c_acctbal * 0.5 END AS amountBeginning",
    "CASE WHEN c_mktsegment = 'MACHINERY' THEN ' ' ELSE c_mktsegment END AS segment01",
    "cast(NULL AS string) AS segment02",
    "cast(NULL AS double) AS amountEndingLocal",
]
TB_SQL = "tb AS (SELECT " + ", ".join(_TB_SPARK).replace("AS string)", "AS varchar)") + " FROM customer)"


def chart_of_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS glAccountNumber",
        "p_name AS glAccountName",
        "p_type AS accountType",
        "CASE WHEN p_size > 25 THEN p_brand ELSE '' END AS businessUnitCode",
    )


COA_SQL = (
    "coa AS (SELECT p_partkey AS glAccountNumber, p_name AS glAccountName, p_type AS accountType, "
    "CASE WHEN p_size > 25 THEN p_brand ELSE '' END AS businessUnitCode FROM part)"
)

_ACCOUNT = (
    "CASE r_name WHEN 'AFRICA' THEN 'Current Assets' WHEN 'AMERICA' THEN 'Long-term Liabilities' "
    "WHEN 'ASIA' THEN 'Owner Equity' WHEN 'EUROPE' THEN 'Other Income and Expense' ELSE 'nan' END"
)


def grouping(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "cast(n_nationkey AS string) AS nominalCode",
        "concat(n_name, ' ') AS description",
        f"{_ACCOUNT} AS account",
        "r_name AS fsCaption",
    )


GROUPING_SQL = (
    "grp AS (SELECT cast(n_nationkey AS varchar) AS nominalCode, n_name || ' ' AS description, "
    f"nullif({_ACCOUNT}, 'nan') AS account, r_name AS fsCaption "
    "FROM nation JOIN region ON n_regionkey = r_regionkey)"
)

# Amounts as an export writes them: signs, thousands, parentheses, junk and blanks.
_MESSY = """CASE l_linenumber
  WHEN 1 THEN concat('£', {grouped})
  WHEN 2 THEN concat('(', cast(l_extendedprice AS {text}), ')')
  WHEN 3 THEN concat('-£', {grouped})
  WHEN 4 THEN cast(l_extendedprice AS {text})
  WHEN 5 THEN cast(cast(l_quantity AS int) AS {text})
  WHEN 6 THEN CASE WHEN l_returnflag = 'A' THEN 'N4' WHEN l_returnflag = 'R' THEN '1-2' ELSE '(Light)' END
  END"""
MESSY_SPARK = _MESSY.format(grouped="format_number(l_extendedprice, 2)", text="string")
MESSY_SQL = _MESSY.format(grouped="format('{:,.2f}', l_extendedprice)", text="varchar")
PARSED_SQL = """CASE WHEN regexp_matches({0}, '^[0-9]+$') THEN try_cast({0} AS double)
  WHEN regexp_matches({0}, '^[a-zA-Z0-9]+$') THEN NULL
  ELSE try_cast(regexp_replace({0}, '[^0-9.-]', '', 'g') AS double)
    * CASE WHEN contains({0}, '(') AND contains({0}, ')') THEN -1 ELSE 1 END END"""


_STAGED: dict[tuple[str, str], str] = {}


def messy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with the amount, a flag and a date as export text.

    The text is written once per application, as report cells are: checks then read plain columns.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _STAGED:
        path = scratch_path(spark, "messy")
        _messy_text(spark, sf_dir).write.parquet(path)
        _STAGED[key] = path
    return spark.read.parquet(_STAGED[key])


def _messy_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        f"{MESSY_SPARK} AS amount_text",
        "CASE l_returnflag WHEN 'A' THEN 'True' WHEN 'R' THEN 'FALSE' WHEN 'N' THEN"
        " CASE WHEN l_linestatus = 'O' THEN 'yes' END END AS flag_text",
        "CASE l_linenumber WHEN 1 THEN date_format(l_shipdate, 'yyyy-MM-dd')"
        " WHEN 2 THEN date_format(l_shipdate, 'dd/MM/yyyy') WHEN 3 THEN date_format(l_shipdate, 'd MMM yyyy')"
        " WHEN 4 THEN 'soon' WHEN 5 THEN '2020-13-45' WHEN 6 THEN date_format(l_shipdate, 'dd-MMM-yy') END"
        " AS date_text",
    )


MESSY_LINES_SQL = f"""messy AS (SELECT l_orderkey, l_linenumber, l_suppkey, {MESSY_SQL} AS amount_text,
  CASE l_returnflag WHEN 'A' THEN 'True' WHEN 'R' THEN 'FALSE' WHEN 'N' THEN
    CASE WHEN l_linestatus = 'O' THEN 'yes' END END AS flag_text,
  CASE l_linenumber WHEN 1 THEN strftime(l_shipdate, '%Y-%m-%d') WHEN 2 THEN strftime(l_shipdate, '%d/%m/%Y')
    WHEN 3 THEN strftime(l_shipdate, '%-d %b %Y') WHEN 4 THEN 'soon' WHEN 5 THEN '2020-13-45'
    WHEN 6 THEN strftime(l_shipdate, '%d-%b-%y') END AS date_text
  FROM lineitem)"""
