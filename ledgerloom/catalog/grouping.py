"""Trial balance grouped by the chart-of-accounts table, and mapping coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.catalog.registry import query
from ledgerloom.catalog.tables import GROUPING_SQL, grouping, table
from ledgerloom.operators.coverage import kept_reports, missing_files, untracked_files
from ledgerloom.operators.grouping import group_by_code_and_name
from ledgerloom.plans.group import group_trial_balance, write_grouped
from ledgerloom.runtime import literal_rows, scratch_path
from ledgerloom.sources.reports import read_headed_csv

# Some names differ from the grouping's, so the composite key leaves rows unmatched.
_TB_SPARK = [
    "c_custkey",
    "CASE WHEN c_acctbal < 0 THEN NULL ELSE c_nationkey END AS glAccountNumber",
    "concat(CASE WHEN c_mktsegment = 'BUILDING' THEN '- ' WHEN c_mktsegment = 'MACHINERY' THEN 'x' ELSE ' ' END,"
    " 'NATION_', cast(c_nationkey AS {t})) AS glAccountName",
    "c_acctbal AS amountEnding",
]
_TB_SQL = "tb AS (SELECT " + ", ".join(c.format(t="varchar") for c in _TB_SPARK) + " FROM customer)"
_JOINED_SQL = """joined AS (SELECT tb.*, grp.* EXCLUDE (nominalCode)
  FROM tb LEFT JOIN grp ON cast(tb.glAccountNumber AS varchar) IS NOT DISTINCT FROM grp.nominalCode)"""
_LEFT = f"WITH {_TB_SQL}, {GROUPING_SQL}, {_JOINED_SQL} "


def _tb(spark, sf_dir):
    return table(spark, sf_dir, "customer").selectExpr(*[c.format(t="string") for c in _TB_SPARK])


def _grouped(spark, sf_dir):
    return group_trial_balance(_tb(spark, sf_dir), grouping(spark, sf_dir))


@query("group_left", _LEFT + "SELECT c_custkey, glAccountNumber, amountEnding, description, account, fsCaption FROM joined")
def _(spark, sf_dir):
    joined = _grouped(spark, sf_dir).table
    return joined.select("c_custkey", "glAccountNumber", "amountEnding", "description", "account", "fsCaption")


@query(
    "group_composite",
    f"""WITH {_TB_SQL}, {GROUPING_SQL},
    cleaned AS (SELECT *, CASE WHEN starts_with(trim(glAccountName), '- ') THEN substr(trim(glAccountName), 3)
      WHEN starts_with(trim(glAccountName), '-') THEN substr(trim(glAccountName), 2)
      ELSE trim(glAccountName) END AS clean FROM tb)
    SELECT DISTINCT glAccountNumber, glAccountName, account, fsCaption FROM cleaned LEFT JOIN grp
      ON cast(glAccountNumber AS varchar) IS NOT DISTINCT FROM nominalCode AND clean = trim(description)""",
)
def _(spark, sf_dir):
    tb = _tb(spark, sf_dir).select("glAccountNumber", "glAccountName")
    groups = grouping(spark, sf_dir).withColumn("account", F.nullif("account", F.lit("nan")))
    return group_by_code_and_name(tb, groups)


@query(
    "group_coverage",
    _LEFT
    + """SELECT count(DISTINCT glAccountNumber) AS total_codes,
    count(DISTINCT CASE WHEN account IS NOT NULL THEN glAccountNumber END) AS mapped_codes FROM joined""",
)
def _(spark, sf_dir):
    return _grouped(spark, sf_dir).coverage


_CATEGORIES_SQL = """cat(category, word) AS (VALUES ('assets', 'asset'), ('liabilities', 'liabilit'),
  ('equity', 'equity'), ('income', 'income'), ('expenditure', 'expense'))"""


@query(
    "group_rollup",
    _LEFT.rstrip()
    + f""", {_CATEGORIES_SQL}
    SELECT category, coalesce(sum(cast(amountEnding AS decimal(28,8))), 0)::double AS total_value,
      count(DISTINCT glAccountNumber) AS mapped, count(DISTINCT account) AS accounts
    FROM cat LEFT JOIN joined ON contains(lower(account), word) GROUP BY category""",
)
def _(spark, sf_dir):
    return _grouped(spark, sf_dir).rollup


@query(
    "group_category_accounts",
    _LEFT.rstrip()
    + f""", {_CATEGORIES_SQL}
    SELECT DISTINCT category, account FROM cat JOIN joined ON contains(lower(account), word)""",
)
def _(spark, sf_dir):
    return _grouped(spark, sf_dir).accounts


def _written_groups(spark, sf_dir) -> str:
    folder = scratch_path(spark, "grouped")
    write_grouped(_grouped(spark, sf_dir), grouping(spark, sf_dir), folder)
    return folder


@query(
    "write_grouped",
    _LEFT + """SELECT glAccountNumber::varchar AS "glAccountNumber", account, amountEnding AS "amountEnding" FROM joined""",
)
def _(spark, sf_dir):
    """The grouped table as it is exported."""
    written = read_headed_csv(spark, f"{_written_groups(spark, sf_dir)}/trialBalance_grouped.csv")
    return written.select("glAccountNumber", "account", F.col("amountEnding").cast("double").alias("amountEnding"))


@query(
    "grouping_json",
    _LEFT.rstrip()
    + f""", {_CATEGORIES_SQL}
    SELECT 'code' AS part, nominalCode AS name, coalesce(account, 'nan') AS value FROM grp
    UNION ALL SELECT 'quality', 'mapped_codes', count(DISTINCT CASE WHEN account IS NOT NULL THEN glAccountNumber END)::varchar FROM joined
    UNION ALL SELECT 'account', category, account FROM (SELECT DISTINCT category, account FROM cat JOIN joined ON contains(lower(account), word))""",
)
def _(spark, sf_dir):
    """The JSON files of a grouping, read back: its rows, its quality block and the accounts of each category."""
    folder = f"{_written_groups(spark, sf_dir)}/grouping"
    codes = spark.read.json(f"{folder}/grouping").select(F.lit("code").alias("part"), F.col("nominalCode").alias("name"), F.col("accountType").alias("value"))
    quality = spark.read.json(f"{folder}/quality").select(F.lit("quality"), F.lit("mapped_codes"), F.col("mapped_codes").cast("string"))
    accounts = spark.read.json(f"{folder}/accounts").select(F.lit("account"), "category", "account")
    return codes.union(quality).union(accounts)


# Files named after regions stand for uploads; every nation expects one file.
_UPLOADED = "concat(lower(r_name), '.csv')"
_EXPECTED = "concat(CASE WHEN n_nationkey < 20 THEN lower(r_name) ELSE lower(n_name) END, '.csv')"
_FILES_SQL = f"""up AS (SELECT {_UPLOADED} AS file_name FROM region WHERE r_name <> 'ASIA'
    UNION ALL SELECT 'notes.csv'),
  exp AS (SELECT r_name AS report_name, {_EXPECTED} AS file_name
    FROM nation JOIN region ON n_regionkey = r_regionkey)"""


def _files(spark, sf_dir):
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    uploaded = region.filter("r_name <> 'ASIA'").select(F.expr(_UPLOADED).alias("file_name"))
    extra = literal_rows(spark, [("notes.csv",)], uploaded.schema)
    expected = nation.join(region, nation.n_regionkey == region.r_regionkey).selectExpr(
        "r_name AS report_name", f"{_EXPECTED} AS file_name"
    )
    return uploaded.unionByName(extra), expected


@query(
    "mapping_coverage",
    f"""WITH {_FILES_SQL} SELECT DISTINCT report_name FROM exp
    WHERE (SELECT count(DISTINCT file_name) FROM up) >= (SELECT count(*) FROM exp)
      OR report_name IN (SELECT report_name FROM exp WHERE file_name IN (SELECT file_name FROM up))""",
)
def _(spark, sf_dir):
    return kept_reports(*_files(spark, sf_dir))


@query(
    "mapping_missing_files",
    f"WITH {_FILES_SQL} SELECT report_name, file_name FROM exp WHERE file_name NOT IN (SELECT file_name FROM up)",
)
def _(spark, sf_dir):
    return missing_files(*_files(spark, sf_dir)).select("report_name", "file_name")


@query(
    "mapping_untracked_files",
    f"WITH {_FILES_SQL} SELECT file_name FROM up WHERE file_name NOT IN (SELECT file_name FROM exp)",
)
def _(spark, sf_dir):
    return untracked_files(*_files(spark, sf_dir))
