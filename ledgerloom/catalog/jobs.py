"""Whole jobs over the given tables: reports with preamble, strict and quarantine runs, and what they write."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.catalog.registry import query
from ledgerloom.catalog.tables import table
from ledgerloom.plans.conform import conform
from ledgerloom.runtime import scratch_path
from ledgerloom.sinks.publish import published
from ledgerloom.sinks.writers import write_table
from ledgerloom.sources.reports import ORD, SURPLUS, UNCLOSED, read_headed_csv, read_report, read_report_with_check
from ledgerloom.spec import Exclusion, ExclusionRule, FileTemplate, HeaderCheck, ReportSpec, reports_from_mapping

_PREAMBLE = ("Closing figures,,", "Harbour Mill,,", ",,", "All branches,,", "Account,Balance,", ",,")


def _exported_balances(spark: SparkSession, sf_dir: str) -> str:
    """One report file per nation, each with preamble, header at line 5, an empty row and a total row."""
    customers = table(spark, sf_dir, "customer")
    rows = customers.selectExpr(
        "c_nationkey AS branch",
        "c_custkey + 100 AS place",
        "concat('\"', c_name, ', ', c_mktsegment, ' (', c_custkey, ')\",£', format_number(c_acctbal, '0.00'), ',') AS value",
    )
    branches = customers.select(F.col("c_nationkey").alias("branch")).distinct()
    fixed = [F.struct(F.lit(i).cast("bigint").alias("place"), F.lit(line).alias("value")) for i, line in enumerate(_PREAMBLE)]
    fixed.append(F.struct(F.lit(2**62).alias("place"), F.lit("Total ,£0.00,").alias("value")))
    path = scratch_path(spark, "balances")
    every = rows.unionByName(branches.select("branch", F.inline(F.array(*fixed))))
    every = every.repartition("branch").sortWithinPartitions("branch", "place")
    every.select("branch", "value").write.partitionBy("branch").text(f"{path}/balances")
    return path


_ACCOUNT = "c_name || ', ' || c_mktsegment || ' (' || c_custkey || ')'"


@query(
    "read_report_preamble",
    f"""SELECT {_ACCOUNT} AS "Account", '£' || printf('%.2f', c_acctbal) AS "Balance", NULL::varchar AS "NO_NAME2" FROM customer
    UNION ALL SELECT 'Total ', '£0.00', NULL FROM (SELECT DISTINCT c_nationkey FROM customer)""",
)
def _(spark, sf_dir):
    """A nameless last column, blank rows, and a header at line 5 in every file."""
    return read_report(spark, f"{_exported_balances(spark, sf_dir)}/balances", 5).drop("_ord")


def _balance_report(spark: SparkSession) -> list[ReportSpec]:
    def field(target, kind="string", source=None, **more):
        sources = [{"file_name": "balances", "field_name": source, "order": 1}] if source else []
        return {"cdm_field": target, "data_type": kind, "report_type": "trialBalance", "erp_fields": sources, **more}

    inside = {"opening_char": "(", "closing_char": ")", "inside_outside": "inside"}
    rows = [
        field("glAccountNumber", source="Account", map_type="calculated", operation="SGLAN", extract_split_fields=inside),
        field("amountEnding", "decimal", "Balance", map_type="direct"),
        field("fiscalYear", map_type="calculated", operation="FT", free_text="2024"),
    ]
    template = FileTemplate(5, Exclusion((ExclusionRule(1, "Total "),), "and"))
    return reports_from_mapping({"fields": rows}, {"balances": template})


@query(
    "conform_job",
    """SELECT c_custkey::varchar AS "glAccountNumber", c_acctbal AS "amountEnding", '2024' AS "fiscalYear" FROM customer""",
)
def _(spark, sf_dir):
    """The whole strict job, read back from the table it wrote."""
    out = scratch_path(spark, "out")
    conform(spark, _balance_report(spark), _exported_balances(spark, sf_dir), out)
    written = read_headed_csv(spark, f"{out}/trialBalance.csv")
    return written.withColumn("amountEnding", F.col("amountEnding").cast("double"))


@query(
    "conform_published",
    """SELECT c_custkey::varchar AS "glAccountNumber", c_acctbal AS "amountEnding", '2024' AS "fiscalYear", 'COMPLETED' AS status FROM customer""",
)
def _(spark, sf_dir):
    """The strict job published as one, read back through its manifest."""
    out = scratch_path(spark, "out")
    conform(spark, _balance_report(spark), _exported_balances(spark, sf_dir), out, as_one=True)
    run, manifest = published(spark, out)
    written = spark.read.parquet(f"{run}/{manifest['tables'][0]}.parquet").drop(ORD)
    return written.withColumn("amountEnding", F.col("amountEnding").cast("double")).withColumn("status", F.lit(manifest["status"]))


@query(
    "read_report_stray_quotes",
    """SELECT CASE p_partkey % 3 WHEN 0 THEN p_size || '" pipe' WHEN 1 THEN p_size || '" x 5" plate' ELSE 'say "' || p_size || '"' || chr(10) || 'twice' END
      AS item, p_partkey::varchar AS code FROM part""",
)
def _(spark, sf_dir):
    """Inch signs in plain cells beside quoted cells with escaped signs and line breaks."""
    path = scratch_path(spark, "inches")
    lines = table(spark, sf_dir, "part").selectExpr(
        r"""CASE p_partkey % 3 WHEN 0 THEN concat(p_size, '" pipe,', p_partkey) WHEN 1 THEN concat(p_size, '" x 5" plate,', p_partkey)
        ELSE concat('"say ""', p_size, '""\ntwice",', p_partkey) END AS value""",
        "p_partkey % 7 AS part",
    )
    parts = lines.select("part").distinct().select("part", F.lit("item,code").alias("value"), F.lit(0).alias("place"))
    every = parts.unionByName(lines.withColumn("place", F.lit(1)))
    every = every.repartition("part").sortWithinPartitions("part", "place")
    every.select("part", "value").write.partitionBy("part").text(path)
    return read_report(spark, path).drop("_ord")


@query(
    "report_surplus_cells",
    """SELECT p_partkey::varchar AS code, p_size::varchar AS size,
      CASE WHEN p_partkey % 5 = 0 THEN p_brand END AS "extra cells" FROM part""",
)
def _(spark, sf_dir):
    path = scratch_path(spark, "surplus")
    lines = table(spark, sf_dir, "part").selectExpr(
        "p_partkey % 3 AS part", "1 AS place", "concat(p_partkey, ',', p_size, CASE WHEN p_partkey % 5 = 0 THEN concat(',', p_brand) ELSE ',' END) AS value"
    )
    heads = lines.select("part").distinct().select("part", F.lit(0).alias("place"), F.lit("code,size").alias("value"))
    every = heads.unionByName(lines).repartition("part").sortWithinPartitions("part", "place")
    every.select("part", "value").write.partitionBy("part").text(path)
    return read_report(spark, path, surplus=True).select("code", "size", SURPLUS)


_ENTRY_CHECK = HeaderCheck.from_dict(
    {
        "fields": [
            {"field_name": "Ledger code", "cdm_field_names": ["glAccountNumber"]},
            {"field_name": "In", "cdm_field_names": ["amount", "amountCreditDebitIndicator"]},
            {"field_name": "Out", "cdm_field_names": ["amount"]},
            {"field_name": "Remark", "cdm_field_names": []},
        ],
        "mandatory_field_check": [
            {"cdm_field_name": "glAccountNumber", "occurrence_count": 1},
            {"cdm_field_name": "amount", "occurrence_count": 2},
        ],
    }
)


@query(
    "read_report_found_header",
    """SELECT p_partkey::varchar AS code, CASE WHEN p_size % 2 = 0 THEN p_size::varchar END AS taken_in,
      CASE WHEN p_size % 2 = 1 THEN p_size::varchar END AS paid_out, CASE WHEN p_partkey % 3 = 0 THEN p_brand END AS remark FROM part""",
)
def _(spark, sf_dir):
    """Preambles of no to four lines, some of which name a column, and two orders of columns."""
    path = scratch_path(spark, "headers")
    parts = table(spark, sf_dir, "part").selectExpr(
        "p_partkey % 5 AS file", "p_partkey + 100 AS place",
        "CASE WHEN p_size % 2 = 0 THEN cast(p_size AS string) ELSE '' END AS taken_in", "CASE WHEN p_size % 2 = 1 THEN cast(p_size AS string) ELSE '' END AS paid_out",
        "p_partkey AS code", "p_brand",
    )
    remarked = F.col("code") % 3 == 0
    lines = parts.where("file < 4").select(
        "file", "place",
        F.when(F.col("file") % 2 == 0, F.concat_ws(",", "code", "taken_in", "paid_out", F.when(remarked, F.col("p_brand")).otherwise("")))
        .otherwise(F.concat_ws(",", F.when(remarked, F.col("p_brand")).otherwise(""), "paid_out", "code", "taken_in")).alias("value"),
    )
    last = parts.where("file = 4").select("file", "place", F.concat_ws(",", "taken_in", "code", "paid_out", F.when(remarked, F.col("p_brand")).otherwise("")).alias("value"))
    files = parts.select("file").distinct()
    preamble = files.select("file", F.explode(F.expr("slice(sequence(1, 4), 1, cast(file AS int))")).alias("place")).selectExpr(
        "file", "cast(place AS bigint) AS place", "CASE WHEN place % 2 = 0 THEN 'In,,' ELSE 'Ledger code and Out of all branches,,' END AS value"
    )
    heads = files.selectExpr(
        "file", "50L AS place",
        "CASE WHEN file = 4 THEN 'In,Ledger code,\"Out\",Remark' WHEN file % 2 = 0 THEN 'Ledger code,In,Out,Remark' ELSE 'Remark,Out,Ledger code, In ' END AS value",
    )
    every = lines.unionByName(last).unionByName(preamble).unionByName(heads).repartition("file").sortWithinPartitions("file", "place")
    every.select("file", "value").write.partitionBy("file").text(path)
    report = read_report_with_check(spark, path, _ENTRY_CHECK)
    return report.select(F.col("Ledger code").alias("code"), F.col("In").alias("taken_in"), F.col("Out").alias("paid_out"), F.col("Remark").alias("remark"))


def _broken_parts(spark: SparkSession, sf_dir: str) -> str:
    """Seven files of parts with quoted cells over two lines, closed but for one in the middle of each file."""
    path = scratch_path(spark, "unclosed")
    parts = table(spark, sf_dir, "part").selectExpr("p_partkey", "p_partkey % 7 AS file", "p_size")
    # Below the broken line of a file no quote sign follows that could close its cell.
    lines = parts.selectExpr(
        "file",
        "p_partkey AS place",
        r"""CASE WHEN p_partkey < 100 THEN concat('"one\ntwo",', p_size, ',', p_partkey) WHEN p_partkey BETWEEN 100 AND 106
          THEN concat('"lost, ', p_size, ',', p_partkey) ELSE concat('plain,', p_size, ',', p_partkey) END AS value""",
    )
    heads = parts.select("file").distinct().select("file", F.lit(0).alias("place"), F.lit("item,size,code").alias("value"))
    # A key may be as low as the header's place, or lower.
    every = heads.withColumn("below", F.lit(False)).unionByName(lines.withColumn("below", F.lit(True)))
    every = every.repartition("file").sortWithinPartitions("file", "below", "place")
    every.select("file", "value").write.partitionBy("file").text(f"{path}/parts")
    return path


@query(
    "report_unclosed_quote",
    r"""SELECT CASE WHEN p_partkey < 100 THEN 'one' || chr(10) || 'two' WHEN p_partkey <= 106 THEN '"lost' ELSE 'plain' END AS item,
      CASE WHEN p_partkey BETWEEN 100 AND 106 THEN p_size::varchar ELSE p_size::varchar END AS size, p_partkey::varchar AS code,
      CASE WHEN p_partkey BETWEEN 100 AND 106 THEN '"lost, ' || p_size || ',' || p_partkey END AS "unclosed cell" FROM part""",
)
def _(spark, sf_dir):
    """A cell that never closes costs its own line only."""
    report = read_report(spark, f"{_broken_parts(spark, sf_dir)}/parts", unclosed=True)
    return report.select("item", F.trim("size").alias("size"), "code", UNCLOSED)


def _unclosed_job(spark: SparkSession, sf_dir: str, mode: str) -> tuple[str, str]:
    fields = [
        {"cdm_field": target, "data_type": "string", "report_type": "glDetail", "map_type": "direct",
         "erp_fields": [{"file_name": "parts", "field_name": source, "order": 1}]}
        for target, source in (("journalId", "code"), ("sourceId", "item"))
    ]
    out = scratch_path(spark, "out")
    result = conform(spark, reports_from_mapping({"fields": fields}), _broken_parts(spark, sf_dir), out, mode=mode)
    return result.status, out


@query(
    "conform_unclosed_quote",
    """SELECT 'strict' AS mode, 'FAILED' AS status, 'unclosed cell (unclosed)' AS field_name, 'Invalid Data Type' AS error, 7::bigint AS n
    UNION ALL SELECT 'quarantine', 'COMPLETED', 'unclosed cell (unclosed)', 'Invalid Data Type', 7
    UNION ALL SELECT 'quarantine', 'COMPLETED', NULL, NULL, count(*) - 7 FROM part""",
)
def _(spark, sf_dir):
    """The job in both modes: error rows for the broken lines, and in quarantine all other rows."""
    found = None
    for mode in ("strict", "quarantine"):
        status, out = _unclosed_job(spark, sf_dir, mode)
        errors = read_headed_csv(spark, f"{out}/errors.csv").groupBy("field_name", "error").agg(F.count("*").alias("n"))
        if mode == "quarantine":
            kept = read_headed_csv(spark, f"{out}/glDetail.csv").where("sourceId <> '\"lost'").agg(F.count("*").alias("n"))
            errors = errors.unionByName(kept, allowMissingColumns=True)
        part = errors.select(F.lit(mode).alias("mode"), F.lit(status).alias("status"), "field_name", "error", "n")
        found = part if found is None else found.unionByName(part)
    return found


def _two_files(spark: SparkSession, sf_dir: str, more: tuple[dict, ...] = ()) -> tuple[list[ReportSpec], str]:
    """Orders exported as two files in one order; every 11th amount is no number."""
    folder = scratch_path(spark, "pair")
    orders = table(spark, sf_dir, "orders").orderBy("o_orderkey")
    write_table(
        orders.selectExpr("CASE WHEN o_orderkey % 11 = 0 THEN 'none' ELSE format_number(o_totalprice, '0.00') END AS amount"),
        f"{folder}/amounts.csv",
    )
    write_table(orders.selectExpr("o_orderkey AS code", "o_orderpriority AS name"), f"{folder}/names.csv")

    def field(target, kind, file, source, **more):
        return {"cdm_field": target, "data_type": kind, "report_type": "glDetail", "map_type": "direct",
                "erp_fields": [{"file_name": file, "field_name": source, "order": 1}], **more}

    rows = [
        field("amount", "decimal", "amounts.csv", "amount"),
        field("journalId", "string", "names.csv", "code"),
        field("head", "string", "names.csv", "name", map_type="calculated", operation="SPLIT", characters="7"),
    ]
    return reports_from_mapping({"fields": [*rows, *more]}), folder


def _of_both_files(target: str, operation: str, **more) -> dict:
    sources = [{"file_name": f"{file}.csv", "field_name": name, "order": k} for k, (file, name) in enumerate((("amounts", "amount"), ("names", "code")), 1)]
    return {"cdm_field": target, "data_type": "decimal", "report_type": "glDetail", "map_type": "calculated", "operation": operation,
            "erp_fields": sources, **more}


@query(
    "map_cross_file_guard",
    """SELECT o_orderkey::varchar AS "journalId", NULL::varchar AS both, NULL::varchar AS formula, NULL::varchar AS ranged,
      'both: Using fields of different input files; formula: Multiple files used for the conversion.' AS errors
    FROM orders WHERE o_orderkey % 11 <> 0""",
)
def _(spark, sf_dir):
    """Fields that would need two files stay empty, and the mapping's errors are in the error table."""
    more = (_of_both_files("both", "SUM"), _of_both_files("formula", "MC", expression="<1> + <2>"), _of_both_files("ranged", "DCI3"))
    reports, folder = _two_files(spark, sf_dir, more)
    out = scratch_path(spark, "out")
    conform(spark, reports, folder, out, mode="quarantine")
    errors = read_headed_csv(spark, f"{out}/errors.csv").where("data_row IS NULL")
    said = errors.agg(F.array_join(F.array_sort(F.collect_list(F.concat_ws(": ", "cdm_field", "error"))), "; ").alias("errors"))
    written = read_headed_csv(spark, f"{out}/glDetail.csv")
    return written.select("journalId", "both", "formula", "ranged", said.scalar().alias("errors"))


@query(
    "conform_quarantine_two_files",
    """SELECT round(o_totalprice, 2) AS amount, o_orderkey::varchar AS "journalId",
      o_orderpriority[1:7] AS head FROM orders WHERE o_orderkey % 11 <> 0""",
)
def _(spark, sf_dir):
    """A bad row of one file is left out and shifts nothing."""
    reports, folder = _two_files(spark, sf_dir)
    out = scratch_path(spark, "out")
    conform(spark, reports, folder, out, mode="quarantine")
    written = read_headed_csv(spark, f"{out}/glDetail.csv")
    return written.withColumn("amount", F.col("amount").cast("double"))


@query(
    "conform_quarantine_errors",
    """WITH o AS (SELECT *, row_number() OVER (ORDER BY o_orderkey) AS n FROM orders)
    SELECT 'glDetail' AS report_name, NULL::varchar AS cdm_field, 'amounts.csv' AS file_name, 'amount (decimal)' AS field_name,
      n AS data_row, 'Invalid Data Type' AS error FROM o WHERE o_orderkey % 11 = 0
    UNION ALL SELECT 'glDetail', 'head', 'names.csv', 'name', n, 'Could not split the value ' || o_orderpriority || ' for 7 characters'
      FROM o WHERE length(o_orderpriority) < 7""",
)
def _(spark, sf_dir):
    """The written error table: every error has the number of its row among the cleaned rows of its file."""
    reports, folder = _two_files(spark, sf_dir)
    out = scratch_path(spark, "out")
    conform(spark, reports, folder, out, mode="quarantine")
    errors: DataFrame = read_headed_csv(spark, f"{out}/errors.csv")
    return errors.withColumn("data_row", F.col("data_row").cast("bigint"))
