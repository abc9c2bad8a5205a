import json

import pytest

from ledgerloom.catalog import REGISTRY, jobs
from ledgerloom.operators.aggregates import count_values
from ledgerloom.plans import conform as plan
from ledgerloom.plans.analyse import run_chain, run_step, run_steps, write_steps
from ledgerloom.plans.conform import check_file, conform, covered_reports, map_report
from ledgerloom.sinks import publish as publishing
from ledgerloom.sinks.publish import published
from ledgerloom.sources.reports import read_report
from ledgerloom.spec import (
    Condition,
    Exclusion,
    ExclusionRule,
    FileTemplate,
    Step,
    reports_from_mapping,
    steps_from_config,
    templates_from_extract,
)

TB_FILE = "trialBalance_balances.csv"
TB_REPORT = """Summary,,
For the year,,
,,
Account,Year to date,
,,
Timber (317),-£55.10,
"Ropes, Sails (622)","£2,310.75",
Till (008),"-£2,255.65",
Total ,£0.00,
"""


def _field(target, kind="string", map_type="direct", fields=(), file=TB_FILE, report="trialBalance", **more):
    sources = [{"file_name": f[1] if isinstance(f, tuple) else file,
                "field_name": f[0] if isinstance(f, tuple) else f, "order": i + 1} for i, f in enumerate(fields)]
    return {"map_type": map_type, "cdm_field": target, "erp_fields": sources, "report_type": report,
            "data_type": kind, **more}


def _calculated(target, operation, fields=(), **more):
    return _field(target, map_type="calculated", fields=fields, operation=operation, **more)


TB_FIELDS = [
    _field("period", map_type="dummy"),
    _field("glAccountNumber", fields=["Account"]),
    _calculated("fiscalYear", "FT", free_text="2023"),
    _field("amountEnding", "decimal", fields=["Year to date"]),
    _field("amountBeginning", "decimal", map_type="dummy"),
    _field("businessUnitCode", map_type="dummy"),
    _field("glAccountName", map_type="dummy"),
]
TB_TEMPLATE = FileTemplate(4, Exclusion((ExclusionRule(1, "Total "),), "and"))


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / TB_FILE).write_text(TB_REPORT, encoding="utf-8")
    return tmp_path


def _read_csv(spark, path):
    return [tuple(r) for r in spark.read.option("header", True).option("escape", '"').csv(path).collect()]


def test_trial_balance_job(spark, folder):
    reports = reports_from_mapping({"fields": TB_FIELDS}, {TB_FILE: TB_TEMPLATE})
    out = str(folder / "out")
    groups = spark.createDataFrame([("Till (008)", "None", "Assets")], "nominalCode string, description string, account string")
    result = conform(spark, reports, str(folder / "in"), out, grouping=groups, uploaded=[TB_FILE])
    assert (result.status, result.tables) == ("COMPLETED", ("trialBalance",))
    assert _read_csv(spark, f"{out}/trialBalance.csv") == [
        (None, "Timber (317)", "2023", "-55.1", None, None, None),
        (None, "Ropes, Sails (622)", "2023", "2310.75", None, None, None),
        (None, "Till (008)", "2023", "-2255.65", None, None, None),
    ]
    card = json.loads(spark.read.text(f"{out}/dqs.json").first()[0])["trialBalance"]
    assert card["statistical"][3] == {"amountEndingSum": 0.0}
    assert card["business_rule"] == [{"netting": "pass"}]
    assert card["profile"][0]["fieldsFilled"]["fields"] == ["glAccountNumber", "fiscalYear", "amountEnding"]
    assert len(_read_csv(spark, f"{out}/trialBalance_grouped.csv")) == 3


def _with_bad_cells(folder):
    text = TB_REPORT.replace("-£55.10", "none").replace("Total ,", "Closing,")
    (folder / "in" / TB_FILE).write_text(text, encoding="utf-8")
    split = _calculated("segment01", "SPLIT", ["Account"], characters="8")
    return reports_from_mapping({"fields": [*TB_FIELDS, split]}, {TB_FILE: TB_TEMPLATE})


def test_strict_mode_writes_errors_only(spark, folder):
    out = str(folder / "out")
    result = conform(spark, _with_bad_cells(folder), str(folder / "in"), out)
    assert (result.status, result.tables) == ("FAILED", ())
    assert _read_csv(spark, f"{out}/errors.csv") == [
        ("trialBalance", None, TB_FILE, "Year to date (decimal)", "1", "Invalid Data Type")
    ]
    assert not (folder / "out" / "trialBalance.csv").exists()


def test_quarantine_mode_writes_valid_rows_and_errors(spark, folder):
    out = str(folder / "out")
    result = conform(spark, _with_bad_cells(folder), str(folder / "in"), out, mode="quarantine")
    assert result.status == "COMPLETED"
    assert [r[1] for r in _read_csv(spark, f"{out}/trialBalance.csv")] == ["Ropes, Sails (622)", "Till (008)", "Closing"]
    assert _read_csv(spark, f"{out}/errors.csv") == [
        ("trialBalance", None, TB_FILE, "Year to date (decimal)", "1", "Invalid Data Type"),
        ("trialBalance", "segment01", TB_FILE, "Account", "4", "Could not split the value Closing for 8 characters"),
    ]


def test_ledger_with_line_numbers_and_extra_field(spark, tmp_path):
    lines = ["jid,text,debit,credit,when"] + [
        f"{j},AB{i}cd,{10 * i if i % 2 else ''},{'' if i % 2 else 10 * i},{i + 1:02d}/02/2021" for i, j in enumerate([1, 1, 2, 1, 2, ""])
    ]
    (tmp_path / "gl.csv").write_text("\n".join(lines) + "\n")
    fields = [
        _field("journalId", fields=["jid"]),
        _calculated("journalIdLineNumber", "Journal Line Number", ["jid"], kind="integer"),
        _calculated("code", "SPLIT", ["text"], characters="3", extra="tail"),
        _field("tail", map_type="dummy"),
        _calculated("side", "DCI2", ["debit", "credit"], kind="decimal"),
        _calculated("amount", "SUM", ["debit", "credit"], kind="decimal"),
        _field("effectiveDate", map_type="date-mask", fields=["when"], date_format="%d/%m/%Y"),
    ]
    for f in fields:
        f["report_type"] = "glDetail"
        for s in f["erp_fields"]:
            s["file_name"] = "gl.csv"
    report = reports_from_mapping({"fields": fields})[0]
    checked = check_file(read_report(spark, str(tmp_path / "gl.csv")), "gl.csv", report.file_fields()["gl.csv"], FileTemplate())
    result = map_report(report, {"gl.csv": checked})
    assert not result.has_errors() and result.errors.isEmpty()
    assert [tuple(r)[1:] for r in result.table.orderBy("_ord").collect()] == [
        ("1", 1, "AB0", "cd", "C", 0.0, "2021-02-01T00:00:00Z"),
        ("1", 2, "AB1", "cd", "D", 10.0, "2021-02-02T00:00:00Z"),
        ("2", 1, "AB2", "cd", "C", 20.0, "2021-02-03T00:00:00Z"),
        ("1", 3, "AB3", "cd", "D", 30.0, "2021-02-04T00:00:00Z"),
        ("2", 2, "AB4", "cd", "C", 40.0, "2021-02-05T00:00:00Z"),
        ("", 1, "AB5", "cd", "D", 50.0, "2021-02-06T00:00:00Z"),
    ]


def test_fields_of_two_files_are_aligned(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n1\n\n2\n3\n")
    (tmp_path / "b.csv").write_text("y\np\n")
    fields = [
        _field("left", "integer", fields=[("x", "a.csv")]),
        _field("right", fields=[("y", "b.csv")]),
        _calculated("both", "DIV", [("x", "a.csv"), ("y", "b.csv")]),
    ]
    report = reports_from_mapping({"fields": fields})[0]
    files = {
        name: check_file(read_report(spark, str(tmp_path / name)), name, typed, FileTemplate())
        for name, typed in report.file_fields().items()
    }
    result = map_report(report, files)
    assert [tuple(r)[1:] for r in result.table.orderBy("_ord").collect()] == [(1, "p", None), (2, None, None), (3, None, None)]
    assert [(r.cdm_field, r.error, r.data_row) for r in result.errors.collect()] == [
        ("both", "Using fields of different input files", None)
    ]


def test_reports_without_files_are_left_out(spark):
    reports = reports_from_mapping({"fields": [*TB_FIELDS, _field("x", fields=["c"], file="other.csv", report="glDetail"),
                                               _field("y", fields=["c"], file="third.csv", report="glDetail")]})
    assert [r.name for r in covered_reports(spark, reports, [TB_FILE])] == ["trialBalance"]
    with pytest.raises(ValueError, match="valid mapping"):
        covered_reports(spark, reports, ["nothing.csv"])


def test_templates_from_extract():
    extract = {"reports": [{"report_type": "trialBalance", "input_files": [
        {"file_name": "balances.csv", "template": {"start_row": 4, "exclusion": {"aggr": "and", "rules": [
            {"column": 1, "contains": "Total "}]}}}]}]}
    assert templates_from_extract(extract) == {TB_FILE: TB_TEMPLATE}


STEPS = steps_from_config(
    {
        "operation": [
            {"order": 2, "operation_type": "Filter", "source": "", "conditions": [
                {"filter_column": "glAccountNumber", "filter_condition": "eq", "input": "4410", "is_unique": ""},
                {"filter_column": "text", "filter_condition": "eq", "input": "Paint", "is_unique": ""}]},
            {"order": 3, "operation_type": "Sum", "source": "2", "conditions": [
                {"filter_column": "amount", "filter_condition": "", "input": "", "is_unique": ""}]},
            {"order": 4, "operation_type": "Count", "source": "2", "conditions": [
                {"filter_column": "glAccountNumber", "is_unique": ""},
                {"filter_column": "glAccountNumber", "is_unique": True}]},
            {"order": 5, "operation_type": "Net", "source": "", "conditions": []},
        ]
    }
)


@pytest.fixture(scope="module")
def base(spark):
    rows = [("4410", "Paint", "6200.5", "D"), ("04410", "Paint", "3100.75", "C"), ("4410", "Hire", "1", "D"), ("9", "Paint", "x", "D")]
    return spark.createDataFrame(rows * 6, "glAccountNumber string, text string, amount string, amountCreditDebitIndicator string").filter(
        "amount <> 'x'"
    )


def test_step_results(base):
    results = run_steps(base, STEPS)
    assert results["2"].count() == 12
    assert results["3"].first()["sum"] == 55807.5
    assert [r["count"] for r in results["4"].orderBy("condition_no").collect()] == [12, 2]
    assert results["5"].first().total_debit_amount == 37209.0


def test_written_steps(spark, base, tmp_path):
    write_steps(base, STEPS, str(tmp_path))
    assert len(_read_csv(spark, str(tmp_path / "tmp_Filter_2.csv"))) == 12
    assert sorted(_read_csv(spark, str(tmp_path / "tmp_Count_4.csv"))) == [("12",), ("2",)]
    preview = json.loads(spark.read.text(str(tmp_path / "tmp_Filter_2.json")).first()[0])
    assert len(preview["data"]) == 10
    assert preview["data"][0] == {"glAccountNumber": "4410", "text": "Paint", "amount": "6200.5", "amountCreditDebitIndicator": "D"}
    assert json.loads(spark.read.text(str(tmp_path / "tmp_Sum_3.json")).first()[0]) == {"data": [{"sum": 55807.5}]}


def test_written_result_can_start_a_new_list(spark, base, tmp_path):
    from ledgerloom.sources.reports import read_headed_csv

    write_steps(base, STEPS[:1], str(tmp_path))
    again = run_steps(read_headed_csv(spark, str(tmp_path / "tmp_Filter_2.csv")), [Step("1", "Sum", "", (Condition("amount"),))])
    assert again["1"].first()["sum"] == 55807.5


def test_chain_and_union(base):
    either = Step("1", "Filter", "", (Condition("text", "eq", "Hire"), Condition("glAccountNumber", "eq", "4410")), "or")
    results = run_chain(base, [either, Step("2", "Count", "", (Condition("text"),))])
    assert results["2"].first()["count"] == 24
    with pytest.raises(ValueError, match="Sort"):
        run_steps(base, [Step("1", "Sort")])


def test_a_bad_row_in_one_file_shifts_nothing(spark, tmp_path):
    """Rows stay beside each other; the row that is bad in one file is left out, errors keep their row."""
    (tmp_path / "a.csv").write_text("x\n1\nbad\n3\n4\n5,surplus\n")
    (tmp_path / "b.csv").write_text("y,j\np,1\nq,1\nr,1\ns,2\nt,2\n")
    fields = [
        _field("left", "integer", fields=[("x", "a.csv")], report="glDetail"),
        _field("right", fields=[("y", "b.csv")], report="glDetail"),
        _calculated("part", "SPLIT", [("y", "b.csv")], characters="2", report="glDetail"),
        _calculated("line", "Journal Line Number", [("j", "b.csv")], report="glDetail"),
    ]
    reports = reports_from_mapping({"fields": fields})
    out = str(tmp_path / "out")
    assert conform(spark, reports, str(tmp_path), out, mode="quarantine").status == "COMPLETED"
    assert [r[:2] + r[3:] for r in _read_csv(spark, f"{out}/glDetail.csv")] == [("1", "p", "1"), ("3", "r", "2"), ("4", "s", "1")]
    errors = {(r[1], r[2], r[3], r[4]) for r in _read_csv(spark, f"{out}/errors.csv")}
    assert {e for e in errors if e[1] == "a.csv"} == {(None, "a.csv", "x (integer)", "2"), (None, "a.csv", "extra cells (surplus)", "5")}
    assert {e[3] for e in errors if e[1] == "b.csv"} == {"1", "2", "3", "4", "5"}


def test_a_file_that_was_not_uploaded_is_an_error_row(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n1\n")
    fields = [_field("left", fields=[("x", "a.csv")]), _field("right", fields=[("y", "b.csv")])]
    out = str(tmp_path / "out")
    reports = reports_from_mapping({"fields": fields})
    assert conform(spark, reports, str(tmp_path), out, uploaded=["a.csv"]).status == "FAILED"
    assert _read_csv(spark, f"{out}/errors.csv") == [("trialBalance", None, "b.csv", None, None, "The input file was not uploaded")]


def test_tables_without_a_scored_field_are_scored(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n1\n")
    out = str(tmp_path / "out")
    reports = reports_from_mapping({"fields": [_field("amountEnding", "decimal", fields=[("x", "a.csv")])]})
    assert conform(spark, reports, str(tmp_path), out).status == "COMPLETED"
    card = json.loads(spark.read.text(f"{out}/dqs.json").first()[0])["trialBalance"]
    assert {"glAccountCodeCount": 0.0} in card["statistical"] and {"amountEndingSum": 1.0} in card["statistical"]


def test_steps_that_share_a_pass_give_what_each_gives_alone(spark, tmp_path):
    """Filters of both kinds before counts, sums and nets, with null and non-numeric cells and repeated rows."""
    rows = [("1", "D", "4.5"), ("1", "C", None), (None, "C", "x"), ("2", None, "7"), ("2", "D", "7"), ("2", "D", "7"), ("", "C", "-3")]
    spark.createDataFrame(rows, "unit string, amountCreditDebitIndicator string, amount string").write.parquet(f"{tmp_path}/t")
    table = spark.read.parquet(f"{tmp_path}/t")
    measures = (Condition("unit", unique=True), Condition("amount"), Condition("amountCreditDebitIndicator", unique=True), Condition("unit", unique=True))
    either = (Condition("unit", "eq", "2"), Condition("amount", "gt", "5"))
    steps = [
        Step("a", "Count", "", measures),
        Step("b", "Filter", "", either, "or"),
        Step("c", "Count", "b", measures),
        Step("d", "Sum", "b", (Condition("amount"), Condition("unit"))),
        Step("e", "Filter", "b", (Condition("amountCreditDebitIndicator", "eq", "D"), Condition("amount", "lt", "9"))),
        Step("f", "Net", "e"),
        Step("g", "Filter", "e", either, "or"),
        Step("h", "Count", "g", measures),
        Step("i", "Filter", "", (Condition("unit", "eq", "77"),)),
        Step("j", "Sum", "i", (Condition("amount"),)),
        Step("k", "Count", "c", (Condition("count"),)),
    ]
    for df in (table, table.limit(0)):
        alone = {}
        for step in steps:
            alone[step.order] = run_step(alone[step.source] if step.source else df, step)
        together = run_steps(df, steps)
        for step in steps:
            assert together[step.order].schema.names == alone[step.order].schema.names
            assert sorted(map(str, together[step.order].collect())) == sorted(map(str, alone[step.order].collect()))
    write_steps(table, steps, f"{tmp_path}/out")
    assert sorted(spark.read.parquet(f"{tmp_path}/out/tmp_Count_c.parquet").collect()) == sorted(alone_counts(table, steps))


def alone_counts(table, steps):
    return run_step(run_step(table, steps[1]), steps[2]).collect()


def test_counts_read_their_table_once(spark, tmp_path):
    spark.range(50).selectExpr("id % 7 AS a", "id % 5 AS b", "id AS c").write.parquet(f"{tmp_path}/t")
    counts = count_values(spark.read.parquet(f"{tmp_path}/t"), [Condition("a", unique=True), Condition("b", unique=True), Condition("c")])
    assert [r["count"] for r in counts.orderBy("condition_no").collect()] == [7, 5, 50]
    assert counts._jdf.queryExecution().optimizedPlan().toString().count("Relation [") == 1


def test_a_job_that_dies_publishes_nothing(spark, folder, monkeypatch):
    """Killed after its first table, by an error or with the process, the job leaves the run before in force."""
    reports, out = reports_from_mapping({"fields": _job_rows()}, {}), str(folder / "out")
    (folder / "in" / "one.csv").write_text("x\n1\n2\n")

    def dies(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as broken:
        broken.setattr(plan, "scorecard", dies)
        with pytest.raises(KeyboardInterrupt):
            conform(spark, reports, str(folder / "in"), out, as_one=True)
        with pytest.raises(FileNotFoundError):
            published(spark, out)
        assert not list((folder / "out" / "runs").iterdir())
    assert conform(spark, reports, str(folder / "in"), out, as_one=True).status == "COMPLETED"
    first, manifest = published(spark, out)
    assert manifest["tables"] == ["trialBalance"] and spark.read.parquet(f"{first}/trialBalance.parquet").count() == 2
    with monkeypatch.context() as broken:
        broken.setattr(plan, "scorecard", dies)
        # A process that is gone removes nothing.
        broken.setattr(publishing, "_delete", lambda *_: None)
        with pytest.raises(KeyboardInterrupt):
            conform(spark, reports, str(folder / "in"), out, as_one=True)
    assert len(list((folder / "out" / "runs").iterdir())) == 2
    assert published(spark, out)[0] == first
    (folder / "in" / "one.csv").write_text("x\n1\n2\n3\n")
    conform(spark, reports, str(folder / "in"), out, as_one=True)
    second, _ = published(spark, out)
    assert second != first and spark.read.parquet(f"{second}/trialBalance.parquet").count() == 3
    assert spark.read.parquet(f"{first}/trialBalance.parquet").count() == 2


def _job_rows():
    return [_field("glAccountNumber", fields=("x",), file="one.csv")]


def test_the_header_stands_first_whatever_the_keys(spark, tmp_path):
    keys = "SELECT explode(array(-14L, -7L, 0L, 7L, 100L, 105L, 112L)) AS p_partkey"
    spark.sql(f"SELECT p_partkey, 3 AS p_size FROM ({keys})").write.parquet(str(tmp_path / "part.parquet"))
    lines = spark.read.text(f"{jobs._broken_parts(spark, str(tmp_path))}/parts/file=0", wholetext=True).first().value.splitlines()
    assert lines == ["item,size,code", '"one', 'two",3,-14', '"one', 'two",3,-7', '"one', 'two",3,0', '"one', 'two",3,7', '"lost, 3,105', "plain,3,112"]
    rows = REGISTRY["report_unclosed_quote"].build(spark, str(tmp_path)).collect()
    assert sorted((r.code, r["unclosed cell"] is not None) for r in rows) == [
        ("-14", False), ("-7", False), ("0", False), ("100", True), ("105", True), ("112", False), ("7", False),
    ]
