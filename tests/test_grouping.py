import pytest

from ledgerloom import runtime
from ledgerloom.operators import grouping as ops
from ledgerloom.operators.coverage import kept_reports, missing_files, untracked_files
from ledgerloom.plans.group import group_trial_balance, quality_block, write_grouped

TB = [("800", "- Payables ", -91.0), ("90", "Bank", 10.0), ("90", "Bank", 10.0), (None, "Odd", 1.0), ("7", "None such", 5.5)]
GROUPS = [
    ("800", "Payables ", "Current Liabilities"),
    ("90", "Bank", "Fixed Asset and Income"),
    ("91", "Bank", "nan"),
    (None, "Odd", "Equity"),
]


@pytest.fixture(scope="module")
def tb(spark):
    return spark.createDataFrame(TB, "glAccountNumber string, glAccountName string, amountEnding double")


@pytest.fixture(scope="module")
def groups(spark):
    return spark.createDataFrame(GROUPS, "nominalCode string, description string, account string")


@pytest.mark.parametrize("limit", [0, runtime.BROADCAST_BYTES], ids=["shuffled", "broadcast"])
def test_left_join_matches_null_codes(spark, tb, groups, limit, monkeypatch):
    monkeypatch.setattr(ops, "lookup_side", lambda df, once: runtime.lookup_side(df, limit, once))
    table = group_trial_balance(tb, groups).table
    assert "nominalCode" not in table.columns
    rows = sorted((r.glAccountNumber or "", r.account or "") for r in table.collect())
    assert rows == [
        ("", "Equity"),
        ("7", ""),
        ("800", "Current Liabilities"),
        ("90", "Fixed Asset and Income"),
        ("90", "Fixed Asset and Income"),
    ]


def test_composite_key_drops_repeats(tb, groups):
    table = group_trial_balance(tb, groups, with_names=True).table
    assert table.columns == ["glAccountNumber", "glAccountName", "amountEnding", "account"]
    rows = sorted((r.glAccountNumber or "", r.account or "") for r in table.collect())
    assert rows == [("", "Equity"), ("7", ""), ("800", "Current Liabilities"), ("90", "Fixed Asset and Income")]


def test_missing_names_do_not_match(spark):
    tb = spark.createDataFrame([("1", None), ("2", "x")], "glAccountNumber string, glAccountName string")
    groups = spark.createDataFrame([("1", None, "Assets"), ("2", " x", "Equity")], "nominalCode string, description string, account string")
    joined = ops.group_by_code_and_name(tb, groups)
    assert {r.glAccountNumber: r.account for r in joined.collect()} == {"1": None, "2": "Equity"}


def test_codes_can_be_normalized(spark, groups):
    tb = spark.createDataFrame([("090",), (" 800",), ("0",)], "glAccountNumber string")
    joined = ops.group_by_code(tb, groups, normalize=True)
    assert {r.glAccountNumber: r.account for r in joined.collect()} == {
        "090": "Fixed Asset and Income", " 800": "Current Liabilities", "0": None,
    }


def test_coverage_and_rollup(tb, groups):
    grouped = group_trial_balance(tb, groups)
    assert grouped.coverage.first().asDict() == {"total_codes": 3, "mapped_codes": 2}
    rollup = {r.category: (r.total_value, r.mapped, r.accounts) for r in grouped.rollup.collect()}
    assert rollup == {
        "assets": (20.0, 1, 1), "liabilities": (-91.0, 1, 1), "equity": (1.0, 0, 1), "income": (20.0, 1, 1),
        "expenditure": (0.0, 0, 0),
    }
    accounts = {(r.category, r.account) for r in grouped.accounts.collect()}
    assert ("assets", "Fixed Asset and Income") in accounts and ("income", "Fixed Asset and Income") in accounts
    block = quality_block(grouped).first()
    assert block.total_codes == 3 and len(block.account_detail) == 5


def test_written_group(spark, tb, groups, tmp_path):
    out = str(tmp_path / "g")
    write_grouped(group_trial_balance(tb, groups), groups, out)
    assert spark.read.option("header", True).csv(f"{out}/trialBalance_grouped.csv").count() == 5
    written = spark.read.json(f"{out}/grouping/grouping")
    assert "accountType" in written.columns and "account" not in written.columns
    assert spark.read.json(f"{out}/grouping/quality").first().mapped_codes == 2


def test_mapping_coverage(spark):
    mapped = spark.createDataFrame([("r", "a"), ("r", "b"), ("s", "c")], "report_name string, file_name string")

    def kept(*files):
        uploaded = spark.createDataFrame([(f,) for f in files], "file_name string")
        return sorted(r.report_name for r in kept_reports(uploaded, mapped).collect())

    assert kept("a", "x") == ["r"]
    assert kept("x", "y", "z") == ["r", "s"]
    assert kept("x") == []
    assert kept("a", "b", "c", "d") == ["r", "s"]
    uploaded = spark.createDataFrame([("a",), ("x",)], "file_name string")
    assert sorted(r.file_name for r in missing_files(uploaded, mapped).collect()) == ["b", "c"]
    assert [r.file_name for r in untracked_files(uploaded, mapped).collect()] == ["x"]
