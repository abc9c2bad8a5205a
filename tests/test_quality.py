import json

import pytest

from ledgerloom.operators.quality import scorecard
from ledgerloom.sinks.writers import METRIC_ORDER, scorecard_document, write_scorecard
from ledgerloom.spec import TypedField

GL_SCHEMA = (
    "_ord long, journalId string, amount double, localAmount double, amountCreditDebitIndicator string, "
    "glAccountNumber string, businessUnitCode string, enteredBy string, enteredDateTime string, approvedBy string, "
    "approvedDateTime string, lastModifiedBy string, reversalIndicator string, reversalJournalId string, "
    "journalEntryType string, sourceId string"
)


def _gl_row(i, journal, amount, side, code, unit="", **more):
    blank = dict.fromkeys(
        ["enteredBy", "enteredDateTime", "approvedBy", "approvedDateTime", "lastModifiedBy", "reversalIndicator",
         "reversalJournalId", "journalEntryType", "sourceId"]
    )
    rest = {**blank, **more}
    return (i, journal, amount, None, side, code, unit, *[rest[k] for k in blank])


@pytest.fixture(scope="module")
def ledger(spark):
    journals = [1, 4, 2, 5, 3, 1, 2, 3, 4, 5]
    sides = "DCDCDCCCDD"
    amounts = [200.0, 10.0, 43.5, 2.5, 0.1, 200.0, 43.5, 0.1, 10.0, 2.5]
    codes = ["16", "16", "17", "17", "18", "1", "1", "1", "19", None]
    rows = [
        _gl_row(i, str(j), a, s, c, enteredBy="x" if i else None, approvedBy="", sourceId=" ")
        for i, (j, a, s, c) in enumerate(zip(journals, amounts, sides, codes))
    ]
    return spark.createDataFrame(rows, GL_SCHEMA)


def _metrics(card):
    return {r.metric: r for r in card.collect()}


def test_ledger_scorecard(ledger):
    found = _metrics(scorecard(ledger, "glDetail", [TypedField("amount", "decimal")], "_ord"))
    values = {k: r.value for k, r in found.items() if r.section == "statistical"}
    assert values == {
        "recordCount": 10.0, "fieldCount": 15.0, "amountSum": 512.2, "localAmountSum": 0.0, "debitCredits": 0.0,
        "glAccountCodeCount": 5.0, "businessUnitCounts": 0.0,
    }
    assert found["netting"].outcome == "pass"
    # Blank text counts as present here, as opposed to the profile.
    assert found["controlChecks"].percent == 40
    assert [f.present for f in found["controlChecks"].fields] == [True, False, True, False, False]
    assert found["reversals"].percent == 0
    assert found["manualJournals"].percent == 50
    assert (found["missingSequentialItems"]["count"], found["missingSequentialItems"].percent) == (5, 50)
    assert [f.name for f in found["fieldsFilled"].fields] == [
        "journalId", "amount", "amountCreditDebitIndicator", "glAccountNumber", "enteredBy",
    ]
    assert [(f.name, f.percent) for f in found["missingRecords"].fields] == [("glAccountNumber", 90), ("enteredBy", 90)]
    assert found["missingRecords"].percent == 60


def test_sums_do_not_depend_on_partitions(ledger):
    one, many = [
        {(r.metric, r.value, r.outcome) for r in scorecard(ledger.repartition(n), "glDetail").collect()} for n in (1, 40)
    ]
    assert one == many


def test_tiny_ending_sum_is_clamped(spark):
    schema = "glAccountNumber string, businessUnitCode string, amountBeginning double, amountEnding double"
    df = spark.createDataFrame([("1", None, 0.5, 0.0000004), ("1", "", None, 0.0)], schema)
    found = _metrics(scorecard(df, "trialBalance"))
    assert found["amountEndingSum"].value == 0.0
    assert found["amountBeginingSum"].value == 0.5
    assert (found["glAccountCodeCount"].value, found["businessUnitCounts"].value) == (1.0, 0.0)
    assert found["netting"].outcome == "pass"


def test_netting_bound(spark):
    schema = "glAccountNumber string, businessUnitCode string, amountBeginning double, amountEnding double"

    def outcome(amount):
        df = spark.createDataFrame([("1", "u", 0.0, amount)], schema)
        return _metrics(scorecard(df, "trialBalance"))["netting"].outcome

    assert (outcome(0.001), outcome(-0.001), outcome(0.0011)) == ("pass", "pass", "fail")


def test_chart_of_accounts_has_no_rules(spark):
    df = spark.createDataFrame([("1", "u"), ("2", None)], "glAccountNumber string, businessUnitCode string")
    card = scorecard(df, "ChartOfAccounts")
    assert "business_rule" not in {r.section for r in card.collect()}
    assert scorecard(df, "somethingElse") is None


def test_document(spark, ledger, tmp_path):
    card = scorecard(ledger, "glDetail", [TypedField("journalId", "string")], "_ord")
    path = str(tmp_path / "dqs.json")
    write_scorecard(card, path)
    document = json.loads(spark.read.text(path).first()[0])
    assert list(document) == ["glDetail"]
    sections = document["glDetail"]
    assert [next(iter(m)) for m in sections["statistical"]] == [
        "recordCount", "fieldCount", "amountSum", "localAmountSum", "debitCredits", "glAccountCodeCount",
        "businessUnitCounts",
    ]
    rules = {k: v for m in sections["business_rule"] for k, v in m.items()}
    assert rules["netting"] == "pass"
    assert rules["controlChecks"]["overall"] == 40.0
    assert rules["controlChecks"]["fields"][0] == {"enteredBy": True}
    assert rules["missingSequentialItems"] == {"overall": 50, "fields": [{"journalId": False, "show_warning": False}]}
    profile = {k: v for m in sections["profile"] for k, v in m.items()}
    assert profile["textFieldsEmpty"] == {"percent": 0, "total": 1, "empty": 0, "fields": []}
    assert profile["missingRecords"]["fields"] == [{"glAccountNumber": 90}, {"enteredBy": 90}]
    assert scorecard_document(card, METRIC_ORDER).count() == 1
