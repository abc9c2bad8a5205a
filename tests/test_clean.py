import pytest

from ledgerloom.operators import clean
from ledgerloom.spec import Exclusion, ExclusionRule

ROWS = [
    (1, "Cash", "NULL", "x"),
    (2, " ", "BLANK", "n/a"),
    (3, "Total ", "null", "Null"),
    (4, None, "5", ""),
    (5, "Grand TOTAL", "7", "#N/A"),
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(ROWS, "_ord int, `*Name` string, `b.c` string, note string")


@pytest.fixture(scope="module")
def cleaned(raw):
    return clean.null_tokens_to_null(raw, ["_ord"])


def _ords(df):
    return [r["_ord"] for r in df.orderBy("_ord").collect()]


def test_null_tokens(cleaned):
    assert [tuple(r)[1:] for r in cleaned.orderBy("_ord").collect()] == [
        ("Cash", None, "x"),
        (None, None, None),
        ("Total ", None, "Null"),
        (None, "5", None),
        ("Grand TOTAL", "7", None),
    ]


def test_drop_all_null_and_prune(cleaned):
    assert _ords(clean.drop_all_null(cleaned, ["_ord"])) == [1, 3, 4, 5]
    pruned = clean.prune(cleaned, ["b.c"], ["_ord"])
    assert pruned.columns == ["_ord", "b.c"]
    assert _ords(pruned) == [4, 5]


@pytest.mark.parametrize(
    ("rules", "aggr", "kept"),
    [
        ([(1, "Total ")], "and", [1, 2, 4, 5]),
        ([(1, "total")], "or", [1, 2, 4]),
        ([(1, "AN")], "or", [1, 3]),
        ([(2, "NULL")], "or", [4, 5]),
        ([(2, "NOT_NULL")], "or", [1, 2, 3]),
        ([(1, "total"), (2, "NULL")], "or", [4]),
        ([(1, "total"), (2, "NULL")], "and", [1, 2, 4, 5]),
        ([(1, "total"), (2, "NULL")], "xor", [1, 2, 3, 4, 5]),
        ([(1, "total")], "xor", [1, 2, 4]),
    ],
)
def test_exclusion(cleaned, rules, aggr, kept):
    exclusion = Exclusion(tuple(ExclusionRule(*r) for r in rules), aggr)
    if len(rules) == 1 and aggr == "xor":
        exclusion = Exclusion(exclusion.rules, aggr)
    assert _ords(clean.exclude_rows(cleaned, exclusion, ["_ord"])) == kept


def test_trailing_total(cleaned):
    assert _ords(clean.drop_trailing_total(cleaned, "_ord")) == [1, 2, 3, 4]
    without = cleaned.filter("_ord < 5")
    assert _ords(clean.drop_trailing_total(without, "_ord")) == [1, 2, 3, 4]


def test_header_repair():
    assert clean.repaired_header(["A", "", None, "A", "A"]) == ["A", "NO_NAME1", "NO_NAME2", "A.1", "A.2"]
