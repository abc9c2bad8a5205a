import pytest

from ledgerloom.operators.mapping import JobError, compile_row
from ledgerloom.spec import CodeSplit, MappingRow, SourceField

KINDS = {"a": "decimal", "b": "decimal", "t": "string", "u": "string"}
ROWS = [
    (1, 6.0, 3.0, "abcdef", "£5"),
    (2, -1.5, None, "ab", "x"),
    (3, None, 0.0, "", ""),
    (4, 2.0, 0.0, "abc", "(2)"),
]


def _run(spark, operation, fields, map_type="calculated", data_type="string", **options):
    sources = tuple(SourceField("f.csv", name, order) for name, order in fields)
    row = MappingRow(map_type, "out", "r", data_type, sources, operation, **options)
    df = spark.createDataFrame(ROWS, "i int, a double, b double, t string, u string")
    mapped = compile_row(row, KINDS)
    columns = [m.value.alias(m.target) for m in mapped]
    if mapped[0].error is not None:
        columns.append(mapped[0].error.alias("error"))
    return [tuple(r) for r in df.orderBy("i").select(*columns).collect()]


AB = [("a", 1), ("b", 2)]


@pytest.mark.parametrize(
    ("operation", "fields", "expected"),
    [
        ("SUM", AB, [9.0, -1.5, 0.0, 2.0]),
        ("DIFF", [("a", 2), ("b", 1)], [-3.0, 1.5, 0.0, -2.0]),
        ("PROD", AB, [18.0, 0.0, 0.0, 0.0]),
        ("DCI2", AB, ["D", "C", "C", "D"]),
        ("DCI1", [("a", 1)], ["D", "C", "C", "D"]),
    ],
)
def test_number_operators(spark, operation, fields, expected):
    rows = _run(spark, operation, fields)
    assert [r[0] for r in rows] == expected
    assert [r[1] for r in rows] == [None] * 4


def test_operators_without_errors(spark):
    assert [r[0] for r in _run(spark, "DC", AB)] == [9.0, -1.5, 0.0, 2.0]
    assert [r[0] for r in _run(spark, "ABS", [("a", 1)])] == [6.0, 1.5, None, 2.0]
    assert [r[0] for r in _run(spark, "ABS", [("u", 1)])] == [5.0, 0.0, 0.0, 2.0]
    assert [r[0] for r in _run(spark, "CONCAT", [("t", 1), ("b", 2)])] == ["abcdef-3.0", "ab-", "-0.0", "abc-0.0"]
    assert [r[0] for r in _run(spark, "CS", [("u", 2), ("t", 1)])] == ["abcdef", "ab", "", "abc"]
    assert [r[0] for r in _run(spark, "FT", [], free_text="2023")] == ["2023"] * 4
    split = CodeSplit("(", ")", "inside")
    assert [r[0] for r in _run(spark, "SGLAN", [("u", 1)], code_split=split)] == [None, None, None, "2"]


def test_text_operands(spark):
    rows = _run(spark, "SUM", [("u", 1), ("b", 2)])
    assert rows == [(8.0, None), (None, "Could not use Addition operation"), (0.0, None), (-2.0, None)]
    rows = _run(spark, "DCI1", [("u", 1)])
    assert [r[0] for r in rows] == ["D", None, None, "C"]
    assert rows[1][1].startswith("The value x is not numeric")
    rows = _run(spark, "DCI2", [("u", 1), ("t", 2)])
    assert [r[0] for r in rows] == ["D", None, None, "D"]
    assert rows[1][1] == "Could not determine Debit/Credit Indicator for x, ab"


def test_division(spark):
    rows = _run(spark, "DIV", AB)
    assert rows == [(2.0, None), (None, None), (None, None), (None, "Could not divide the value 2.0 by 0.0")]


def test_split(spark):
    assert _run(spark, "SPLIT", [("t", 1)], characters=3, extra="rest") == [
        ("abc", "def", None),
        ("ab", None, "Could not split the value ab for 3 characters"),
        ("", "", None),
        ("abc", "", None),
    ]


def test_formula(spark):
    rows = _run(spark, "MC", [("a", 1), ("b", 4)], expression="<1> / <4>")
    assert [r[0] for r in rows] == [2.0, None, None, None]
    assert rows[3][1] == "Failed to solve the expression. <1> / <4>"
    rows = _run(spark, "MC", [("u", 1)], expression="<1> * 2")
    assert [r[0] for r in rows] == [10.0, None, 0.0, -4.0]
    assert rows[1][1].startswith("Expresion contains non numeric operand(s)")


def test_direct(spark):
    assert [r[0] for r in _run(spark, None, [("a", 1)], "direct", "integer")] == [6, -1, None, 2]
    assert [r[0] for r in _run(spark, None, [("u", 1)], "direct", "decimal")] == [5.0, None, None, -2.0]
    assert [r[0] for r in _run(spark, None, [("t", 1)], "direct")] == ["abcdef", "ab", "", "abc"]
    assert [r[0] for r in _run(spark, None, [], "direct")] == [None] * 4


def test_date_mask(spark):
    rows = _run(spark, None, [("t", 1)], "date-mask", date_format="%Y")
    assert rows[0] == (None, "The value abcdef is not in the proper Date Format")
    assert rows[2] == (None, None)


@pytest.mark.parametrize(
    ("operation", "error"),
    [
        ("DIV", "Using fields of different input files"),
        ("DC", "Using fields of different input files"),
        ("MC", "Multiple files used for the conversion."),
    ],
)
def test_fields_of_different_files(operation, error):
    sources = (SourceField("f.csv", "a", 1), SourceField("g.csv", "b", 2))
    row = MappingRow("calculated", "out", "r", "decimal", sources, operation, expression="<1>+<2>")
    assert compile_row(row, KINDS) == JobError("out", error)


def test_unknown_operation():
    with pytest.raises(ValueError, match="NOPE"):
        compile_row(MappingRow("calculated", "out", "r", "string", (), "NOPE"), {})
