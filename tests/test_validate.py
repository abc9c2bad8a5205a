from pyspark.sql import functions as F

from ledgerloom.operators import validate
from ledgerloom.spec import TypedField

FIELDS = (TypedField("amount", "decimal"), TypedField("*name", "string"), TypedField("ok", "boolean"), TypedField("on", "date"))
ROWS = [
    (10, "£1,000.50", "nan", "TRUE", "2020-01-05"),
    (20, "abc", None, "yes", None),
    (30, None, "x", "False", "soon"),
    (40, "(3)", "y", None, ""),
    (50, "4", "z", "true", "5 Jan 2020"),
]


def _checked(spark):
    df = spark.createDataFrame(ROWS, "_ord long, amount string, `*name` string, ok string, on string")
    return validate.validate(df, FIELDS, ["_ord"])


def test_values_and_flags(spark):
    rows = _checked(spark).orderBy("_ord").collect()
    assert [r.amount for r in rows] == [1000.5, None, None, -3.0, 4.0]
    assert [r["amount_type_valid"] for r in rows] == [True, False, True, True, True]
    assert [r["*name"] for r in rows] == ["", "", "x", "y", "z"]
    assert [r.ok for r in rows] == [True, None, False, None, True]
    assert [r["ok_type_valid"] for r in rows] == [True, False, True, False, True]
    assert [r.on for r in rows] == ["2020-01-05", "", "soon", "", "5 Jan 2020"]
    assert [r["on_type_valid"] for r in rows] == [True, True, False, False, True]


def test_type_errors_count_rows_from_one(spark):
    errors = validate.type_errors(_checked(spark), FIELDS, "glDetail", "gl.csv", "_ord").orderBy("data_row")
    assert [(r.data_row, r.field_name, r.error) for r in errors.collect()] == [
        (2, "amount (decimal)|ok (boolean)", "Invalid Data Type"),
        (3, "on (date)", "Invalid Data Type"),
        (4, "ok (boolean)|on (date)", "Invalid Data Type"),
    ]


def test_good_and_bad_rows_add_up(spark):
    checked = _checked(spark)
    good = validate.valid_rows(checked, FIELDS, ["_ord"])
    bad = validate.bad_rows(checked, FIELDS, ["_ord"])
    assert sorted(r["_ord"] for r in good.collect()) == [10, 50]
    assert sorted(r["_ord"] for r in bad.collect()) == [20, 30, 40]
    assert good.columns == ["_ord", "amount", "*name", "ok", "on"]


def test_unknown_type_is_always_invalid(spark):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    value, valid = validate.checked(F.col("c"), "colour")
    assert [tuple(r) for r in df.select(value, valid).collect()] == [("a", False), (None, False)]


def test_gate_drops_reports_with_errors(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "report_name string, x int")
    errors = spark.createDataFrame([("a", None), ("a", None), ("c", None)], "report_name string, error string")
    assert [r.x for r in validate.passing_reports(rows, errors).collect()] == [3]


def test_errors_are_sorted_by_report_and_row(spark):
    def table(*rows):
        return spark.createDataFrame([(r, None, "f", "g", n, "e") for r, n in rows], validate.ERROR_SCHEMA)

    ordered = validate.sorted_errors(table(("b", 2), ("a", 9), ("b", None)), table(("b", 1), ("a", 10)))
    assert [(r.report_name, r.data_row) for r in ordered.collect()] == [("a", 9), ("a", 10), ("b", 1), ("b", 2), ("b", None)]
