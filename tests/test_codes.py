import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.codes import code_inside, code_outside, numeric_pieces, trimmed_account_name

INSIDE = [
    ("Marketing (400)", "400"),
    ("Leisure - 100% business (400)", " 100% business (400)"),
    ("Leisure-100% business (420)", "100% business (420)"),
    ("Gas, Water, Heat (445)", "445"),
    ("Balance (700) (qabc)", "700 "),
    ("A ( 700 )", "A "),
    ("A (700) (q)", "700 "),
    ("(12) tail", "(12) tail"),
    ("No code (x)", "No code "),
    ("No code", None),
    ("", None),
    (None, None),
]
OUTSIDE = [
    ("Marketing (400)", "Marketing "),
    ("Leisure - 100% business (400)", "Leisure - 100% business "),
    ("Balance (700) (700)", "Balance  "),
    ("Balance (7x0) (q)", "Balance (7x0) (q)"),
    ("A (x) (700)", "A (x) (700)"),
    ("A (700", "A "),
    ("A) (700)", "A) (700)"),
    ("A ((700)", "A "),
    ("No code", None),
    (None, None),
]


def _apply(spark, cells, expression):
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    return [r.v for r in df.select(expression(F.col("c")).alias("v")).collect()]


def _inside_by_hand(text):
    """The rule in plain Python, as a cross-check."""
    if text is None or "(" not in text:
        return None
    if "-" in text:
        return text.rsplit("-", 1)[1]
    pieces = [p.replace(")", "") for p in reversed(text.split("("))]
    for i, piece in enumerate(pieces):
        if (piece if i == 0 else piece.strip()).isdigit():
            return piece
    return pieces[-1]


def test_code_inside(spark):
    texts = [t for t, _ in INSIDE]
    got = _apply(spark, texts, lambda c: code_inside(c, "(", ")"))
    assert got == [_inside_by_hand(t) for t in texts]
    assert got[:5] == [e for _, e in INSIDE[:5]]
    assert got[8:] == [e for _, e in INSIDE[8:]]


def test_code_outside(spark):
    assert _apply(spark, [t for t, _ in OUTSIDE], lambda c: code_outside(c, "(", ")")) == [e for _, e in OUTSIDE]


def test_equal_delimiters(spark):
    assert _apply(spark, ["a|7|b"], lambda c: code_outside(c, "|", "|")) == ["a7b"]


def test_numeric_pieces(spark):
    got = _apply(spark, ["43500 - some - text", "a - 7 - 8", "plain"], lambda c: numeric_pieces(c, "-"))
    assert got == [["43500"], ["7", "8"], None]


@pytest.mark.parametrize(
    ("raw", "expected"),
    [(" - Cash ", "Cash"), ("-Cash", "Cash"), ("-  Cash", " Cash"), ("Cash", "Cash"), ("--Cash", "-Cash"), ("", "")],
)
def test_trimmed_account_name(spark, raw, expected):
    assert _apply(spark, [raw], trimmed_account_name) == [expected]
