import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources.groupings import read_grouping_lines, read_groupings
from ledgerloom.sources.reports import _beyond, read_headed_csv, read_lines, read_report, read_report_with_check
from ledgerloom.spec import HeaderCheck

REPORT = """Closing Figures,,,
Harbour Mill,,,
,,,
Account,Closing,Account,
,,,
Timber (317),-£55.10,a,
"Ropes, Sails (622)","£2,310.75",NULL,
Till (008),"-£2,255.65", ,
Total ,£0.00,,
"""


def _write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


def _rows(df):
    return [tuple(r) for r in df.orderBy("_ord").collect()]


def test_preamble_header_and_tokens(spark, tmp_path):
    df = read_report(spark, _write(tmp_path / "tb report.csv", REPORT), 4)
    assert df.columns == ["_ord", "Account", "Closing", "Account.1", "NO_NAME3"]
    assert _rows(df) == [
        (6, "Timber (317)", "-£55.10", "a", None),
        (7, "Ropes, Sails (622)", "£2,310.75", None, None),
        (8, "Till (008)", "-£2,255.65", None, None),
        (9, "Total ", "£0.00", None, None),
    ]


def test_blank_lines_before_the_header(spark, tmp_path):
    path = _write(tmp_path / "r.csv", "x\n\n\na,b\n1,2\n\n3\n4,5, ,\n")
    assert _rows(read_report(spark, path, 2)) == [(5, "1", "2"), (7, "3", None), (8, "4", "5")]


def test_surplus_cells_are_refused_or_named(spark, tmp_path):
    path = _write(tmp_path / "r.csv", "item,amount\npipe,2,700\nnut,3\nbolt,4,,x,y\n")
    with pytest.raises(Exception, match="line 2 has more cells than the header: 700|line 4"):
        read_report(spark, path)
    assert _rows(read_report(spark, path, surplus=True)) == [
        (2, "pipe", "2", "700"), (3, "nut", "3", None), (4, "bolt", "4", "x,y")
    ]


def test_surplus_cells_far_beyond_the_header(spark, tmp_path):
    far = "," * 20
    path = _write(tmp_path / "r.csv", f'item,amount\n"a,b",1{far}remark\nnut,2{far}\n"c\nd",3,x{far * 20}"far, ""off""\n"\nbolt,4\n')
    assert _rows(read_report(spark, path, surplus=True)) == [
        (2, "a,b", "1", "remark"), (3, "nut", "2", None), (4, "c\nd", "3", 'x,far, "off"\n'), (7, "bolt", "4", None)
    ]
    one = _write(tmp_path / "one.csv", f"item,amount\npipe,2{far}remark\n")
    with pytest.raises(Exception, match="line 2 has more cells than the header: remark"):
        read_report(spark, one)
    with pytest.raises(Exception, match="line 2 has more cells than the header: remark"):
        read_headed_csv(spark, one).collect()


def test_unclosed_cells_cost_their_line_only(spark, tmp_path):
    folder = tmp_path / "many"
    folder.mkdir()
    _write(folder / "a.csv", 'item,amount\n"a\nb",1\nnut,2\nbolt,"3\nrod,4\ncap,5\n')
    _write(folder / "b.csv", 'item,amount\n"c, d",6\n"lost,7\n')
    _write(folder / "c.csv", 'item,amount\n"e\n\nf",8\n')
    path = str(folder)
    rows = [r[1:] for r in _rows(read_report(spark, path, unclosed=True))]
    assert rows == [
        ("a\nb", "1", None), ("nut", "2", None), ("bolt", '"3', 'bolt,"3'), ("rod", "4", None), ("cap", "5", None),
        ("c, d", "6", None), ('"lost', "7", '"lost,7'), ("e\n\nf", "8", None),
    ]
    for surplus in (False, True):
        with pytest.raises(Exception, match="opens a quoted cell that is never closed"):
            read_report(spark, path, surplus=surplus)


def test_unclosed_cells_after_each_other(spark, tmp_path):
    """Below an unclosed cell, reading starts again from outside and can meet another one."""
    path = _write(tmp_path / "r.csv", 'a,b\n1,"x\n2,""\n3,""y\n4,z\n')
    found = {r[1]: r[3] for r in _rows(read_report(spark, path, unclosed=True))}
    assert found.keys() == {"1", "2", "3", "4"} and found["1"] == '1,"x' and found["4"] is None


@pytest.mark.parametrize("seed", range(2))
def test_surplus_cells_like_the_parser(spark, seed):
    """Against the CSV parser with a column for every cell; where text follows a closing sign, but for the signs."""
    r = random.Random(seed)
    loose = ["".join(r.choices('ab",, "é\\', k=r.randint(1, 14))) for _ in range(2000)]
    cells = ["a", "", '"b"', '"c,d"', '"e""f"', " g ", '"h\ni"', '""', '" "', "x\"y"]
    clean = [",".join(r.choices(cells, k=r.randint(1, 12))) for _ in range(2000)] + ['"' + 'x""' * 20000 + '",a,"b,c"']
    schema = ", ".join(f"c{i} string" for i in range(15))
    df = spark.createDataFrame([(v, False) for v in loose] + [(v, True) for v in clean], "value string, clean boolean")
    parsed = df.where("trim(value) <> ''").select("*", F.from_csv("value", schema, {"escape": '"'}).alias("r"), _beyond(F.col("value"), 1).alias("beyond"))
    for row in parsed.collect():
        got, want = row.beyond or "", ",".join(c for c in row.r[1:] if c and c.strip(" "))
        assert got == want if row.clean else got.replace('"', "") == want.replace('"', ""), row.value


STRAY = """item,amount
12" pipe,2
"say ""hi""\n",3
nut 5",4
"6"" tube",5
"two
lines, 7""
and 8",6
a"b"c,7
"""


@pytest.mark.parametrize("rows, buckets", [(10_000, 65_536), (1, 64)])
def test_stray_quotes_and_real_multi_line_cells_over_many_splits(spark, tmp_path, monkeypatch, rows, buckets):
    monkeypatch.setattr("ledgerloom.operators.ordinals.MIN_BUCKET_ROWS", rows)
    monkeypatch.setattr("ledgerloom.operators.ordinals.MAX_BUCKETS", buckets)
    body = STRAY.split("\n", 1)[1].replace("\\n", "\n")
    text = "item,amount\n" + body * 60
    path = _write(tmp_path / "r.csv", text)
    expected = [tuple(r) for r in csv.reader(io.StringIO(text))][1:]
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, 700)
    try:
        got = [r[1:] for r in _rows(read_report(spark, path))]
    finally:
        spark.conf.set(key, before)
    assert got == [tuple(c for c in r) for r in expected]


def test_headed_csv_with_quotes_and_line_breaks(spark, tmp_path):
    rows = [('see "x", then y', "1"), ("line1\nline2", "2"), ("plain", None)]
    spark.createDataFrame(rows, "a string, b string").write.option("header", True).option("escape", '"').csv(str(tmp_path / "out"))
    assert sorted(map(tuple, read_headed_csv(spark, str(tmp_path / "out")).collect())) == sorted(rows)


@pytest.mark.parametrize("encoding", ["utf-8", "iso-8859-1"])
def test_encoding_is_decided_per_file(spark, tmp_path, encoding):
    text = "name,note\nCafé £,plain\nascii,ÿ\n"
    df = read_report(spark, _write(tmp_path / "r.csv", text, encoding))
    assert _rows(df) == [(2, "Café £", "plain"), (3, "ascii", "ÿ")]


def test_one_bad_line_switches_the_whole_file(spark, tmp_path):
    content = "name\n".encode() + "é\n".encode("utf-8") + "é\n".encode("iso-8859-1")
    (tmp_path / "r.csv").write_bytes(content)
    assert [r[1] for r in _rows(read_report(spark, str(tmp_path / "r.csv")))] == ["Ã©", "é"]


def test_quoted_cells_over_several_lines(spark, tmp_path):
    text = 'a,b\n1,"x\ny"\n2,"say ""hi"""\n"p\n\n""q""\nr",3\n4,5\n'
    df = read_report(spark, _write(tmp_path / "r.csv", text))
    assert _rows(df) == [
        (2, "1", "x\ny"),
        (4, "2", 'say "hi"'),
        (5, 'p\n\n"q"\nr', "3"),
        (9, "4", "5"),
    ]


def test_unclosed_quote_is_refused(spark, tmp_path):
    with pytest.raises(Exception, match="never closed"):
        read_report(spark, _write(tmp_path / "r.csv", 'a,b\n1,"x\n2,3\n'))


def test_missing_header(spark, tmp_path):
    with pytest.raises(ValueError, match="no header"):
        read_report(spark, _write(tmp_path / "r.csv", "a\n1\n"), 9)


def test_lines_keep_their_number_over_many_splits(spark, tmp_path):
    """Small splits: every line is numbered once, in file order, whatever the partitioning."""
    folder = tmp_path / "parts"
    folder.mkdir()
    for part in range(3):
        _write(folder / f"p{part}.csv", "".join(f"{part}-{i},{'x' * (i % 37)}\n" for i in range(2000)))
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, 4096)
    try:
        lines = read_lines(spark, str(folder))
    finally:
        spark.conf.set(key, before)
    rows = lines.orderBy("_ord").select("_ord", "_line", "value").collect()
    assert [r["_ord"] for r in rows] == list(range(1, 6001))
    assert [r["_line"] for r in rows] == list(range(1, 2001)) * 3
    assert [r["value"].split(",")[0] for r in rows] == [f"{p}-{i}" for p in range(3) for i in range(2000)]


def test_headed_csv_is_all_text(spark, tmp_path):
    df = read_headed_csv(spark, _write(tmp_path / "x.csv", "a,b\n1,\n2,z\n"))
    assert df.dtypes == [("a", "string"), ("b", "string")]
    assert [tuple(r) for r in df.collect()] == [("1", None), ("2", "z")]


CODES = [
    {"nominalCode": "800", "account": "Current Assets", "description": "Payables "},
    {"nominalCode": "90", "account": None, "description": "Bank"},
]


@pytest.mark.parametrize(
    "response",
    [
        {"data": {"nominalCodeMappings": {"metadata": 1, "grouping": CODES}}},
        {"data": {"getDataIngestionGroupings": [{"id": "a", "grouper": {"groupingCodes": CODES}}]}},
        {"data": {"getDataIngestionGroupings": {"id": "a", "grouper": {"groupingCodes": CODES}}}},
    ],
)
def test_groupings_in_both_shapes(spark, tmp_path, response):
    path = _write(tmp_path / "g.json", json.dumps(response, indent=2))
    rows = read_groupings(spark, path).select("nominalCode", "account", "description").collect()
    assert sorted(tuple(r) for r in rows) == sorted((c["nominalCode"], c["account"], c["description"]) for c in CODES)


def test_groupings_without_rows(spark, tmp_path):
    with pytest.raises(ValueError, match="no grouping"):
        read_groupings(spark, _write(tmp_path / "g.json", '{"data": {"other": 1}}'))


def test_grouping_lines_of_either_shape(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    flat = '{"data": {"nominalCodeMappings": {"grouping": [{"nominalCode": "1", "account": "A", "description": "x"}, {"nominalCode": 2}]}}}'
    nested = '{"data": {"getDataIngestionGroupings": [{"grouper": {"groupingCodes": [{"nominalCode": "3", "accountType": "B"}]}}, {"id": 1}]}}'
    _write(folder / "a.json", flat + "\n" + nested + "\n\n")
    _write(folder / "b.json", '{"data": null}\n{"data": {"nominalCodeMappings": {"grouping": []}}}\n' + nested.replace('"3"', '"4"'))
    rows = read_grouping_lines(spark, str(folder)).select("nominalCode", "account", "description").collect()
    assert sorted(map(tuple, rows)) == [("1", "A", "x"), ("2", None, None), ("3", "B", None), ("4", "B", None)]


def test_found_headers(spark, tmp_path):
    check = HeaderCheck({"amount": ("Debit", "Credit"), "code": ("Account",)}, {"amount": 2, "code": 1})
    folder = tmp_path / "found"
    folder.mkdir()
    _write(folder / "a.csv", "Debit report\nDebit,Account,,\n\nAccount,Debit,Credit,Debit\n1,2,3,4\nAccount,Debit,Credit,Debit\n")
    _write(folder / "b.csv", '﻿"Credit", Account ,Debit\n5,"6\n7",8\n')
    rows = read_report_with_check(spark, str(folder), check)
    assert set(rows.columns) == {"_ord", "Account", "Debit", "Credit", "Debit.1"}
    found = [tuple(r[c] for c in ("Account", "Debit", "Credit", "Debit.1")) for r in rows.orderBy("_ord").collect()]
    assert found == [("1", "2", "3", "4"), ("Account", "Debit", "Credit", "Debit"), ("6\n7", "8", "5", None)]
    _write(folder / "c.csv", "Account,Debit\n1,2\n")
    with pytest.raises(ValueError, match="no header line"):
        read_report_with_check(spark, str(folder), check)
