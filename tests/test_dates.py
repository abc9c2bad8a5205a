import re
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.dates import DATE_REGEX, is_date, masked_timestamp, spark_pattern
from ledgerloom.functions.written_dates import is_written_date

MASKED = [
    ("%d/%m/%Y", "05/11/2021"),
    ("%d/%m/%Y", "5/1/2021"),
    ("%d/%m/%Y", "31/02/2021"),
    ("%d/%m/%Y", "2021-01-01"),
    ("%Y%m%d", "20210105"),
    ("%d-%b-%y", "29-Nov-75"),
    ("%d-%b-%y", "29-nov-68"),
    ("%d-%b-%y", "01-JAN-69"),
    ("%d %B %Y", "7 January 2020"),
    ("%Y-%m-%d %H:%M:%S", "2020-01-02 3:04:05"),
    ("%m/%d/%Y %I:%M %p", "01/02/2020 11:05 PM"),
    ("%Y-%m-%dT%H:%M:%S", "2020-01-02T03:04:05"),
    ("day %d of %m in %Y", "day 3 of 4 in 2020"),
]


def _by_hand(mask, text):
    try:
        return datetime.strptime(text, mask).strftime("%Y-%m-%dT%H:%M:%SZ")
    except ValueError:
        return None


@pytest.mark.parametrize(("mask", "text"), MASKED)
def test_masked_timestamp_agrees_with_strptime(spark, mask, text):
    row = spark.createDataFrame([(text,)], "c string").select(masked_timestamp(F.col("c"), mask).alias("v")).first()
    assert row.v == _by_hand(mask, text)


def test_unknown_mask_code_is_refused():
    with pytest.raises(ValueError, match="%U"):
        spark_pattern("%U")


DATES = [
    ("2020-01-05", True), ("2020-1-5 10:20:30", True), ("2020-01-05T10:20:30Z", True),
    ("2020-01-05T10:20:30.123456", True), ("05/11/2021", True), ("25/11/2021", True), ("11/25/2021", True),
    ("20210105", True), ("5 Jan 2020", True), ("5-Mar-99", True), ("January 5, 2020", True),
    ("2020-02-29 23:59", True), ("Feb 29, 2021", False), ("29/02/00", True), ("Sept 30 2020", True), ("2020-07", True), ("Mon, 5 Jan 2020", True),
    ("2020-13-45", False), ("2020-01-05 24:00:00", False), ("2020-01-05x", False), ("31 June 2020", False), ("soon", False), ("", False), ("35/35/2020", False), (None, True),
]


def test_is_date(spark):
    df = spark.createDataFrame([(c,) for c, _ in DATES], "c string")
    assert [(r.c, r.v) for r in df.select("c", is_date(F.col("c")).alias("v")).collect()] == DATES


FORMS = ["{y:04}-{m:02}-{d:02}", "{y:04}{m:02}{d:02}", "{y:04}/{m}/{d}", "{d} {n} {y:04}", "{n} {d}, {y:04}", "{d:02}-{n}-{y:04}"]
NAMES = ["Zed", "Jan", "February", "MAR", "april", "May", "Jun", "July", "Aug", "September", "Oct", "nov", "December", "Non"]


def _is_real(y, m, d):
    try:
        date(y, m, d)
    except ValueError:
        return False
    return True


@pytest.mark.parametrize("form", FORMS)
def test_date_regex_knows_the_calendar(form):
    pattern = re.compile(DATE_REGEX)
    for y in (1900, 1996, 2000, 2019, 2100, 2400):
        for m in range(14):
            for d in range(33):
                text = form.format(y=y, m=m, d=d, n=NAMES[m])
                assert bool(pattern.match(text)) == _is_real(y, m, d), text


@pytest.mark.parametrize("form", ["{m}/{d}/{y:04}", "{d:02}.{m:02}.{y:04}", "{m:02}-{d:02}-{y:04}"])
def test_day_and_month_may_be_swapped(form):
    pattern = re.compile(DATE_REGEX)
    for y in (2019, 2000):
        for m in range(14):
            for d in range(33):
                text = form.format(y=y, m=m, d=d)
                assert bool(pattern.match(text)) == (_is_real(y, m, d) or _is_real(y, d, m)), text


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_masks_with_fractions_weekdays_and_zones(spark, zone):
    cells = [
        ("2020-03-08 02:30:00.25", "%Y-%m-%d %H:%M:%S.%f", "2020-03-08T02:30:00Z"),
        ("Sun, 08 Mar 2020", "%a, %d %b %Y", "2020-03-08T00:00:00Z"),
        ("Sunday 08/03/2020", "%A %d/%m/%Y", "2020-03-08T00:00:00Z"),
        ("08/03/2020", "%A %d/%m/%Y", None),
        ("2020-03-08T02:30:00+0100", "%Y-%m-%dT%H:%M:%S%z", "2020-03-08T02:30:00Z"),
        ("2020-03-08 02:30 UTC", "%Y-%m-%d %H:%M %Z", "2020-03-08T02:30:00Z"),
        ("2020-03-08 02:30 XYZ", "%Y-%m-%d %H:%M %Z", None),
        ("1/2/69", "%d/%m/%y", "1969-02-01T00:00:00Z"),
        ("", "%d/%m/%y", None),
        (None, "%d/%m/%y", None),
    ]
    df = spark.createDataFrame([(c,) for c, _, _ in cells], "c string")
    key = "spark.sql.session.timeZone"
    before = spark.conf.get(key)
    spark.conf.set(key, zone)
    try:
        for cell, mask, want in cells:
            rows = df.filter(F.col("c").eqNullSafe(F.lit(cell))).select(masked_timestamp(F.col("c"), mask).alias("v")).collect()
            assert rows[0]["v"] == want, (cell, mask)
    finally:
        spark.conf.set(key, before)


WRITTEN = {
    True: [
        "20200102T101112", "20200102101112", "202001021011", "20200102", "200102", "Jan 5", "5 Jan", "January", "5th March 2020", "March 5th, 2020",
        "2 January 2020 at 10:00", "the 2nd of January 2020", "2020-01-02 10:30 EST", "10:30", "10:30:15.25", "10:30 pm", "10 pm", "Jan 5 10am",
        "1/2", "2/30/20x".replace("2/30/20x", "30/1"), "1/2/2020 10:30 +05:30", "10:30 -0400", "Tuesday, 3 March 2020 10:30 PM GMT", "29 Feb 2020", "Feb 29",
        "29 February 2000 at 1:00", "2020 Jan", "Jan 2020", "Jan 85", "85 Jan 2", "2020/1", "12/2020", "99-12-31", "20200102T10", "20200102T1011Z", "2020",
        "SEPT 3 2020", "3.March.2020",
    ],
    False: [
        "", "soon", "5", "123", "12345", "20201301", "20200230T101112", "20200102T251112", "20200102246000", "31 April 2020", "Feb 30", "29 Feb 2019",
        "29 February 1900 at 1:00", "13/32", "0/1", "25:00", "10:61", "10:30 10:31", "Jan Feb", "Jan 5 6 2020", "1/2/3/4", "EST", "10:30 EST EST", "10:30 +", "10:30 +9999",
        "Jan 5 pm 3 pm", "13 pm", "5th of nowhere", "2020-13-45", "T10", "20200102T", "1/2 *", "th 5", "99999999999999999999", "10:30 T", "2020 2021", "+5",
    ],
}


def test_written_dates(spark):
    rows = [(t, want) for want, texts in WRITTEN.items() for t in texts]
    df = spark.createDataFrame(rows, "c string, want boolean")
    wrong = df.select("*", is_date(F.col("c")).alias("found")).where("found <> want OR found IS NULL").collect()
    assert not wrong
    assert spark.createDataFrame([(None,)], "c string").select(is_date(F.col("c")).alias("v")).first().v


def test_written_dates_know_the_calendar(spark):
    rows = [(f"{d} {NAMES[m]} {y} at 10:00", _is_real(y, m, d)) for y in (1900, 1996, 2000, 2019) for m in range(1, 13) for d in (1, 28, 29, 30, 31, 32)]
    rows += [(f"{y:04}{m:02}{d:02}T0900", _is_real(y, m, d)) for y in (1900, 1996, 2000, 2019) for m in range(14) for d in (0, 1, 28, 29, 30, 31, 32)]
    df = spark.createDataFrame(rows, "c string, want boolean")
    assert not df.where(is_written_date(F.col("c")) != F.col("want")).collect()
