import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import ordinals
from ledgerloom.operators.align import align_by_position
from ledgerloom.operators.ordinals import dense_ordinal, journal_line_numbers, sequence_gaps


@pytest.fixture(params=[(1, 1), (7, 3), (10_000, 65_536)], ids=str)
def bucket_sizes(request, monkeypatch):
    """Small buckets put bucket borders into small fixtures."""
    rows, buckets = request.param
    monkeypatch.setattr(ordinals, "MIN_BUCKET_ROWS", rows)
    monkeypatch.setattr(ordinals, "MAX_BUCKETS", buckets)


def _ledger(seed, n=400):
    """Rows whose hot journal holds a third of them; order keys are unique and sparse."""
    rng = random.Random(seed)
    ords = sorted(rng.sample(range(-50, 10 * n), n))
    return [(o, rng.choice(["hot", None, "", *[f"j{i}" for i in range(40)]]) if i % 3 else "hot") for i, o in enumerate(ords)]


@pytest.mark.parametrize("partitions", [1, 50])
def test_dense_ordinal(spark, bucket_sizes, partitions):
    rows = _ledger(1)
    df = spark.createDataFrame(rows, "o long, j string").repartition(partitions)
    got = {r.o: r.place for r in dense_ordinal(df, "o", "place", start=1).collect()}
    assert got == {o: i + 1 for i, (o, _) in enumerate(rows)}


@pytest.mark.parametrize("partitions", [1, 50])
@pytest.mark.parametrize("hot_rows", [1, 10, 100, 10_000])
def test_journal_line_numbers(spark, monkeypatch, hot_rows, partitions):
    monkeypatch.setattr(ordinals, "HOT_JOURNAL_ROWS", hot_rows)
    rows = _ledger(2)
    df = spark.createDataFrame(rows, "o long, j string").repartition(partitions)
    seen, expected = Counter(), {}
    for o, j in rows:
        seen[j or ""] += 1
        expected[o] = seen[j or ""]
    got = {r.o: r.line for r in journal_line_numbers(df, "j", ["o"], "line").collect()}
    assert got == expected


def test_an_outlier_key_leaves_the_others_spread(spark):
    rows = [(i,) for i in range(200_000)] + [(10**17,)]
    cut = spark.createDataFrame(rows, "o long").withColumn("b", ordinals.order_bucket(spark.createDataFrame(rows, "o long"), "o"))
    sizes = [r["count"] for r in cut.groupBy("b").count().collect()]
    assert max(sizes) < 30_000


def test_rows_without_order_key_are_numbered_first(spark):
    df = spark.createDataFrame([(5,), (None,), (7,)], "o long")
    assert {r.o: r.n for r in dense_ordinal(df, "o", "n").collect()} == {None: 0, 5: 1, 7: 2}


def test_a_hot_journal_of_one_day_runs_in_ranges(spark, monkeypatch):
    monkeypatch.setattr(ordinals, "HOT_JOURNAL_ROWS", 50)
    rows = [("2020-01-01", i * 7919 % 1000, "j" if i % 5 else f"k{i}") for i in range(1000)]
    df = spark.createDataFrame(rows, "day string, line long, j string")
    numbered = journal_line_numbers(df, "j", ["day", "line"], "n")
    got = {(r.j, r.line): r.n for r in numbered.collect()}
    hot = sorted(line for _, line, j in rows if j == "j")
    assert [got["j", line] for line in hot] == list(range(1, len(hot) + 1))
    assert all(n == 1 for (j, _), n in got.items() if j != "j") and len(got) == 1000


def test_long_ids_are_compared_exactly(spark):
    ids = [str(90071992547409930 + i) for i in range(20)] + ["90071992547409951"]
    df = spark.createDataFrame(list(enumerate(ids)), "o long, id string")
    assert sequence_gaps(df, "id", "o").first()["gaps"] == 1


def test_line_numbers_of_a_small_ledger(spark):
    rows = list(enumerate([1, 1, 1, 1, 1, 2, 2, 2, 2, 2]))
    df = spark.createDataFrame(rows, "o long, j long")
    lines = [r.line for r in journal_line_numbers(df, "j", ["o"], "line").orderBy("o").collect()]
    assert lines == [1, 2, 3, 4, 5, 1, 2, 3, 4, 5]


def _gaps_by_hand(ids):
    numbers = [float(i) for i in ids]
    gaps = sum(1 for a, b in zip(numbers, numbers[1:]) if b - a != 1)
    return gaps, 100 * (len(ids) - gaps) // len(ids)


@pytest.mark.parametrize(
    "ids",
    [
        ["1", "4", "2", "5", "3", "1", "2", "3", "4", "5"],
        [str(i) for i in range(60)],
        ["5"],
        [str(i + (i > 20) + (i > 21)) for i in range(60)],
        ["1", "1", "2", "2.0", "3"],
    ],
)
def test_sequence_gaps(spark, bucket_sizes, ids):
    df = spark.createDataFrame([(i * 3, v) for i, v in enumerate(ids)], "o long, j string").repartition(9)
    row = sequence_gaps(df, "j", "o").first()
    gaps, percent = _gaps_by_hand(ids)
    assert (row.n, row.gaps, row.percent, row.complete, row.warning) == (len(ids), gaps, percent, gaps == 0, None)


@pytest.mark.parametrize(
    ("ids", "warning"),
    [(["1", "x"], ordinals.WARN_NOT_NUMERIC), (["1", None], ordinals.WARN_NOT_NUMERIC), ([], ordinals.WARN_BLANK)],
)
def test_sequence_warnings(spark, ids, warning):
    df = spark.createDataFrame(list(enumerate(ids)), "o long, j string")
    row = sequence_gaps(df, "j", "o").first()
    assert (row.gaps, row.percent, row.complete, row.warning) == (None, 0, False, warning)


def test_align_pads_the_shorter_frame(spark, bucket_sizes):
    left = spark.createDataFrame([(10, "a"), (5, "b"), (70, "c")], "o long, l string")
    right = spark.createDataFrame([(1, "x")], "p long, r string")
    rows = align_by_position([(left, "o"), (right, "p")]).orderBy("_position").collect()
    assert [(r["_position"], r.l, r.r) for r in rows] == [(0, "b", "x"), (1, "a", None), (2, "c", None)]


def test_a_hot_journal_is_spread_over_tasks(spark, monkeypatch):
    """A journal with a third of all rows is numbered in pieces of about the given size."""
    monkeypatch.setattr(ordinals, "HOT_JOURNAL_ROWS", 100)
    journal = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string"))
    df = spark.range(6000).select(F.col("id").alias("o"), journal.alias("j"))
    numbered = journal_line_numbers(df, "j", ["o"], "line")
    plan = numbered._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "row_number()" in line and "Window" in line]
    assert any("_range" in w for w in windows)
    assert numbered.filter("j = 'hot'").agg(F.max("line"), F.count_distinct("line")).first()[:] == (2000, 2000)


def test_only_wanted_rows_are_returned(spark, bucket_sizes):
    df = spark.createDataFrame([(o, o % 97 == 0) for o in range(0, 2000, 5)], "o long, bad boolean")
    rows = dense_ordinal(df, "o", "place", start=1, wanted=F.col("bad")).collect()
    assert sorted((r.o, r.place) for r in rows) == [(o, o // 5 + 1) for o in range(0, 2000, 485)]
