"""Order-sensitive operators without a global window.

Rows are cut into buckets by the range of their order key. Work inside a bucket is a parallel window; a
table with one row per bucket, never more than ``MAX_BUCKETS``, carries what crosses bucket borders. A key
that owns a large part of the rows is thereby spread over its buckets too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions.columns import named
from ledgerloom.runtime import durable, lookup_side

MAX_BUCKETS = 65_536
MIN_BUCKET_ROWS = 10_000
SEGMENTS = 64
# Rows, on average, whose keys show the distribution.
SAMPLE_ROWS = 50_000
HOT_JOURNAL_ROWS = 1_000_000


def order_bucket(df: DataFrame, ord_col: str) -> Column:
    """Bucket number of a whole-number order key, never decreasing along it; null keys come first.

    Borders follow the key's distribution: approximate quantiles cut the rows into ``SEGMENTS`` parts, and each part is
    cut evenly. An outlier can therefore empty the cuts of its own part only. Quantiles of a sample are enough, since
    borders decide only how even the cuts are. The borders are looked up once, so every use of the column agrees on them.
    """
    key = named(ord_col).cast("bigint")
    keys = df.select(key.alias("k"))
    found = keys.agg(F.min("k").alias("low"), F.max("k").alias("high"), F.count("k").alias("n")).first()
    if found["low"] is None:
        return F.lit(0).cast("bigint")
    cuts = []
    if found["n"] > MIN_BUCKET_ROWS and found["high"] - found["low"] >= MIN_BUCKET_ROWS:
        shares = [i / SEGMENTS for i in range(SEGMENTS + 1)]
        some = keys.where("k IS NOT NULL").sample(min(1.0, SAMPLE_ROWS / found["n"]), seed=0)
        cuts = some.agg(F.percentile_approx("k", shares, 10 * SEGMENTS).alias("cuts")).first()["cuts"] or []
    starts = sorted({found["low"], *(c for c in cuts if c <= found["high"])})
    ends = [*starts[1:], found["high"] + 1]
    widths = [max(MIN_BUCKET_ROWS, -(-(e - s) // max(1, MAX_BUCKETS // SEGMENTS))) for s, e in zip(starts, ends)]
    first, firsts = 1, []
    for s, e, w in zip(starts, ends, widths):
        firsts.append(first)
        first += -(-(e - s) // w)

    name = f"CAST(`{ord_col.replace('`', '``')}` AS BIGINT)"

    def pick(low: int, high: int) -> str:
        """Balanced tree of comparisons."""
        if high - low == 1:
            return f"{firsts[low]} + CAST((({name} - {starts[low]}) div {widths[low]}) AS BIGINT)"
        middle = (low + high) // 2
        return f"CASE WHEN {name} < {starts[middle]} THEN {pick(low, middle)} ELSE {pick(middle, high)} END"

    return F.expr(f"CASE WHEN {name} IS NULL THEN 0 ELSE {pick(0, len(starts))} END").cast("bigint")


def dense_ordinal(
    df: DataFrame, ord_col: str, out: str, start: int = 0, wanted: Column | None = None
) -> DataFrame:
    """Adds consecutive numbers in the order of ``ord_col``; rows without order key are numbered first.

    With ``wanted``, all rows count but only rows for which it is true are returned: buckets without such
    rows are then left out before the shuffle.
    """
    cut = df.withColumn("_bucket", order_bucket(df, ord_col))
    marked = cut if wanted is None else cut.withColumn("_wanted", wanted)
    chosen = F.lit(True) if wanted is None else F.coalesce(F.max("_wanted"), F.lit(False))
    # The unpartitioned window runs over the bucket table only (at most MAX_BUCKETS rows).
    before = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        marked.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_n"), chosen.alias("_chosen"))
        .select("_bucket", "_chosen", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
        .filter("_chosen")
        .drop("_chosen")
    )
    inside = W.partitionBy("_bucket").orderBy(named(ord_col))
    numbered = (
        marked.join(F.broadcast(offsets), "_bucket")
        .withColumn(out, F.col("_offset") + F.row_number().over(inside) - 1 + F.lit(start))
        .drop("_bucket", "_offset")
    )
    return numbered if wanted is None else numbered.filter("_wanted").drop("_wanted")


def journal_line_numbers(
    df: DataFrame, journal: str, order_by: list[str], out: str = "journalIdLineNumber"
) -> DataFrame:
    """Adds the running count of each row within its journal.

    Journals of more than ``HOT_JOURNAL_ROWS`` rows are dealt to ranges of the whole order, stored, and numbered range
    by range; the counts of a journal's earlier ranges are added. One journal holding most rows, even with one value in
    the first order column, thereby runs in many tasks. Null and empty journal ids form one group.
    """
    order = [named(c) for c in order_by]
    keyed = df.withColumn("_journal", F.coalesce(named(journal).cast("string"), F.lit("")))
    hot = durable(
        keyed.groupBy("_journal").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > HOT_JOURNAL_ROWS)
    )
    line = F.row_number().over(W.partitionBy("_journal").orderBy(*order)).cast("bigint")
    rows = hot.agg(F.sum("_n").alias("n")).first()["n"]
    if not rows:
        return keyed.withColumn(out, line).drop("_journal")
    listed = lookup_side(hot.select("_journal"), once=False)
    calm = keyed.join(listed, "_journal", "left_anti").withColumn(out, line)
    # Which range a row is in is stored with it, so counts and numbers agree.
    dealt = keyed.join(listed, "_journal", "left_semi").repartitionByRange(
        -(-rows // HOT_JOURNAL_ROWS) + 1, "_journal", *order
    )
    dealt = durable(dealt.withColumn("_range", F.spark_partition_id()))
    # One row per range and hot journal.
    before = W.partitionBy("_journal").orderBy("_range").rowsBetween(W.unboundedPreceding, -1)
    offsets = lookup_side(
        dealt.groupBy("_journal", "_range")
        .agg(F.count(F.lit(1)).alias("_count"))
        .withColumn("_offset", F.coalesce(F.sum("_count").over(before), F.lit(0)))
        .drop("_count")
    )
    inside = F.row_number().over(W.partitionBy("_journal", "_range").orderBy(*order))
    counted = dealt.join(offsets, ["_journal", "_range"]).withColumn(out, (inside + F.col("_offset")).cast("bigint"))
    return calm.drop("_journal").unionByName(counted.drop("_journal", "_range", "_offset"))


# Warnings of the sequence check.
WARN_BLANK = "Could not locate missing sequences, all values are blank."
WARN_NOT_NUMERIC = "JournalId does not appear to be a numeric sequence"


def sequence_gaps(df: DataFrame, id_col: str, ord_col: str) -> DataFrame:
    """Checks that ``id_col`` grows by one from row to row: one row ``n, gaps, percent, complete, warning``.

    Any null or non-numeric id gives a warning and zero percent. Whole numbers of up to 38 digits are compared exactly,
    other numbers as doubles.
    """
    text = F.trim(named(id_col).cast("string"))
    real = text.try_cast("double")
    whole = F.when(text.rlike("^[+-]?[0-9]+$"), text.try_cast("decimal(38,0)"))
    rows = df.select(
        order_bucket(df, ord_col).alias("bucket"),
        named(ord_col).alias("ord"),
        F.when(real.isNotNull(), F.struct(whole.alias("whole"), real.alias("real"))).alias("id"),
    )

    def follows(now: Column, before: Column) -> Column:
        exact = F.try_subtract(now["whole"], before["whole"]) == 1
        return F.coalesce(exact, now["real"] - before["real"] == 1.0, F.lit(False))

    inside = W.partitionBy("bucket").orderBy("ord")
    linked = rows.withColumn("prev", F.lag("id").over(inside)).withColumn(
        "head", F.row_number().over(inside) == 1
    )
    is_gap = ~F.col("head") & ~follows(F.col("id"), F.col("prev"))
    buckets = linked.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("id").alias("numeric"),
        F.count_if(is_gap).alias("gaps"),
        F.min_by("id", "ord").alias("first_id"),
        F.max_by("id", "ord").alias("last_id"),
    )
    # One row per bucket, at most MAX_BUCKETS of them.
    across = W.orderBy("bucket")
    head_gap = (F.row_number().over(across) > 1) & ~follows(F.col("first_id"), F.lag("last_id").over(across))
    totals = buckets.withColumn("gaps", F.col("gaps") + head_gap.cast("bigint")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum("numeric"), F.lit(0)).alias("numeric"),
        F.coalesce(F.sum("gaps"), F.lit(0)).alias("found"),
    )
    usable = (F.col("n") > 0) & (F.col("n") == F.col("numeric"))
    kept_share = F.floor(F.try_divide((F.col("n") - F.col("found")) * 100.0, F.col("n")))
    return totals.select(
        "n",
        F.when(usable, F.col("found")).alias("gaps"),
        F.when(usable, kept_share).otherwise(F.lit(0)).cast("int").alias("percent"),
        (usable & (F.col("found") == 0)).alias("complete"),
        F.when(F.col("n") == 0, WARN_BLANK)
        .when(F.col("n") != F.col("numeric"), WARN_NOT_NUMERIC)
        .alias("warning"),
    )
