"""Lookup of range rules held in a table.

Overlapping ranges are cut at their bounds into disjoint stretches. The bounds are numbered; stretches are the bounds
themselves and the gaps between them. A range covers a run of stretch numbers, which splits into logarithmically many
aligned blocks; per block the range of highest position wins, and a stretch takes the best of the blocks above it. All
of it is equi-joins and grouping, so long lists of ranges cost their length times its logarithm.

Rows find their stretch by equi-join on bins of the key, checked against the stretch's bounds. Bins are even; one that
holds many stretches is split into even parts again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.functions.columns import named
from ledgerloom.runtime import durable, lookup_side

# Stretches of a bin from which it is split.
BIN_STRETCHES = 4


def _numbered(bounds: DataFrame) -> DataFrame:
    """``bound`` in ascending order with ``i`` from 0; one row per range of bounds carries the numbers on."""
    placed = durable(bounds.repartitionByRange("bound").withColumn("part", F.spark_partition_id()))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    offsets = placed.groupBy("part").agg(F.count("*").alias("n"))
    offsets = offsets.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(W.partitionBy("part").orderBy("bound"))
    return durable(placed.join(offsets, "part").select("bound", (F.col("offset") + inside - 1).alias("i")))


def _shifted(number: Column) -> Column:
    """``number`` over two to the power of ``level``, rounded down."""
    return F.floor(number / F.pow(F.lit(2.0), F.col("level"))).cast("bigint")


def stretches(ranges: DataFrame, start: str, end: str, position: str, value: str) -> DataFrame:
    """``low, high, value``: disjoint stretches that ranges cover, with the value of the covering range of highest
    ``position``. Where ``low = high`` the stretch is that key; otherwise it is what lies between the two.

    Ranges include both bounds. Ranges with a null bound or position or with ``start`` above ``end`` cover nothing; of
    ranges at one position the greater value wins.
    """
    given = ranges.select(
        named(start).cast("double").alias("start"), named(end).cast("double").alias("end"),
        named(position).alias("position"), named(value).alias("value"),
    ).where("start <= end AND position IS NOT NULL AND NOT isnan(end)")
    given = durable(given)
    bounds = _numbered(given.select(F.explode(F.array("start", "end")).alias("bound")).distinct())
    levels = F.explode(F.sequence(F.lit(0), F.lit((2 * bounds.count()).bit_length()))).alias("level")
    first = bounds.select(F.col("bound").alias("start"), (2 * F.col("i")).alias("from"))
    last = bounds.select(F.col("bound").alias("end"), (2 * F.col("i")).alias("to"))
    blocks = given.join(first, "start").join(last, "end").select("from", "to", "position", "value", levels)
    # At each level what is left of the run lies between two block numbers; an odd one at either side is taken whole.
    left, right = -_shifted(-F.col("from")), _shifted(F.col("to") + 1)
    blocks = blocks.select("level", "position", "value", left.alias("left"), right.alias("right")).where("left < right")
    taken = F.array(F.when(F.col("left") % 2 == 1, F.col("left")), F.when(F.col("right") % 2 == 1, F.col("right") - 1))
    blocks = blocks.select("level", "position", "value", F.explode(F.array_compact(taken)).alias("block"))
    best = blocks.groupBy("level", "block").agg(F.max(F.struct("position", "value")).alias("best"))
    following = bounds.select((F.col("i") - 1).alias("i"), F.col("bound").alias("next"))
    every = bounds.join(following, "i", "left").select(
        F.inline(
            F.array(
                F.struct((2 * F.col("i")).alias("number"), F.col("bound").alias("low"), F.col("bound").alias("high")),
                F.struct((2 * F.col("i") + 1).alias("number"), F.col("bound").alias("low"), F.col("next").alias("high")),
            )
        )
    )
    above = every.where("high IS NOT NULL").select("number", "low", "high", levels)
    above = above.withColumn("block", _shifted(F.col("number")))
    won = above.join(best, ["level", "block"]).groupBy("number", "low", "high").agg(F.max("best").alias("best"))
    return won.select("low", "high", F.col("best.value").alias("value"))


def lookup_range(rows: DataFrame, key: str, found: DataFrame, out: str) -> DataFrame:
    """``rows`` with the value of the stretch that holds ``key`` as ``out``, null without one. ``found`` is a result of
    ``stretches``. Rows are neither dropped nor repeated; null and NaN keys lie in no stretch."""
    found = durable(found)
    low, high, many = found.agg(F.min("low"), F.max("high"), F.count("*")).first()
    if not many:
        return rows.withColumn(out, F.lit(None).cast(found.schema["value"].dataType))
    width = (high - low) / many or 1.0

    def place(c: Column) -> Column:
        return (c - F.lit(low)) / F.lit(width)

    def part(c: Column) -> Column:
        """Number of the part of its bin that a key lies in."""
        inside = F.floor((place(c) - F.col("_bin")) * F.col("_parts"))
        return F.least(F.greatest(inside, F.lit(0)), F.col("_parts") - 1).cast("bigint")

    ends = [F.floor(place(F.col(c))).cast("bigint") for c in ("low", "high")]
    binned = found.select("*", F.explode(F.sequence(*ends)).alias("_bin"))
    parts = binned.groupBy("_bin").agg(F.ceil(F.count("*") / BIN_STRETCHES).alias("_parts"))
    starts = F.when(ends[0] < F.col("_bin"), F.lit(0)).otherwise(part(F.col("low")))
    stops = F.when(ends[1] > F.col("_bin"), F.col("_parts") - 1).otherwise(part(F.col("high")))
    pieces = binned.join(parts, "_bin").select(
        F.col("_bin").alias("_of"), F.col("low").alias("_low"), F.col("high").alias("_high"), F.col("value").alias(out),
        F.explode(F.sequence(starts, stops)).alias("_piece"),
    )
    account = named(key).cast("double")
    within = F.when((account >= low) & (account <= high), F.floor(place(account)).cast("bigint"))
    kept = [named(c) for c in rows.columns if c != out]
    keyed = rows.select(*kept, account.alias("_key"), within.alias("_bin")).join(lookup_side(parts), "_bin", "left")
    keyed = keyed.withColumn("_part", part(F.col("_key")))
    pieces = lookup_side(pieces)
    point = (F.col("_low") == F.col("_high")) & (F.col("_key") == F.col("_low"))
    holds = point | ((F.col("_key") > F.col("_low")) & (F.col("_key") < F.col("_high")))
    joined = keyed.join(pieces, (F.col("_bin") == F.col("_of")) & (F.col("_part") == F.col("_piece")) & holds, "left")
    return joined.select(*kept, named(out))
