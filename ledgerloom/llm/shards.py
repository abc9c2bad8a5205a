"""Sharding by a hierarchical weighted hash tree.

A topology lists shards with their rack, region and weight. A row descends region, rack and shard. At each level
every child draws ``ln(u) / weight``, where ``u`` is hashed from the row's key and the child's path, and the
largest draw wins. A draw depends on nothing but key, child and weight, so a changed weight moves rows only
into or out of the subtree that holds it.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.columns import uniform
from ledgerloom.runtime import durable

# Rows of one shard are numbered in pieces of about this many.
PIECE_ROWS = 500_000
# Slots that one row is expanded to at once.
RUN_SLOTS = 100_000


@dataclass(frozen=True)
class Shard:
    number: int
    rack: str
    region: str
    weight: float = 1.0


def grid(shards: int, per_rack: int = 5, racks: int = 4) -> tuple[Shard, ...]:
    """``shards`` equal shards, ``per_rack`` to a rack and ``racks`` to a region."""
    return tuple(Shard(n, f"k{n // per_rack}", f"r{n // (per_rack * racks)}") for n in range(shards))


def grow(topology: Sequence[Shard], weight: float = 1.0) -> tuple[Shard, ...]:
    """One more shard, in a region of its own: no older subtree changes weight, so rows move only into it."""
    number = max((s.number for s in topology), default=-1) + 1
    return (*topology, Shard(number, f"k-{number}", f"r-{number}", weight))


def _children(pairs: Iterable[tuple[str, str, float]]) -> Column:
    """Map of parent to its (child, weight) list, heavier than zero, as a literal."""
    found: dict[str, dict[str, float]] = {}
    for parent, child, weight in pairs:
        of = found.setdefault(parent, {})
        of[child] = of.get(child, 0.0) + weight
    entries = [
        F.struct(
            F.lit(parent),
            F.array(*[F.struct(F.lit(c).alias("name"), F.lit(float(w)).alias("weight")) for c, w in sorted(of.items()) if w > 0]),
        )
        for parent, of in sorted(found.items())
        if any(w > 0 for w in of.values())
    ]
    return F.map_from_entries(F.array(*entries))


def _draw(children: Column, key: Sequence[Column]) -> Column:
    draws = F.transform(
        children, lambda c: F.struct((F.log(uniform(c["name"], *key)) / c["weight"]).alias("draw"), c["name"].alias("name"))
    )
    return F.array_max(draws)["name"]


def shard_of(topology: Sequence[Shard], *key: Column) -> Column:
    """Shard number of each row. Null keys are a key of their own. A topology needs one shard of positive weight."""
    if not any(s.weight > 0 for s in topology):
        raise ValueError("the topology has no shard with a positive weight")
    region = _draw(_children(("", s.region, s.weight) for s in topology)[""], key)
    rack = _draw(_children((s.region, f"{s.region}/{s.rack}", s.weight) for s in topology)[region], key)
    leaf = _draw(
        _children((f"{s.region}/{s.rack}", f"{s.region}/{s.rack}/{s.number}", s.weight) for s in topology)[rack], key
    )
    return F.substring_index(leaf, "/", -1).cast("int")


def place(docs: DataFrame, topology: Sequence[Shard], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Shard and slot of every row of ``docs``, with size and checksum of its text.

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``; other columns of ``docs`` are left out.
    ``law`` is ``key``: the id and the topology decide. ``grown_shard`` is the shard after ``grow``. Null text counts
    as empty, null ids share one shard, an empty table gives no rows. Repeated rows each get a slot.

    Slots count from 0 in each shard without gaps. Equal rows are counted before the shuffle, then rows are numbered
    in pieces cut by hash; only the pieces' counts are added up, so no task sees a whole shard. Slots of equal rows are
    dealt in runs, however many there are. Rows of equal id, checksum and size are equal here: they swap slots freely.
    Texts are read whole, but only their size and checksum move.
    """
    key = F.col(id_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    placed = (
        docs.select(
            key.alias("doc_id"),
            (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            shard_of(topology, key).alias("shard"),
            shard_of(grow(topology), key).alias("grown_shard"),
        )
        .groupBy("doc_id", "size", "text_crc32", "shard", "grown_shard")
        .agg(F.count("*").alias("_n"))
    )
    placed = durable(placed)
    largest = placed.groupBy("shard").agg(F.count("*").alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0
    pieces = -(-largest // PIECE_ROWS) or 1
    order = ["doc_id", "text_crc32", "size"]
    placed = placed.withColumn("_piece", F.pmod(F.xxhash64(*order), F.lit(pieces)))
    # At most one row per shard and piece.
    starts = placed.groupBy("shard", "_piece").agg(F.sum("_n").alias("_rows"))
    starts = starts.select(
        "shard", "_piece", (F.sum("_rows").over(W.partitionBy("shard").orderBy("_piece")) - F.col("_rows")).alias("_start")
    )
    running = W.partitionBy("shard", "_piece").orderBy(*order, "grown_shard")
    first = F.sum("_n").over(running) - F.col("_n")
    numbered = placed.withColumn("_first", first).join(starts, ["shard", "_piece"])
    # Equal rows get their slots in runs of bounded length, and the runs are spread before they are written out.
    run = F.explode(F.sequence(F.lit(0).cast("bigint"), (F.col("_n") - 1).cast("bigint"), F.lit(RUN_SLOTS).cast("bigint"))).alias("_at")
    runs = numbered.select("*", run).withColumns(
        {
            "_from": F.col("_first") + F.col("_start") + F.col("_at"),
            "_slots": F.least(F.lit(RUN_SLOTS), F.col("_n") - F.col("_at")),
        }
    )
    runs = runs.select("doc_id", "size", "text_crc32", "shard", "grown_shard", "_from", "_slots").repartition("doc_id", "_from")
    return runs.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        F.explode(F.sequence("_from", F.col("_from") + F.col("_slots") - 1)).alias("slot"),
        "grown_shard",
    )
