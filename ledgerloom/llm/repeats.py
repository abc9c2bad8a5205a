"""Removal of long repeated byte strings across all documents.

A string of 200 bytes is found through its anchor: the gram of least hash within it. Equal strings have their anchors
at the same place, so both occurrences lie in the contexts of anchors of one hash; the context of an anchor is what its
strings cover. Anchors that occur once are dropped; where all contexts of an anchor are equal they are repeated whole; the rest is cut out and compared by
``bwt.prefix_classes`` in buckets of bounded size. An anchor with too many different contexts for a bucket has its
200-byte strings counted one by one, with the same result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.bwt import END, prefix_classes
from ledgerloom.llm.shingles import groups, mix, powers, stretches
from ledgerloom.llm.workers import arrow_map
from ledgerloom.runtime import durable, lookup_side

LENGTH = 200
GRAM = 48
BUCKET_BYTES = 1_000_000
# Above this many different contexts an anchor is counted string by string.
CROWD = 10_000
# Anchors of a long text are taken from pieces of this many bytes.
PIECE = 2_000_000
_POSITION_BITS = np.uint64(24)
_LENGTH_STEP = np.uint64(0xA0761D6478BD642F)

# ``before`` is the distance from a context's start to its anchor.
ANCHORS = "anchor bigint, context bigint, text bigint, bytes int, start int, stop int, before smallint"
SPANS = "text bigint, bytes int, start int, stop int"


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of every ``width`` neighbours."""
    n = len(values)
    blocks = -(-n // width)
    wide = np.full(blocks * width, np.iinfo(values.dtype).max, values.dtype)
    wide[:n] = values
    square = wide.reshape(blocks, width)
    ahead = np.minimum.accumulate(square, axis=1).reshape(-1)
    back = np.minimum.accumulate(square[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def anchors(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Text number, anchor hash, context hash, context start and stop, and anchor place, all places in ``data``.

    Every 200-byte string within one of the texts that end at ``ends`` lies in exactly one context.
    """
    n = len(data)
    if n < LENGTH:
        return (np.empty(0, np.int64),) * 6
    up, down = powers(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:-1], out=total[1:])
    grams = mix((total[GRAM:] - total[:-GRAM]) * down[: n - GRAM + 1])
    places = np.arange(len(grams), dtype=np.uint64)
    least = _least(grams >> _POSITION_BITS << _POSITION_BITS | places, LENGTH - GRAM + 1)
    begins = np.concatenate([[0], ends[:-1]])
    # Strings may not reach over the end of a text.
    change = np.zeros(len(least) + 1, np.int64)
    stop = np.maximum(ends - LENGTH + 1, begins)
    np.add.at(change, np.minimum(begins, len(least)), 1)
    np.add.at(change, np.minimum(stop, len(least)), -1)
    strings = np.flatnonzero(np.cumsum(change[:-1]) > 0)
    chosen = (least[strings] & np.uint64((1 << int(_POSITION_BITS)) - 1)).astype(np.int64)
    if not len(chosen):
        return (np.empty(0, np.int64),) * 6
    opens = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    at, low = chosen[opens], strings[opens]
    high = strings[np.append(opens[1:], len(strings)) - 1] + LENGTH
    shape = ((high - low) * 1024 + (at - low)).astype(np.uint64) * _LENGTH_STEP
    context = mix((total[high] - total[low]) * down[low] + shape)
    return np.searchsorted(ends, at, "right"), grams[at].view(np.int64), context.view(np.int64), low, high, at


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(found: tuple[np.ndarray, ...], numbers: np.ndarray, sizes: np.ndarray, shift: np.ndarray) -> pa.RecordBatch:
        text, anchor, context, low, high, at = found
        return pa.RecordBatch.from_arrays(
            [
                pa.array(anchor), pa.array(context), pa.array(numbers[text]), pa.array(sizes[text], pa.int32()),
                pa.array(low + shift[text], pa.int32()), pa.array(high + shift[text], pa.int32()), pa.array(at - low, pa.int16()),
            ],
            names=["anchor", "context", "text", "bytes", "start", "stop", "before"],
        )

    for batch in batches:
        for part in stretches(batch, "raw"):
            numbers = part.column("text").to_numpy()
            raw = part.column("raw").to_pylist()
            sizes = np.array([len(r) for r in raw], np.int64)
            # The strings of a long text are dealt to pieces.
            step = PIECE if len(raw) == 1 else int(sizes.sum()) or 1
            data = np.frombuffer(b"".join(raw), np.uint8)
            for start in range(0, len(data), step):
                piece = data[start : start + step + LENGTH - 1]
                ends = np.cumsum(sizes) if len(raw) > 1 else np.array([len(piece)])
                shift = sizes - np.cumsum(sizes) if len(raw) > 1 else np.array([start])
                found = anchors(piece, ends)
                if len(found[0]):
                    yield rows(found, numbers, sizes, shift)


def repeated_spans(contexts: list[bytes], groups_of: np.ndarray, before: np.ndarray) -> list[tuple[int, int, int]]:
    """(context number, start, stop) of the bytes covered by strings that another context of the same group holds at
    the same distance from its anchor."""
    data = np.frombuffer(b"".join(c + bytes([END]) for c in contexts), np.uint8)
    sizes = np.array([len(c) + 1 for c in contexts], np.int64)
    begins = np.cumsum(sizes) - sizes
    order, classes = prefix_classes(data, LENGTH)
    owner = np.repeat(np.arange(len(contexts)), sizes)[order]
    offset = order - begins[owner]
    whole = offset + LENGTH <= sizes[owner] - 1
    # Only strings that share their class with another one can be repeated.
    shared = np.bincount(classes, minlength=int(classes[-1]) + 1)[classes] > 1
    keep = whole & shared
    owner, offset, classes = owner[keep], offset[keep], classes[keep]
    if not len(owner):
        return []
    by = np.lexsort((offset - before[owner], groups_of[owner], classes))
    owner, offset, classes = owner[by], offset[by], classes[by]
    group, distance = groups_of[owner], offset - before[owner]
    same = (classes[1:] == classes[:-1]) & (group[1:] == group[:-1]) & (distance[1:] == distance[:-1])
    twice = np.concatenate([same, [False]]) | np.concatenate([[False], same])
    return _covered(owner[twice], offset[twice])


def _covered(owner: np.ndarray, offset: np.ndarray) -> list[tuple[int, int, int]]:
    if not len(owner):
        return []
    by = np.lexsort((offset, owner))
    owner, offset = owner[by], offset[by]
    opens = np.concatenate([[True], (owner[1:] != owner[:-1]) | (offset[1:] > offset[:-1] + LENGTH)])
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(owner)) - 1
    return list(zip(owner[first].tolist(), offset[first].tolist(), (offset[last] + LENGTH).tolist()))


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table in groups(batches, ["bucket"]):
        raw = table.column("raw").to_pylist()
        _, group = np.unique(table.column("anchor").to_numpy(), return_inverse=True)
        base, numbers, sizes = (table.column(c).to_numpy() for c in ("start", "text", "bytes"))
        repeated = table.column("repeated").to_numpy()
        before = table.column("before").to_numpy().astype(np.int64)
        spans = [s for s in repeated_spans(raw, group, before) if not repeated[s[0]]]
        if spans:
            owner, start, stop = (np.array(x) for x in zip(*spans))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(numbers[owner]), pa.array(sizes[owner], pa.int32()),
                    pa.array(base[owner] + start, pa.int32()), pa.array(base[owner] + stop, pa.int32()),
                ],
                names=["text", "bytes", "start", "stop"],
            )


def _identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    raw = F.coalesce(F.col(text_col).cast("binary"), F.lit("").cast("binary"))
    rows = docs.select(F.col(id_col).alias("doc_id"), raw.alias("raw"))
    return rows.withColumns({"text": F.xxhash64("raw"), "bytes": F.length("raw")})


def _context_marks(rows: DataFrame, copies: DataFrame, hits: DataFrame) -> DataFrame:
    """Marks in anchors whose contexts differ."""
    place = F.struct("text", "bytes", "start", "stop", "before")
    contexts = hits.where("differ").groupBy("anchor", "context").agg(F.min(place).alias("low"), F.max(place).alias("high"))
    contexts = contexts.select("anchor", "context", "low.*", (F.col("low") != F.col("high")).alias("repeated"))
    sizes = contexts.groupBy("anchor").agg(F.count("*").alias("crowd"))
    contexts = durable(contexts.join(sizes, "anchor"))
    whole = (
        hits.where("differ")
        .join(contexts.where("repeated").select("anchor", "context"), ["anchor", "context"])
        .select("text", "bytes", "start", "stop")
    )
    # The bytes of each context come from one copy of its text.
    wanted = contexts.groupBy("text", "bytes").agg(
        F.collect_list(F.struct("anchor", "start", "stop", "before", "repeated", "crowd")).alias("places")
    )
    wanted = wanted.join(copies.select("text", "bytes", "doc_id"), ["text", "bytes"])
    wanted = wanted.select(*[F.col(c).alias(f"_{c}") for c in wanted.columns])
    same = (rows["text"] == wanted["_text"]) & (rows["bytes"] == wanted["_bytes"]) & rows["doc_id"].eqNullSafe(wanted["_doc_id"])
    cut = F.transform(
        "_places",
        lambda p: F.struct(
            *[p[c].alias(c) for c in ("anchor", "start", "before", "repeated", "crowd")],
            F.substring("raw", p["start"] + 1, p["stop"] - p["start"]).alias("cut"),
        ),
    )
    cut_out = rows.join(wanted, same).select("text", "bytes", cut.alias("places")).select("text", "bytes", F.inline("places"))
    cut_out = durable(cut_out.withColumnRenamed("cut", "raw"))
    total = cut_out.agg(F.coalesce(F.sum(F.length("raw")), F.lit(0))).first()[0]
    buckets = total // BUCKET_BYTES + 1
    bucketed = (
        cut_out.where(F.col("crowd") <= CROWD)
        .withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets)).cast("int"))
        .repartition("bucket")
        .sortWithinPartitions("bucket")
    )
    compared = arrow_map(bucketed, _compared, SPANS)
    return whole.unionByName(compared).unionByName(_counted(cut_out.where(F.col("crowd") > CROWD)))


def _counted(crowded: DataFrame) -> DataFrame:
    """Every string of the contexts, counted by its digest; exact for anchors of any crowd."""
    strings = crowded.where(F.length("raw") >= LENGTH).select(
        "anchor", "text", "bytes", F.col("start").alias("base"), "before", F.explode(F.sequence(F.lit(0), F.length("raw") - LENGTH)).alias("offset"), "raw"
    )
    strings = strings.select(
        "anchor",
        "text",
        "bytes",
        (F.col("base") + F.col("offset")).alias("start"),
        (F.col("offset") - F.col("before")).alias("distance"),
        F.md5(F.substring("raw", F.col("offset") + 1, F.lit(LENGTH))).alias("digest"),
    )
    key = ["anchor", "distance", "digest"]
    place = F.struct("text", "bytes", "start")
    twice = strings.groupBy(*key).agg(F.min(place).alias("a"), F.max(place).alias("b")).where("a <> b").select(*key)
    return strings.join(twice, key).select("text", "bytes", "start", (F.col("start") + LENGTH).alias("stop"))


def repeated_ranges(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` (``doc_id, raw, text, bytes``) and the byte ranges to remove per distinct text."""
    rows = _identified(docs, id_col, text_col)
    copies = durable(rows.groupBy("text", "bytes").agg(F.count("*").alias("copies"), F.min("doc_id").alias("doc_id")))
    found = durable(arrow_map(rows.where(F.col("bytes") >= LENGTH).select("text", "raw"), _anchored, ANCHORS))
    place = F.struct("context", "text", "bytes", "start")
    often = found.groupBy("anchor").agg(F.min(place).alias("low"), F.max(place).alias("high")).where("low <> high")
    often = often.select("anchor", (F.col("low.context") != F.col("high.context")).alias("differ"))
    hits = durable(found.join(often, "anchor"))
    marks = (
        hits.where("NOT differ")
        .select("text", "bytes", "start", "stop")
        .unionByName(_context_marks(rows, copies, hits))
        .unionByName(
            copies.where((F.col("copies") > 1) & (F.col("bytes") >= LENGTH)).select(
                "text", "bytes", F.lit(0).alias("start"), F.col("bytes").alias("stop")
            )
        )
    ).distinct()
    # Ranges that touch or overlap become one.
    by_start = W.partitionBy("text", "bytes").orderBy("start", "stop")
    reach = F.max("stop").over(by_start.rowsBetween(W.unboundedPreceding, -1))
    opened = marks.withColumn("opens", (F.col("start") > F.coalesce(reach, F.lit(-1))).cast("int"))
    opened = opened.withColumn("run", F.sum("opens").over(by_start.rowsBetween(W.unboundedPreceding, 0)))
    ranges = opened.groupBy("text", "bytes", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return rows, ranges.drop("run")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept`` of every row of ``docs``; ``kept`` holds the remaining bytes.

    Null text is empty. Every byte covered by a 200-byte string that starts anywhere else too is removed, also within
    one document and in every copy of a text. Shorter texts stay whole, repeated rows are copies of each other, an
    empty table gives no rows, other columns are left out.
    """
    rows, ranges = repeated_ranges(docs, id_col, text_col)
    spans = ranges.groupBy("text", "bytes").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))
    spans = lookup_side(spans.select(F.col("text").alias("_text"), F.col("bytes").alias("_bytes"), "spans"))
    joined = rows.join(spans, (F.col("text") == F.col("_text")) & (F.col("bytes") == F.col("_bytes")), "left")
    edges = F.arrays_zip(
        F.concat(F.array(F.lit(0)), F.transform("spans", lambda s: s["stop"])).alias("a"),
        F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.col("bytes"))).alias("b"),
    )
    pieces = F.transform(edges, lambda e: F.hex(F.substring("raw", e["a"] + 1, e["b"] - e["a"])))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["stop"] - s["start"])
    return joined.select(
        "doc_id",
        F.col("bytes").cast("long").alias("n_bytes"),
        F.coalesce(removed, F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"),
        F.when(F.col("spans").isNull(), F.col("raw")).otherwise(F.unhex(F.array_join(pieces, ""))).alias("kept"),
    )
