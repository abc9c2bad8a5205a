"""Report files: rectangular CSV with preamble lines, of unknown encoding, in file order."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.operators.clean import drop_all_null, null_tokens_to_null, repaired_header
from ledgerloom.operators.ordinals import journal_line_numbers, order_bucket
from ledgerloom.runtime import durable, lookup_side, scratch_path
from ledgerloom.spec import HeaderCheck

ORD = "_ord"
FALLBACK_ENCODING = "ISO-8859-1"


# The column that holds the cells beyond the header, joined.
SURPLUS = "extra cells"
# The column that holds a whole line in which a quoted cell opens and never closes.
UNCLOSED = "unclosed cell"
# Inside of a quoted cell, and a cell with the comma before it, closed as the CSV parser closes them. A cell that opens
# with a quote sign and never closes runs to the end. All repeats are possessive, so long cells need no stack.
_QUOTED = '[^"]*+(?:""[^"]*+)*+'
_CELL = f',("{_QUOTED}(?:"[^,]*+)?+|[^,]*+)'
# The inside and the tail of a cell that opens with a quote sign; a single sign at the end of a line stands for itself.
_OPENED = f'^"(?!\\z)({_QUOTED})(?:"([^,]*+))?+\\z'


def read_headed_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header line, every column text. Also reads step results written earlier, with quotes and line breaks."""
    return _cells(*_body(spark, path, 1, True)).drop(ORD)


def _inside_after(value: Column, inside: bool) -> Column:
    """Whether a quoted cell is open at the end of a line, given whether one is at its start.

    A quote sign opens a cell only as its first character; within an open cell two signs are one, and a single one
    closes it. The line is cut at its quote signs and the pieces are folded over three states: 0 outside, 1 inside,
    2 just after a sign met inside.
    """
    pieces = F.split(value, '"')
    numbered = F.transform(pieces, lambda p, i: F.struct(p.alias("p"), i.alias("i")))

    def step(state: Column, piece: Column) -> Column:
        first, last = piece["i"] == 0, piece["i"] == F.size(pieces) - 1
        empty = piece["p"] == ""
        # After a sign met inside, an empty piece before another sign is an escaped sign; anything else closes.
        escaped = (state == 2) & empty & ~last
        now = F.when((state == 2) & ~escaped, 0).otherwise(state)
        opens = (now == 0) & (piece["p"].endswith(",") | (first & empty))
        after = F.when(escaped, 1).when(opens, 1).when(now == 1, 2).otherwise(now)
        return F.when(last, now).otherwise(after)

    return F.aggregate(numbered, F.lit(int(inside)), step) == 1


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Physical lines of the file(s) at ``path`` as ``(_file, _block, _line, _ord, _quoted, value)``.

    ``_line`` counts from 1 within its file, ``_ord`` over all files of the path in name order.

    The raw lines are staged once as Parquet in the shared folder: from then on, line numbers derive from
    positions in stored files and hold under retries, lost executors and changing split sizes. Text is
    UTF-8 where the whole file decodes as such, else ISO-8859-1. ``_quoted`` marks lines with a quote sign.
    """
    staged = scratch_path(spark, "lines")
    position = F.monotonically_increasing_id()
    (
        spark.read.text(path)
        .select("value", "_metadata.file_path", "_metadata.file_block_start")
        .select(
            F.col("file_path").alias("_file"),
            F.col("file_block_start").alias("_block"),
            position.alias("_place"),
            F.is_valid_utf8("value").alias("_utf8"),
            F.decode(F.col("value").cast("binary"), FALLBACK_ENCODING).alias("_fallback"),
            F.try_validate_utf8("value").alias("value"),
        )
        .select(
            "_file",
            "_block",
            "_place",
            "_utf8",
            F.coalesce("value", "_fallback").contains('"').alias("_quoted"),
            "value",
            # The second reading is only stored for lines where the two differ.
            F.when(~F.col("_utf8") | (F.col("_fallback") != F.col("value")), F.col("_fallback")).alias(
                "_fallback"
            ),
        )
        .write.parquet(staged)
    )
    lines = spark.read.parquet(staged)
    # One row per input split; splits are told apart by a hash, so paths do not travel with them.
    lines = lines.withColumn("_split", F.xxhash64("_file", "_block"))
    blocks = lines.groupBy("_split").agg(
        F.min("_file").alias("_file"),
        F.min("_block").alias("_block"),
        F.min("_place").alias("_first"),
        F.count(F.lit(1)).alias("_n"),
        F.bool_and("_utf8").alias("_block_utf8"),
    )
    before = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    # The unpartitioned window runs over the split table only.
    before_all = W.orderBy("_file", "_block").rowsBetween(W.unboundedPreceding, -1)
    offsets = lookup_side(
        blocks.select(
            "_split",
            "_first",
            F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"),
            F.coalesce(F.sum("_n").over(before_all), F.lit(0)).alias("_total_offset"),
            F.bool_and("_block_utf8").over(W.partitionBy("_file")).alias("_file_utf8"),
        )
    )
    return lines.join(offsets, "_split").select(
        "_file",
        "_block",
        (F.col("_offset") + F.col("_place") - F.col("_first") + 1).alias("_line"),
        (F.col("_total_offset") + F.col("_place") - F.col("_first") + 1).alias(ORD),
        "_quoted",
        F.when(F.col("_file_utf8"), F.col("value"))
        .otherwise(F.coalesce("_fallback", "value"))
        .alias("value"),
    )


def join_quoted_lines(lines: DataFrame) -> DataFrame:
    """Merges lines that a quoted cell runs over into one, numbered by their first line.

    Only lines with quote signs can open or close a cell. Each is reduced to where it leads from outside and from
    inside: always the same, nowhere, or to the other side. Within a range of lines the state is the last fixed one,
    turned by the changes since; one row per range carries it over the range borders. Only lines of multi-line records
    are grouped; each group is one record. A cell that is never closed leaves its line a record by itself, marked
    ``_unclosed``, and the lines below it are read again from outside; each such line of a file takes one more round over
    the quoted lines below it.
    """
    from_out, from_in = _inside_after(F.col("value"), False), _inside_after(F.col("value"), True)
    turns = lines.filter("_quoted").select("_file", ORD, from_out.alias("_out"), from_in.alias("_in"))
    # Lines that leave either side as it is change nothing.
    turns = durable(turns.filter("_out OR NOT _in"))
    spans, unclosed = None, None
    while True:
        found = durable(_quoted_spans(turns))
        closed = found.filter("_end is not null").select("_start", "_end")
        spans = closed if spans is None else spans.unionByName(closed)
        lost = found.filter("_end is null").select("_file", "_start")
        if lost.isEmpty():
            break
        unclosed = lost if unclosed is None else unclosed.unionByName(lost)
        turns = durable(turns.join(lookup_side(lost), "_file").filter(F.col(ORD) > F.col("_start")).drop("_start"))
    covered = lookup_side(spans.select("_start", F.explode(F.sequence("_start", "_end")).alias(ORD)))
    tagged = lines.join(covered, ORD, "left")
    merged = (
        tagged.filter("_start is not null")
        .groupBy("_start")
        .agg(
            F.min("_file").alias("_file"),
            F.min("_line").alias("_line"),
            F.array_sort(F.collect_list(F.struct(ORD, "value"))).alias("_parts"),
        )
        .select(
            "_file",
            "_line",
            F.col("_start").alias(ORD),
            F.array_join(F.transform("_parts", lambda p: p["value"]), "\n").alias("value"),
            F.lit(False).alias("_unclosed"),
        )
    )
    single = tagged.filter("_start is null").select("_file", "_line", ORD, "value")
    if unclosed is None:
        return single.withColumn("_unclosed", F.lit(False)).unionByName(merged)
    marks = lookup_side(unclosed.select(F.col("_start").alias(ORD), F.lit(True).alias("_mark")))
    single = single.join(marks, ORD, "left").withColumn("_unclosed", F.coalesce("_mark", F.lit(False))).drop("_mark")
    return single.unionByName(merged)


def _quoted_spans(turns: DataFrame) -> DataFrame:
    """``_file, _start, _end`` of the records over several lines, with null ``_end`` for a cell that is never closed."""
    turns = turns.withColumn("_bucket", order_bucket(turns, ORD)).select(
        "*",
        F.when(F.col("_out") == F.col("_in"), F.col("_out").cast("int")).alias("_fixed"),
        (F.col("_out") & ~F.col("_in")).cast("int").alias("_swap"),
    )
    ahead = W.partitionBy("_file", "_bucket").orderBy(ORD).rowsBetween(W.unboundedPreceding, -1)
    swaps = F.coalesce(F.sum("_swap").over(ahead), F.lit(0))
    seen = turns.withColumn("_swaps", swaps).withColumn(
        "_last", F.last(F.when(F.col("_fixed").isNotNull(), F.struct("_fixed", "_swaps")), ignorenulls=True).over(ahead)
    )
    mark = F.when(F.col("_fixed").isNotNull(), F.struct(ORD, "_fixed", "_swaps"))
    ranges = seen.groupBy("_file", "_bucket").agg(F.max(mark).alias("_end"), F.sum("_swap").alias("_all"))
    # Per file and range: a fixed end, or the changes it adds.
    ranges = ranges.select(
        "_file",
        "_bucket",
        ((F.col("_end._fixed") + F.col("_all") - F.col("_end._swaps")) % 2).alias("_fixed"),
        F.when(F.col("_end").isNull(), F.col("_all")).otherwise(0).alias("_swap"),
    )
    earlier = W.partitionBy("_file").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    ranges = ranges.withColumn("_swaps", F.sum("_swap").over(earlier.rowsBetween(W.unboundedPreceding, 0)))
    fixed = F.last(F.when(F.col("_fixed").isNotNull(), F.struct("_fixed", "_swaps")), ignorenulls=True).over(earlier)
    carried = ranges.select("_file", "_bucket", fixed.alias("_from"), F.sum("_swap").over(earlier).alias("_to"))
    carried = carried.select(
        "_file",
        "_bucket",
        (
            (F.coalesce(F.col("_from._fixed"), F.lit(0)) + F.coalesce("_to", F.lit(0)) - F.coalesce(F.col("_from._swaps"), F.lit(0)))
            % 2
        ).alias("_carried"),
    )
    before = F.when(F.col("_last").isNotNull(), F.col("_last._fixed") + F.col("_swaps") - F.col("_last._swaps")).otherwise(
        F.col("_carried") + F.col("_swaps")
    )
    stated = seen.join(lookup_side(carried), ["_file", "_bucket"]).withColumn("_before", before % 2 == 1)
    after = F.when(F.col("_before"), F.col("_in")).otherwise(F.col("_out"))
    changes = durable(stated.filter(F.col("_before") != after).select("_file", ORD, after.alias("_opens")))
    ranked = journal_line_numbers(changes, "_file", [ORD], out="_turn")
    openings = ranked.filter("_opens").select("_file", F.col(ORD).alias("_start"), "_turn")
    closings = ranked.filter("NOT _opens").select("_file", F.col(ORD).alias("_end"), (F.col("_turn") - 1).alias("_turn"))
    return openings.join(closings, ["_file", "_turn"], "left").select("_file", "_start", "_end")


def _header(lines: DataFrame, start_row: int) -> tuple[int, list[str]]:
    """Line number and names of the first non-blank line from ``start_row`` on, in the first file by name."""
    found = (
        lines.filter((F.col("_line") >= start_row) & (F.trim("value") != "")).orderBy("_file", ORD).select("_line", "value").first()
    )
    if found is None:
        raise ValueError(f"no header at or after line {start_row}")
    return found["_line"], repaired_header(next(csv.reader([found["value"].lstrip("\ufeff")])))


def _whole_lines(spark: SparkSession, path: str, multiline: bool) -> DataFrame:
    lines = read_lines(spark, path)
    if multiline and not lines.filter(F.col("_quoted") & _inside_after(F.col("value"), False)).isEmpty():
        return join_quoted_lines(lines)
    return lines.withColumn("_unclosed", F.lit(False))


def _body(spark: SparkSession, path: str, start_row: int, multiline: bool) -> tuple[DataFrame, list[str]]:
    """Lines below the header, and the header's names."""
    lines = _whole_lines(spark, path, multiline)
    header_line, names = _header(lines, start_row)
    return lines.filter((F.col("_line") > header_line) & (F.trim("value") != "")), names


def find_headers(lines: DataFrame, check: HeaderCheck) -> DataFrame:
    """``_file, _head, _names`` of the first line of each file that holds enough columns of every checked field.

    A column counts as often as it occurs in the line. Only lines that contain a wanted name are cut into cells.
    """
    cells = F.transform(
        F.regexp_extract_all(F.concat(F.lit(","), F.replace("value", F.lit("\ufeff"))), F.lit(_CELL), F.lit(1)),
        lambda c: F.trim(F.when(c.rlike(_OPENED), F.replace(F.regexp_extract(c, _OPENED, 1), F.lit('""'), F.lit('"'))).otherwise(c)),
    )

    def held_of(wanted: Sequence[str]) -> Column:
        return F.size(F.filter(F.col("_cells"), lambda c: c.isin(*wanted)))

    enough, mentioned = F.lit(True), F.lit(True)
    for target, count in check.occurrences.items():
        wanted = check.columns.get(target, ())
        enough &= held_of(wanted) >= count
        if count > 0:
            mentioned &= reduce(or_, [F.col("value").contains(w) for w in wanted], F.lit(False))
    held = lines.filter(mentioned).select("_file", "_line", "value", cells.alias("_cells")).filter(enough)
    first = held.groupBy("_file").agg(F.min(F.struct("_line", "value")).alias("_first"))
    return first.select("_file", F.col("_first._line").alias("_head"), F.col("_first.value").alias("_names"))


def read_report_with_check(
    spark: SparkSession, path: str, check: HeaderCheck, multiline: bool = True, surplus: bool = False, unclosed: bool = False
) -> DataFrame:
    """Like ``read_report``, but every file's header is its first line that meets ``check``.

    Preambles of the files at ``path`` may differ in length, and headers in the order and choice of columns: the result
    has every column of any file, by its name without blanks around. A file without such a line stops the read.
    """
    lines = _whole_lines(spark, path, multiline)
    heads = durable(find_headers(lines, check))
    without = lines.select("_file").distinct().join(heads, "_file", "left_anti").select("_file").first()
    if without is not None:
        raise ValueError(f"no header line with the declared columns in {without['_file']}")
    placed = lines.join(lookup_side(heads, once=False), "_file").filter((F.col("_line") > F.col("_head")) & (F.trim("value") != ""))
    # Stored, so that no line is held against the header of another file.
    placed = durable(placed)
    table = None
    # One reading per distinct header text, of which an export has a few.
    for row in heads.select("_names").distinct().orderBy("_names").collect():
        names = repaired_header([c.strip() for c in next(csv.reader([row["_names"].lstrip("\ufeff")]))])
        part = _cells(placed.filter(F.col("_names") == row["_names"]), names, surplus, unclosed)
        table = part if table is None else table.unionByName(part, allowMissingColumns=True)
    if table is None:
        raise ValueError("no file to read")
    stored = durable(null_tokens_to_null(table, keep=[ORD]))
    return drop_all_null(stored, keep=[ORD])


def _beyond(value: Column, width: int) -> Column:
    """The non-blank cells of a line after its first ``width``, however many, joined; null for lines of few commas."""
    every = F.regexp_extract_all(F.concat(F.lit(","), value), F.lit(_CELL), F.lit(1))
    beyond = F.slice(every, width + 1, F.greatest(F.size(every), F.lit(1)))

    def plain(cell: Column) -> Column:
        inside = F.replace(F.regexp_extract(cell, _OPENED, 1), F.lit('""'), F.lit('"'))
        tail = F.regexp_extract(cell, _OPENED, 2)
        # Text after the closing sign keeps the signs in the value.
        opened = F.when(tail.rlike("^\\s*+\\z"), inside).otherwise(F.concat(F.lit('"'), inside, F.lit('"'), tail))
        return F.when(cell.rlike(_OPENED), opened).otherwise(cell)

    filled = F.filter(F.transform(beyond, plain), lambda c: F.trim(c) != "")
    commas = F.length(value) - F.length(F.replace(value, F.lit(","), F.lit("")))
    return F.when(commas >= width, F.array_join(filled, ","))


def _cells(body: DataFrame, names: list[str], surplus: bool = False, unclosed: bool = False) -> DataFrame:
    """Parsed cells by column. A line with non-blank cells beyond the header's last column raises, or with ``surplus``
    they stand joined in the column ``SURPLUS``; a line with a cell that is never closed raises, or with ``unclosed`` stands
    in the column ``UNCLOSED``.

    Stored by column, so that later filters and checks read plain columns and only those they name; pushed through the
    parser they would parse each line once per reference.
    """
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    # Without a closing sign a quote sign is a character like others.
    parsed = F.when(F.col("_unclosed"), F.from_csv("value", schema, {"quote": ""})).otherwise(
        F.from_csv("value", schema, {"escape": '"'})
    )
    beyond = F.when(~F.col("_unclosed"), _beyond(F.col("value"), len(names)))
    lost = F.when(F.col("_unclosed"), F.col("value")).alias("_lost")
    cells = body.select(ORD, parsed.alias("r"), beyond.alias("_beyond"), lost)
    found = F.when(F.col("_beyond") != "", F.col("_beyond"))
    place = F.concat(F.lit("line "), F.col(ORD).cast("string"))
    said = F.lit(None).cast("string")
    if not surplus:
        said = F.when(found.isNotNull(), F.concat(place, F.lit(" has more cells than the header: "), found))
    if not unclosed:
        said = F.when(F.col("_lost").isNotNull(), F.concat(place, F.lit(" opens a quoted cell that is never closed"))).otherwise(said)
    if not (surplus and unclosed):
        # A condition on the rows, so that it holds whatever columns are read.
        cells = cells.where(F.when(said.isNotNull(), F.raise_error(said).cast("boolean")).otherwise(F.lit(True)))
    columns = [F.col(ORD), *[F.col(f"r.c{i}").alias(n) for i, n in enumerate(names)]]
    columns += [found.alias(SURPLUS)] if surplus else []
    return cells.select(*columns, *([F.col("_lost").alias(UNCLOSED)] if unclosed else []))


def read_report(
    spark: SparkSession, path: str, start_row: int = 1, multiline: bool = True, surplus: bool = False, unclosed: bool = False
) -> DataFrame:
    """One report as text columns plus the order key ``_ord`` (its physical line number).

    ``path`` is a file, or a folder of files that all carry the same preamble and header. Lines above ``start_row`` are
    skipped, the next one is the header; null tokens become null and rows without any value are dropped. A row with more
    cells than the header stops the read, unless ``surplus`` asks for them in the column ``SURPLUS``. So does a quoted cell
    that is never closed, unless ``unclosed`` asks for such lines in the column ``UNCLOSED``; the lines below are then read
    as if nothing were open.
    """
    table = _cells(*_body(spark, path, start_row, multiline), surplus, unclosed)
    stored = durable(null_tokens_to_null(table, keep=[ORD]))
    return drop_all_null(stored, keep=[ORD])
