"""Writers. Each writes a folder of part files in parallel; nothing passes through the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.columns import named


def write_table(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Canonical, grouped or step result table; nulls become empty cells."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        # Blanks around a value belong to it.
        options = {"header": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
        writer.options(**options).csv(path)
    else:
        writer.format(fmt).save(path)


def preview(df: DataFrame, rows: int = 10, order_by: str | None = None) -> DataFrame:
    """First rows as one JSON document ``{"data": [...]}`` in column ``value``.

    Each row is numbered while it passes the limit, so the document keeps their order.
    """
    first = (df.orderBy(named(order_by)) if order_by else df).limit(rows)
    record = F.struct(*[named(c) for c in df.columns if c != order_by])
    placed = first.select(F.monotonically_increasing_id().alias("i"), record.alias("row"))
    listed = F.array_sort(F.collect_list(F.struct("i", F.to_json("row", {"ignoreNullFields": "false"}).alias("j"))))
    texts = F.array_join(F.transform(listed, lambda p: p["j"]), ", ")
    return placed.agg(F.concat(F.lit('{"data": ['), texts, F.lit("]}")).alias("value"))


def write_preview(df: DataFrame, path: str, rows: int = 10, order_by: str | None = None) -> None:
    preview(df, rows, order_by).write.mode("overwrite").text(path)


def _quoted(text: Column) -> Column:
    """A text as JSON, its quote signs, backslashes and line breaks escaped."""
    held = F.to_json(F.struct(F.coalesce(text, F.lit("")).alias("v")))
    return F.substring(held, F.lit(len('{"v":') + 1), F.length(held) - len('{"v":}'))


def _object(name: Column, body: Column) -> Column:
    return F.concat(F.lit("{"), _quoted(name), F.lit(": "), body, F.lit("}"))


def _joined(parts: Column) -> Column:
    return F.concat(F.lit("["), F.array_join(parts, ", "), F.lit("]"))


def _whole(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("0"))


def _metric_json() -> Column:
    """One metric row as JSON text, in the layout of its section."""
    fields = F.coalesce(F.col("fields"), F.array().cast("array<struct<name:string,percent:int,present:boolean>>"))
    names = F.transform(fields, lambda f: _quoted(f["name"]))
    shares = F.transform(fields, lambda f: _object(f["name"], f["percent"].cast("string")))
    flags = F.transform(fields, lambda f: _object(f["name"], f["present"].cast("string")))
    count_name = F.when(F.col("metric") == "fieldsFilled", "filled").otherwise("empty")
    profile = F.concat(
        F.lit('{"percent": '), _whole(F.col("percent")),
        F.lit(', "total": '), _whole(F.col("total")),
        F.lit(', "'), count_name, F.lit('": '), _whole(F.col("count")),
        F.lit(', "fields": '),
        F.when(F.col("metric") == "missingRecords", _joined(shares)).otherwise(_joined(names)),
        F.lit("}"),
    )
    warned = F.col("warning").isNotNull()
    sequence_field = F.concat(
        F.lit('{"journalId": '), F.element_at("fields", 1)["present"].cast("string"),
        F.lit(', "show_warning": '), warned.cast("string"),
        F.when(warned, F.concat(F.lit(', "warning": '), _quoted(F.col("warning")))).otherwise(""),
        F.lit("}"),
    )
    sequence = F.concat(
        F.lit('{"overall": '), _whole(F.col("percent")), F.lit(', "fields": ['), sequence_field, F.lit("]}")
    )
    presence = F.concat(
        F.lit('{"overall": '), F.col("percent").cast("double").cast("string"),
        F.lit(', "fields": '), _joined(flags), F.lit("}"),
    )
    body = (
        F.when(F.col("section") == "statistical", F.col("value").cast("string"))
        .when(F.col("section") == "profile", profile)
        .when(F.col("metric") == "missingSequentialItems", sequence)
        .when(F.col("outcome").isNotNull(), _quoted(F.col("outcome")))
        .otherwise(presence)
    )
    return _object(F.col("metric"), body)


def scorecard_document(scorecard: DataFrame, metric_order: Sequence[str]) -> DataFrame:
    """The nested scorecard as one JSON text in column ``value``.

    A scorecard has a fixed number of metrics for each of the few canonical tables.
    """
    place = F.array_position(F.array(*[F.lit(m) for m in metric_order]), F.col("metric"))
    rows = scorecard.select("entity", "section", place.alias("p"), _metric_json().alias("j"))

    def section(name: str) -> Column:
        cells = F.collect_list(F.when(F.col("section") == name, F.struct("p", "j")))
        return F.concat(
            F.lit(f'"{name}": '), _joined(F.transform(F.array_sort(cells), lambda c: c["j"]))
        )

    sections = [section(n) for n in ("statistical", "business_rule", "profile")]
    entities = rows.groupBy("entity").agg(F.concat_ws(", ", *sections).alias("s"))
    member = F.concat(_quoted(F.col("entity")), F.lit(": {"), F.col("s"), F.lit("}"))
    listed = F.array_join(F.array_sort(F.collect_list(member)), ", ")
    return entities.agg(F.concat(F.lit("{"), listed, F.lit("}")).alias("value"))


# Metric names in document order.
METRIC_ORDER = (
    "recordCount", "fieldCount", "amountSum", "localAmountSum", "debitCredits", "amountBeginingSum",
    "amountEndingSum", "glAccountCodeCount", "businessUnitCounts",
    "netting", "controlChecks", "reversals", "manualJournals", "missingSequentialItems",
    "fieldsFilled", "fieldsEmpty", "textFieldsEmpty", "numericFieldsEmpty", "missingRecords",
)


def write_scorecard(scorecard: DataFrame, path: str) -> None:
    scorecard_document(scorecard, METRIC_ORDER).write.mode("overwrite").text(path)


def write_groupings(grouping: DataFrame, quality: DataFrame, path: str) -> None:
    """Grouping rows (``account`` renamed ``accountType``) and the quality block, as JSON lines."""
    renamed = grouping.withColumnRenamed("account", "accountType")
    renamed.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/grouping")
    quality.write.mode("overwrite").json(f"{path}/quality")
