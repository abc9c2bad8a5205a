"""Grouping tables delivered as one nested JSON response."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _rows(df: DataFrame, steps: tuple[str, ...]) -> DataFrame | None:
    """Follows ``steps`` down the nesting, exploding lists on the way; None where a step is missing."""
    for step in steps:
        kind = df.schema["g"].dataType
        if isinstance(kind, T.ArrayType):
            df = df.select(F.explode("g").alias("g"))
            kind = kind.elementType
        if not isinstance(kind, T.StructType) or step not in kind.names:
            return None
        df = df.select(F.col("g")[step].alias("g"))
    return df.select(F.explode("g").alias("g")) if isinstance(df.schema["g"].dataType, T.ArrayType) else None


def read_groupings(spark: SparkSession, path: str) -> DataFrame:
    """One row per nominal code, from either response shape."""
    response = spark.read.option("multiLine", True).json(path).select(F.col("data").alias("g"))
    shapes = (
        ("nominalCodeMappings", "grouping"),
        ("getDataIngestionGroupings", "grouper", "groupingCodes"),
    )
    for shape in shapes:
        rows = _rows(response, shape)
        if rows is not None:
            return rows.select("g.*")
    raise ValueError("no grouping rows in the response")


# Fields of a grouping row in either response shape, by the name the library gives them (fixed values).
_FIELDS = {
    "nominalCode": ("nominalCode",),
    "description": ("description", "glAccountName"),
    "account": ("account", "accountType"),
    "accountSubtype": ("accountSubtype", "accountSubType"),
    "fsCaption": ("fsCaption",),
    "accountName": ("accountName",),
    "mapped": ("mapped",),
}


def read_grouping_lines(spark: SparkSession, path: str) -> DataFrame:
    """One row per nominal code from a file or folder of JSON lines, each a response of either shape.

    Files are read in splits; a line is parsed once into a variant, and its shape is found per line. A line that is no
    response of either shape gives no rows, and a line that is no JSON stops the read. Fields a shape lacks are null.
    """
    lines = spark.read.text(path).filter(F.trim("value") != "").select(F.parse_json("value").alias("v"))
    flat = F.try_variant_get("v", "$.data.nominalCodeMappings.grouping", "array<variant>")
    nested = F.try_variant_get("v", "$.data.getDataIngestionGroupings", "array<variant>")
    inner = F.transform(
        F.coalesce(nested, F.array().cast("array<variant>")),
        lambda g: F.coalesce(F.try_variant_get(g, "$.grouper.groupingCodes", "array<variant>"), F.array().cast("array<variant>")),
    )
    every = F.concat(F.coalesce(flat, F.array().cast("array<variant>")), F.flatten(inner))
    rows = lines.select(F.explode(every).alias("g"))
    return rows.select(
        *[
            F.coalesce(*[F.try_variant_get("g", f"$.{name}", "string") for name in names]).alias(field)
            for field, names in _FIELDS.items()
        ]
    )
