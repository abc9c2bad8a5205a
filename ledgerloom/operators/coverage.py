"""Uploaded files against the files a mapping expects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def kept_reports(uploaded: DataFrame, mapped: DataFrame) -> DataFrame:
    """Reports to process: all of them unless fewer files were uploaded than mapped.

    With fewer files, reports need at least one uploaded file. ``uploaded(file_name)`` lists the files,
    ``mapped(report_name, file_name)`` the expected files per report.
    """
    files = uploaded.select("file_name").distinct()
    enough = files.agg(F.count(F.lit(1))).scalar() >= mapped.agg(F.count(F.lit(1))).scalar()
    hits = mapped.join(files.withColumn("_hit", F.lit(True)), "file_name", "left")
    per_report = hits.groupBy("report_name").agg(F.count("_hit").alias("_hits"))
    return per_report.filter((F.col("_hits") > 0) | enough).select("report_name")


def missing_files(uploaded: DataFrame, mapped: DataFrame) -> DataFrame:
    return mapped.join(uploaded.select("file_name").distinct(), "file_name", "left_anti")


def untracked_files(uploaded: DataFrame, mapped: DataFrame) -> DataFrame:
    return uploaded.join(mapped.select("file_name").distinct(), "file_name", "left_anti")
