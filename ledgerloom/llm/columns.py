"""Column helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space between words: blank, tab, line feed, vertical tab, form feed, carriage return (fixed value).
WORD_GAPS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z; other letters stay."""
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """Runs of characters other than ``WORD_GAPS``; null text has none."""
    flat = F.translate(F.coalesce(text, F.lit("")), WORD_GAPS, " " * len(WORD_GAPS))
    return F.array_remove(F.split(flat, " "), "")


def uniform(*parts: Column) -> Column:
    """A number in (0, 1] drawn from the hash of ``parts``: the same parts give the same number everywhere."""
    top = F.shiftrightunsigned(F.xxhash64(*parts), 11)
    return (top + 1) / F.lit(float(2**53))
