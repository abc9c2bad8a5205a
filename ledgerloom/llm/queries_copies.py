"""Queries of the duplicate operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.llm.columns import table
from ledgerloom.llm.minhash import near_duplicates
from ledgerloom.llm.registry import query
from ledgerloom.llm.repeats import remove_repeats


@query("op10_minhash", None)
def _(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op6_suffix_repeats", None)
def _(spark, sf_dir):
    cleaned = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
