"""Query of the quality classifier."""

from __future__ import annotations

from ledgerloom.llm.columns import table
from ledgerloom.llm.cotraining import classify
from ledgerloom.llm.registry import query


@query("op5_quality_classifier", None)
def _(spark, sf_dir):
    scored = classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "quality_text", "quality_page", "quality", "kept")
