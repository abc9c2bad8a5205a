"""Query of the decontamination operator."""

from __future__ import annotations

from ledgerloom.llm.columns import table
from ledgerloom.llm.qgrams import find_leaks
from ledgerloom.llm.registry import query


@query("op8_decontamination", None)
def _(spark, sf_dir):
    """Benchmark passages within the documents: one row per document and passage found."""
    return find_leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
