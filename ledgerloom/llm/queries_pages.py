"""Query of the extraction operator."""

from __future__ import annotations

from ledgerloom.llm.columns import table
from ledgerloom.llm.extract import extract
from ledgerloom.llm.registry import query


@query("op4_html_extraction", None)
def _(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
