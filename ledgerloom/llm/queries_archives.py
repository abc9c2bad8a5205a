"""Query of the archive operator."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.llm.columns import table
from ledgerloom.llm.registry import query
from ledgerloom.llm.warc import read_archives, write_archives


@query("op7_warc", None)
def _(spark, sf_dir):
    """Writes all pages and reads them back; a record that fails a check fails the query."""
    records = read_archives(write_archives(table(spark, sf_dir, "pages")), with_payload=False)
    broken = F.raise_error(F.concat_ws(": ", "archive", F.col("frame").cast("string"), "error"))
    digest = F.when(F.col("error").isNull(), F.col("payload_digest")).otherwise(broken)
    return records.select("page_id", "payload_bytes", digest.alias("payload_digest"), "record_type", "refers_to")
