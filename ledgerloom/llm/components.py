"""Connected components of a link table, computed on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.runtime import bounded_parts, durable


def components(links: DataFrame, most: int | None = None) -> DataFrame:
    """``id, component`` of every id in ``links`` (``a, b``); a component is named by its smallest id.

    Each round takes the smallest label among the neighbours and then the label's own label, so paths shorten by
    more than half per round. Every round is stored in the shared folder; only a count of changes reaches the driver.
    ``most`` is a bound of the number of links, where one is known: few links are then stored in few files.
    """

    def stored(df: DataFrame) -> DataFrame:
        return durable(df if most is None else bounded_parts(df, 2 * most))

    links = links.select("a", "b").where("a <> b")
    both = stored(links.union(links.select("b", "a")).distinct())
    labels = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("label"))
    labels = stored(labels.select("id", F.least("id", "label").alias("label")))
    while True:
        near = (
            both.join(labels.select(F.col("id").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("near"))
        )
        lower = labels.join(near, labels["id"] == near["a"]).select("id", "label", F.least("label", "near").alias("low"))
        lower = stored(lower)
        target = lower.select(F.col("id").alias("low"), F.col("low").alias("next"))
        jumped = stored(
            lower.join(target, "low", "left").select(
                "id", F.least("low", F.coalesce("next", "low")).alias("label"), (F.col("label") != F.least("low", F.coalesce("next", "low"))).alias("moved")
            )
        )
        labels = jumped.select("id", "label")
        if jumped.where("moved").limit(1).count() == 0:
            return labels.select("id", F.col("label").alias("component"))
