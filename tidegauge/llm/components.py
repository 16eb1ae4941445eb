"""Connected components of a table of links, by rounds of joins on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.llm.common import discard, staged


def components(links: DataFrame) -> DataFrame:
    """id and component (its smallest reachable id) for every id in ``links`` (a, b).

    Each round takes the smallest label among the neighbours and then that label's own label, so
    labels travel over paths of doubling length. No part of the graph is collected.
    """
    both = links.select(F.col("a").alias("id"), F.col("b").alias("other"))
    both = both.unionByName(links.select(F.col("b").alias("id"), F.col("a").alias("other")))
    edges = staged(both.distinct(), "edges")
    labels = staged(edges.groupBy("id").agg(F.least("id", F.min("other")).alias("label")), "labels")
    while True:
        near = (
            edges.join(labels.withColumnRenamed("id", "other"), "other")
            .groupBy("id")
            .agg(F.min("label").alias("near"))
        )
        met = labels.join(near, "id").select("id", "label", F.least("label", "near").alias("best"))
        ahead = labels.select(F.col("id").alias("best"), F.col("label").alias("ahead"))
        moved = met.join(ahead, "best").select("id", "label", F.least("best", "ahead").alias("next"))
        moved, earlier = staged(moved, "labels"), labels
        settled = moved.filter("next < label").isEmpty()
        labels = moved.select("id", F.col("next").alias("component" if settled else "label"))
        labels._staged_at = moved._staged_at
        discard(earlier)
        if settled:
            discard(edges)
            return labels
