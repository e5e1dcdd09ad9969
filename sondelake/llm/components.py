"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sondelake.operators.scratch import write_scratch


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``component`` (the smallest id reachable) of every id in ``links`` (a, b).

    Each round every id takes the smallest label among its neighbours and then that label's own
    label, so that distances halve. Labels are sums over hot ids by map-side minima; each round is
    written to the shared folder, so its plan stays short and survives lost executors.
    """
    both = write_scratch(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = write_scratch(
        both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("component")), "labels"
    )
    while True:
        near = (
            both.join(labels, both.b == labels.id)
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("near"))
        )
        lower = labels.join(near, "id").select(
            "id", F.col("component").alias("old"), F.least("component", "near").alias("component")
        )
        target = labels.select(F.col("id").alias("label"), F.col("component").alias("beyond"))
        moved = write_scratch(
            lower.join(target, lower.component == target.label, "left").select(
                "id", "old", F.least("component", F.coalesce("beyond", "component")).alias("component")
            ),
            "labels",
        )
        labels = moved.select("id", "component")
        if moved.where("component < old").isEmpty():
            return labels
