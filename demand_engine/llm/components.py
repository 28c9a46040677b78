"""Connected components of a table of links by minimum labels with pointer jumping.

Every round takes the smallest label next door and then the label's own label, so a chain of n links needs
about log n rounds. Labels and links stay distributed; each round's labels are a written table, and the
driver reads one number a round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demand_engine.session import cut_lineage


def components(links: DataFrame) -> DataFrame:
    """``id, component`` for every id of ``links`` (``a, b``); the component is its smallest id."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    edges = cut_lineage(both.where("a <> b").distinct(), "edges")
    labels = cut_lineage(
        edges.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("component")).withColumnRenamed("a", "id"), "labels"
    )
    while True:
        around = (
            edges.join(labels.withColumnRenamed("id", "b"), "b")
            .groupBy(F.col("a").alias("id"))
            .agg(F.min("component").alias("_near"))
        )
        nearer = labels.join(around, "id").select(
            "id", F.col("component").alias("_old"), F.least("component", "_near").alias("_new")
        )
        # A label is an id itself, so its own label is one lookup away.
        own = labels.select(F.col("id").alias("_new"), F.col("component").alias("_own"))
        found = cut_lineage(
            nearer.join(own, "_new", "left").select(
                "id", F.least(F.col("_new"), F.coalesce("_own", "_new")).alias("component"), "_old"
            ),
            "labels",
        )
        labels = found.select("id", "component")
        if not found.where("component <> _old").limit(1).count():
            return labels
