"""Connected components of an edge table that never leaves the executors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.common import materialize


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``node, comp`` for every node of ``edges`` (``a``, ``b``): the smallest
    node reachable.

    Every round each node takes the smallest label among its own and its
    neighbours' (one aggregation with map-side combine), then the label of its
    label (pointer jumping), until nothing changes: about log(diameter) rounds.
    Labels are stored after each round; nothing is collected but a count.
    """
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")).filter("a <> b").distinct(), f"{name}-edges")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("m"))
                         .select(F.col("a").alias("node"), F.least("a", "m").alias("comp")), name)
    while True:
        seen = labels.select(F.col("node").alias("b"), F.col("comp").alias("near"))
        low = both.join(seen, "b").groupBy("a").agg(F.min("near").alias("low"))
        hooked = (labels.join(low, labels["node"] == low["a"])
                  .select("node", F.col("comp").alias("old"), F.least("comp", "low").alias("comp")))
        jump = labels.select(F.col("node").alias("comp"), F.col("comp").alias("far"))
        new = materialize(hooked.join(jump, "comp", "left")
                          .select("node", "old", F.least("comp", F.coalesce("far", "comp")).alias("comp")), name)
        labels = new.select("node", "comp")
        if new.filter("old <> comp").isEmpty():
            return labels
