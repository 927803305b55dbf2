"""Connected components of a graph in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martflow.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of the nodes of ``edges`` (a, b longs); a component is its smallest node.

    Every round a node takes the smallest label among its neighbours and itself,
    and then the label that this label has itself, so labels travel along paths
    in leaps. Only longs move; a frequent node's messages fold before the shuffle.
    """
    both = stored(edges.select("a", "b").union(edges.select("b", "a")).distinct(), "edges")
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")), "labels"
    )
    while True:
        heard = (
            both.join(labels, F.col("b") == F.col("node"))
            .groupBy(F.col("a").alias("to"))
            .agg(F.min("component").alias("heard"))
        )
        nearer = labels.join(heard, F.col("node") == F.col("to")).select(
            "node", "component", F.least("component", "heard").alias("nearer")
        )
        leaps = labels.select(F.col("node").alias("via"), F.col("component").alias("leap"))
        moved = stored(
            nearer.join(leaps, F.col("nearer") == F.col("via"), "left").select(
                "node",
                F.least("nearer", "leap").alias("next"),
                (F.least("nearer", "leap") < F.col("component")).alias("changed"),
            ),
            "labels",
        )
        labels = moved.select("node", F.col("next").alias("component"))
        if moved.filter("changed").isEmpty():
            return labels
