"""Connected components by least-label propagation with shortcuts; nothing is collected."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slabworks.llm.common import written


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) for each node of an edge: label is the least node that can be reached.

    Each round takes the least label among a node's neighbours and then that label's own label, and is written to
    the shared folder, so that lost executors cost one round at most.  Rounds go on until no label changes.  Nodes
    with any number of edges are handled by partial aggregation and splittable joins.  Null ends, loops and
    repeated edges are allowed; no edges give no rows.
    """
    both = edges.where(f"{a} is not null and {b} is not null")
    both = written(both.select(F.col(a).alias("src"), F.col(b).alias("dst")).union(both.select(b, a)).distinct(), "edges")
    labels = written(both.groupBy(F.col("src").alias("node")).agg(F.least(F.col("node"), F.min("dst")).alias("label")), "labels")
    while True:
        near = both.join(labels, both.dst == labels.node).groupBy("src").agg(F.min("label").alias("near"))
        lower = labels.join(near, labels.node == near.src).select("node", F.col("label").alias("before"), F.least("label", "near").alias("via"))
        up = labels.select(F.col("node").alias("via"), F.col("label").alias("up"))
        step = written(lower.join(up, "via", "left").select("node", "before", F.coalesce(F.least("via", "up"), "via").alias("label")), "labels")
        labels = step.select("node", "label")
        if step.where("label <> before").limit(1).count() == 0:
            return labels
