"""Connected components of links that are spread over the cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgate.llm.frames import written


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of (a, b): root is the component's smallest node.

    Every round takes the least label among a node and its neighbours, then the
    label's own label, so a path shortens by more than half. A round is a table in
    the shared folder: lineage stays short, and nothing but a count reaches the
    driver. A node with very many links is combined before it is shuffled.
    """
    both = links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct()
    both = written(both, "links")
    labels = written(
        both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")),
        "labels",
    )
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(
            F.col("a").alias("node")
        ).agg(F.min("root").alias("near"))
        jump = labels.select(F.col("node").alias("root"), F.col("root").alias("far"))
        step = (
            labels.join(near, "node")
            .join(jump, "root")
            .select("node", "root", F.least("root", "near", "far").alias("new"))
        )
        step = written(step, "labels")
        changed = step.filter("new <> root").limit(1).count()
        labels = step.select("node", F.col("new").alias("root"))
        if not changed:
            return labels
