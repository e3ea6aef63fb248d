"""Connected components of a link table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm.spark_io import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of ``links`` (a, b): the smallest node reachable.

    A round takes the smallest label among a node's neighbours and then the
    label of that label.  Every round is written to the shared folder; the
    driver only sees a sum of labels, which falls until nothing changes.
    """
    both = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component")), "labels")
    total = _sum(labels)
    while total is not None:
        near = (
            both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        )
        least = labels.join(near, "node").select("node", F.least("component", "near").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        labels = written(least.join(jump, "component").select("node", F.least("component", "further").alias("component")), "labels")
        before, total = total, _sum(labels)
        if total == before:
            break
    return labels


def _sum(labels: DataFrame):
    return labels.agg(F.sum(F.col("component").cast("decimal(38,0)"))).first()[0]
