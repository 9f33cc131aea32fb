"""Connected components of a table of links, without bringing links to the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarrylens.llm.common import checkpointed, looked_up


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` for all nodes of ``links`` (columns ``a`` and ``b``); a component is named
    after its smallest node.

    Every round takes the smallest label among a node's neighbours and then the label of that label, so a
    path of n links needs about log n rounds. Each round is checkpointed and ends the loop if it
    changed nothing. Nodes with many neighbours are dealt to several tasks in each join and
    aggregated before the shuffle.
    """
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b")
    both = checkpointed(both.distinct())
    labels = checkpointed(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("near")).select("node", F.least("node", "near").alias("component")))
    while True:
        beside = looked_up(both, labels.select(F.col("node").alias("b"), "component"), ["b"], how="inner")
        nearest = labels.unionByName(beside.select(F.col("a").alias("node"), "component")).groupBy("node").agg(F.min("component").alias("component"))
        jumped = looked_up(labels.select(F.col("node"), F.col("component").alias("old")).join(nearest, "node"), nearest.select(F.col("node").alias("component"), F.col("component").alias("further")), ["component"])
        renamed = checkpointed(jumped.select("node", F.least("component", F.coalesce("further", "component")).alias("component"), "old"))
        changed = not renamed.filter("old <> component").isEmpty()
        labels = renamed.select("node", "component")
        if not changed:
            return labels
