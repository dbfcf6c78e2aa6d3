"""Connected components of a graph in a table, by label propagation with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewmill.llm.common import staged


def connected_components(edges: DataFrame) -> DataFrame:
    """``node``, ``label`` for every node of ``edges`` (``a``, ``b``); the label is the smallest node of its component.

    In each round a node takes the smallest label among its neighbours', then the label of its label, so distances
    halve. Only the number of changes reaches the driver; each round is written to the shared folder, which cuts the
    lineage. Nodes with very many edges are handled by partial minima and joins that Spark can split. Repeated edges,
    edges in both directions and loops are harmless; edges with a null end are left out. No edges, no rows.
    """
    both = edges.select("a", "b").where("a is not null and b is not null")
    both = staged(both.union(both.select("b", "a")).distinct(), "edges")
    labels = staged(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "labels"
    )
    while True:
        near = (
            both.join(labels, F.col("b") == F.col("node"))
            .groupBy(F.col("a").alias("at"))
            .agg(F.min("label").alias("near"))
        )
        hooked = labels.join(near, F.col("node") == F.col("at")).select(
            "node", F.col("label").alias("old"), F.least("label", "near").alias("label")
        )
        above = hooked.select(F.col("node").alias("top"), F.col("label").alias("higher"))
        hooked = hooked.join(above, F.col("label") == F.col("top"), "left").select(
            "node", "old", F.least("label", "higher").alias("label")
        )
        step = staged(hooked, "labels")
        if step.where(F.col("old") != F.col("label")).isEmpty():
            return step.select("node", "label")
        labels = step.select("node", "label")
