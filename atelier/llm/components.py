"""Connected components by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atelier.llm.shared import written


def components(links: DataFrame) -> DataFrame:
    """(node, label) of the nodes in links (a, b), label being the least node of the component.

    Labels go to neighbours and are then looked up in each other, so long chains shorten by powers. Every round is a
    table in the shared folder; hot nodes cost no more than rows that are pre-aggregated or split by skewed joins.
    """
    pairs = links.select("a", "b").where("a <> b")
    edges = written(pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("label")).select("node", F.least("node", "label").alias("label")), "labels")
    while True:
        near = edges.join(labels.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        low = labels.join(near, "node").select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        # a node's label is itself a node: take that node's label, if it is lower
        there = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        new = written(low.join(there, "label", "left").select("node", "old", F.least("label", "far").alias("label")), "labels")
        changed = new.where("old <> label").limit(1).count()
        labels = new.drop("old")
        if not changed:
            return labels
