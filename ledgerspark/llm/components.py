"""Connected components of a link table by hooking and pointer jumping, as Spark joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerspark.llm.common import materialise


def _jump(parents: DataFrame) -> DataFrame:
    """One pointer jump: each node takes its parent's parent."""
    up = parents.select(F.col("node").alias("up"), F.col("parent").alias("above"))
    return parents.join(up, F.col("parent") == F.col("up"), "left").select(
        "node", F.coalesce("above", "parent").alias("parent"))


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """``node, label`` for every node of ``links`` (``a``, ``b`` longs); the label is one of the component's nodes.

    Each round every node hooks to its smallest neighbour, pointers are jumped, and the
    links are rewritten between the roots; links within a root go. The tables of a
    round are written to the shared folder. Nothing is collected.
    """
    edges = materialise(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                        .filter("a < b").distinct(), name)
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
            "node", F.least("node", "m").alias("parent")), name)
        roots = materialise(_jump(_jump(hooks)), name)
        if labels is None:
            labels = roots.withColumnRenamed("parent", "label")
        else:
            # nodes of later rounds are roots of earlier ones, so every label is looked up once more
            labels = labels.join(roots, F.col("label") == roots["node"], "left").select(
                labels["node"], F.coalesce("parent", "label").alias("label"))
        labels = materialise(labels, name)
        a = roots.select(F.col("node").alias("a"), F.col("parent").alias("pa"))
        b = roots.select(F.col("node").alias("b"), F.col("parent").alias("pb"))
        edges = materialise(edges.join(a, "a").join(b, "b").filter("pa <> pb").select(
            F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), name)
    if labels is None:
        labels = edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
