"""Connected components of a link table, by contraction in Spark.

Each round every node points to its smallest neighbour if that is smaller than
itself; pointers are followed to their roots by doubling; both ends of each
link are replaced by their roots.  Rounds end when no link is left, after a
logarithmic number of them in practice.  All state is a stored table, so a
lost executor rereads files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leadlens.llm.common import materialized


def roots_of(pointers: DataFrame) -> DataFrame:
    """Follow ``pointers(node, root)`` to the end; every root points to itself or is no node."""
    while True:
        there = pointers.select(F.col("node").alias("root"), F.col("root").alias("next"))
        pointers = materialized(pointers.join(there, "root", "left").select(
            "node", F.coalesce("next", "root").alias("root"),
            F.coalesce(F.col("next") != F.col("root"), F.lit(False)).alias("moved")), "pointers")
        moved = pointers.where("moved").isEmpty()
        pointers = pointers.select("node", "root")
        if moved:
            return pointers


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links(a, b)``; component is a node of it."""
    links = materialized(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                         .where("a <> b").distinct(), "links")
    labels = None
    while not links.isEmpty():
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pointers = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")).select(
            "node", F.least("node", "least").alias("root"))
        roots = roots_of(materialized(pointers, "pointers"))
        if labels is None:
            labels = roots.select("node", F.col("root").alias("component"))
        else:
            new = roots.select(F.col("node").alias("component"), F.col("root"))
            labels = materialized(labels.join(new, "component", "left").select(
                "node", F.coalesce("root", "component").alias("component")), "labels")
        left = roots.select(F.col("node").alias("a"), F.col("root").alias("ra"))
        right = roots.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        links = materialized(links.join(left, "a").join(right, "b").where("ra <> rb").select(
            F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "links")
    if labels is None:
        return links.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels
