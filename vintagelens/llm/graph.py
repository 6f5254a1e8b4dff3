"""Connected components of an edge table, by contraction in joins and grouped minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vintagelens.llm.common import stored


def components(edges: DataFrame) -> DataFrame:
    """node, label for every node of ``edges`` (a, b: long); equal labels, same component.

    Each round sends every node to its least neighbour, jumps once, and contracts the edges;
    the rounds grow with the logarithm of the longest path. Every round is stored.
    """
    edges = stored(edges.where("a <> b").distinct(), "graph-edges")
    labels = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("label", F.col("node"))
    labels = stored(labels, "graph-labels")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = both.groupBy("a").agg(F.min("b").alias("p"))
        parent = parent.select(F.col("a").alias("n"), F.least("a", "p").alias("p"))
        parent = stored(parent, "graph-parents")
        above = parent.select(F.col("n").alias("p"), F.col("p").alias("pp"))
        jumped = stored(parent.join(above, "p").select("n", F.col("pp").alias("p")), "graph-jumped")

        def to(column: str, df: DataFrame, target=jumped) -> DataFrame:
            step = target.select(F.col("n").alias(column), F.col("p").alias("_to"))
            return df.join(step, column, "left").withColumn(column, F.coalesce("_to", column)).drop("_to")

        labels = stored(to("label", labels).select("node", "label"), "graph-labels")
        moved = to("b", to("a", edges)).where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        edges = stored(moved.distinct(), "graph-edges")
    return labels
