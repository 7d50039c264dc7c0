"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedloom.llm.frames import stored


def components(edges: DataFrame) -> DataFrame:
    """``node, label`` of every node with an edge ``a, b``: the label is the component's smallest node.

    Edges lead from the larger node ``a`` to the smaller ``b``. A round is a large star and a
    small star (Kiveris et al., 2014): each node's larger neighbours are hooked to its smallest
    neighbour, then its smaller ones are. Neither adds edges, and long chains fold up in a few
    rounds whatever the order of their nodes. Rounds go on until only stars around the smallest
    nodes are left, however many that takes; each is stored. Minima are formed before they are
    shuffled and stored, so a node with very many edges is no hot key there, and joins on it
    can be split. Edges with a null end are no edges; no edges give no rows, repeated ones count once.
    """
    loops = edges.where(F.col("a") == F.col("b")).select("a", "b")
    found = edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    found = stored(found.distinct(), "edges")
    while True:
        least = least_neighbours(found)
        chained = found.join(least.select(F.col("node").alias("b")), "b", "left_semi")
        if chained.isEmpty() and found.count() == least.count():
            break
        large = found.join(least, F.col("b") == F.col("node"), "left").select("a", F.coalesce("least", "b").alias("b"))
        large = stored(large.distinct(), "edges")
        least = least_neighbours(large)
        small = large.join(least, F.col("a") == F.col("node")).where(F.col("b") != F.col("least"))
        small = small.select(F.col("b").alias("a"), F.col("least").alias("b")).union(least)
        found = stored(small.distinct(), "edges")
    labels = found.union(found.select("b", "b")).union(loops).toDF("node", "label")
    return stored(labels.groupBy("node").agg(F.min("label").alias("label")), "labels")


def least_neighbours(edges: DataFrame) -> DataFrame:
    """``node, least``: the smallest neighbour of each node that has a smaller one; stored."""
    return stored(edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")), "least")
