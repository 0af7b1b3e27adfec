"""Connected components of an edge table, by contraction."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """(node, label) for every node of ``edges`` (a, b: long, not null); the
    label is the smallest node of the component.

    Each round maps every node to its smallest neighbour's smallest neighbour
    (or itself) and contracts the edges; rounds go with the logarithm of the
    longest path. All joins are by node; each round's tables are written, so
    lineage stays short. A node of very many edges is reduced by partial
    aggregation, and adaptive execution splits its rows in the joins.
    """
    edges = written(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("b"))
        step = written(least.select("node", F.least("node", "b").alias("to")), "step")
        jump = step.select(F.col("node").alias("to"), F.col("to").alias("next"))
        step = written(step.join(jump, "to").select("node", F.col("next").alias("to")), "jump")
        if labels is None:
            labels = step.select("node", F.col("to").alias("label"))
        else:
            moved = step.select(F.col("node").alias("label"), "to")
            labels = labels.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
        labels = written(labels, "labels")
        a, b = (step.select(F.col("node").alias(c), F.col("to").alias(f"to_{c}")) for c in "ab")
        edges = edges.join(a, "a").join(b, "b").filter("to_a <> to_b")
        edges = written(edges.select(F.col("to_a").alias("a"), F.col("to_b").alias("b")).distinct(), "edges")
    if labels is None:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index of each of n nodes' component, for the pairs (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new
