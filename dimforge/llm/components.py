"""Connected components of an edge table by alternating stars.

Each round links every node's larger neighbours to its smallest one (large
star), then its smaller neighbours to the smallest of those (small star).
Rounds need a number that grows with the logarithm of the longest path.  A
node's neighbours are never gathered: their smallest is a partial aggregate,
and the join that gives it back to each neighbour is one whose hot keys AQE
splits, as the aggregate is written first.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dimforge.llm.common import discard, materialize, table_folder


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node of (a, b) to the smallest node of its component."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j, label = at[:len(a)], at[len(a):], np.arange(len(nodes))
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, label[i], low)
        np.minimum.at(new, label[j], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    rest = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[label[rest]], nodes[rest]


def _large_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The linked edges, and the written table that they are made with."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select("b", "a"))
    least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return both.join(least, "u").where("v > u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct(), least


def _small_star(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    least = materialize(edges.groupBy("b").agg(F.min("a").alias("m")), "least")
    rest = edges.join(least, "b").where("a != m").select(F.col("m").alias("a"), F.col("a").alias("b"))
    return rest.union(least.select(F.col("m").alias("a"), "b")).distinct(), least


def connected(edges: DataFrame) -> DataFrame:
    """node, component (its smallest node) for every node of edges (a, b), a < b.

    Defined cases: no edges give no rows; repeated edges count once.
    """
    spark = edges.sparkSession
    now = materialize(edges.select("a", "b"), "edges")
    state = None
    while True:
        stats = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(stats) == state or not stats[0]:
            break
        state = tuple(stats)
        for star in (_large_star, _small_star):
            linked, least = star(now)
            after = materialize(linked, "edges")
            discard(spark, table_folder(now), table_folder(least))
            now = after
    members = now.select(F.col("b").alias("node"), F.col("a").alias("component"))
    return members.union(now.select("a", "a").distinct())
