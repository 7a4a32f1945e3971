"""Connected components of a graph given by its edges."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Keep = Callable[[DataFrame, str], DataFrame]
"""Writes an intermediate table and reads it back, e.g. ``lambda df, n: stage(df, folder, n)``."""


def connected(edges: DataFrame, keep: Keep) -> DataFrame:
    """The least vertex of each vertex's component: ``vertex``, ``least``.

    ``edges`` has columns ``a`` and ``b``; an edge from a vertex to itself only names it. In every
    round a vertex takes the least label among its neighbours', and then that label's own label,
    so labels reach twice as far each time and rounds grow with the logarithm of a component's
    diameter. A vertex with many edges is folded map-side before its neighbours meet.
    """
    forth = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    both = keep(forth.unionByName(forth.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    first = both.groupBy(F.col("u").alias("vertex")).agg(F.min("v").alias("n"))
    labels = keep(first.select("vertex", F.least("vertex", "n").alias("least")), "labels_0")
    turn = 0
    while True:
        turn += 1
        near = (
            both.join(labels, F.col("u") == F.col("vertex"))
            .groupBy(F.col("v").alias("vertex"))
            .agg(F.min("least").alias("near"))
        )
        met = labels.join(near, "vertex").select(
            "vertex", F.col("least").alias("old"), F.least("least", "near").alias("mid")
        )
        onward = labels.select(F.col("vertex").alias("mid"), F.col("least").alias("far"))
        moved = keep(
            met.join(onward, "mid").select("vertex", "old", F.least("mid", "far").alias("least")),
            f"labels_{turn}",
        )
        if moved.where("least <> old").isEmpty():
            return moved.select("vertex", "least")
        labels = moved.select("vertex", "least")
