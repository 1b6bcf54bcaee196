"""Connected components of an edge table, without vertices or edges on the driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import pin


def _parents(edges: DataFrame) -> DataFrame:
    """Each vertex with the smallest of itself and its neighbours, followed to where that ends."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    up = pin(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.col("a")).alias("p")), "parents")
    while True:
        next_ = up.select(F.col("v").alias("_v"), F.col("p").alias("_p"))
        jumped = pin(
            up.join(next_, F.col("p") == F.col("_v")).select("v", "p", F.col("_p").alias("q")), "jump"
        )
        if jumped.filter("q < p").isEmpty():
            return up
        up = jumped.select("v", F.col("q").alias("p"))


def components(edges: DataFrame) -> DataFrame:
    """(v, label) for every vertex of the edges (a, b): the label is one vertex of its component.

    Every round joins each vertex to a root among its neighbours' chains and
    keeps the edges between different roots, so at least half of the vertices
    of each remaining component go.
    """
    edges = pin(edges.filter("a <> b").select("a", "b").distinct(), "links")
    labels = None
    while True:
        up = _parents(edges)
        root = up.select(F.col("v").alias("label"), F.col("p").alias("_p"))
        if labels is None:
            labels = up.select("v", F.col("p").alias("label"))
        else:
            labels = pin(
                labels.join(root, "label", "left").select("v", F.coalesce("_p", "label").alias("label")), "labels"
            )
        one = up.select(F.col("v").alias("a"), F.col("p").alias("_a"))
        two = up.select(F.col("v").alias("b"), F.col("p").alias("_b"))
        edges = pin(
            edges.join(one, "a").join(two, "b").filter("_a <> _b")
            .select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).distinct(),
            "links",
        )
        if edges.isEmpty():
            return labels
