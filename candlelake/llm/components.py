"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialise


def _through(edges: DataFrame, labels: DataFrame) -> DataFrame:
    """Edges between the labels of their ends, without those inside one label."""
    one = labels.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    two = labels.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    out = edges.join(one, "a", "left").join(two, "b", "left")
    return out.select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).where("a <> b").distinct()


def components(edges: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """node, component (the smallest node that is reachable) for every node of the edges (a, b).

    With ``known``, the components of earlier edges, these grow by the new edges; only those are worked on. Each round hooks
    every node to its smallest neighbour, follows the hooks twice and contracts the edges, of which only those between
    different labels go on; a hub costs a partial aggregate. Labels never pass through the driver.
    """
    left = materialise(_through(edges, known) if known is not None else edges.select("a", "b").where("a <> b").distinct())
    labels: DataFrame | None = None
    while not left.isEmpty():
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = materialise(both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("component")))
        for _ in range(2):
            up = hooks.select(F.col("node").alias("of"), F.col("component").alias("higher"))
            before, hooks = hooks, materialise(hooks.join(up, F.col("component") == F.col("of")).select("node", F.col("higher").alias("component")))
            discard(before)
        before, left = left, materialise(_through(left, hooks))
        discard(before)
        labels = hooks if labels is None else materialise(_relabelled(labels, hooks))
    if labels is None:
        return known if known is not None else left.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return labels if known is None else materialise(_relabelled(known, labels))


def _relabelled(known: DataFrame, labels: DataFrame) -> DataFrame:
    """Known components with the labels of their label; nodes that only the labels have come along."""
    up = labels.select(F.col("node").alias("of"), F.col("component").alias("higher"))
    out = known.join(up, F.col("component") == F.col("of"), "left").select("node", F.coalesce("higher", "component").alias("component"))
    return out.unionByName(labels.join(known.select("node"), "node", "left_anti"))
