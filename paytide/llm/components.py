"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .tables import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (u, v): the smallest node it can reach.

    In each round every node points to the least of itself and its neighbours, and then to where
    that one points; nodes with a common target become one, and the links between the targets
    go on to the next round, so rounds shrink. Each is a written table: a lost executor costs no
    earlier round.
    """
    edges = written(links.where("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "links")
    labels = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("to"))
        step = least.select(F.col("u").alias("to"), F.col("to").alias("beyond"))
        points = written(least.join(step, "to").select("u", F.col("beyond").alias("to")), "points")
        if labels is None:
            labels = points.select(F.col("u").alias("node"), F.col("to").alias("component"))
        else:
            further = points.select(F.col("u").alias("component"), F.col("to").alias("next"))
            labels = labels.join(further, "component", "left").select("node", F.coalesce("next", "component").alias("component"))
        labels = written(labels, "labels")
        at_u = points.select("u", F.col("to").alias("new_u"))
        at_v = points.select(F.col("u").alias("v"), F.col("to").alias("new_v"))
        moved = edges.join(at_u, "u").join(at_v, "v").where("new_u <> new_v")
        edges = moved.select(F.least("new_u", "new_v").alias("u"), F.greatest("new_u", "new_v").alias("v")).distinct()
        edges = written(edges, "links")
        if edges.isEmpty():
            return labels
