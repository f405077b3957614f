"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skymetrics.llm.staging import stage


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for the ends of ``edges`` (a, b), nodes of any orderable type.

    ``component`` is the smallest node that can be reached; a smallest node
    itself has no row.  Each round links every larger neighbour of a node to the
    smallest one, then every node to its smallest neighbour, until nothing
    changes; no node's neighbours are gathered in one place.
    """
    now = stage(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u != v").distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.select(F.col("u").alias("x"), F.col("v").alias("y")).unionByName(now.select(F.col("v").alias("x"), F.col("u").alias("y")))
        least = stage(both.groupBy("x").agg(F.least(F.min("y"), F.col("x")).alias("m")), "least")
        large = stage(both.join(least, "x").filter("y > x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct(), "large")
        nearest = stage(large.groupBy("u").agg(F.min("v").alias("m")), "nearest")
        small = large.join(nearest, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stage(small.unionByName(nearest.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, state = state, _state(now)
        if before == state:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
