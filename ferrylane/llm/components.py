"""Connected components of links between ids, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ferrylane.llm.common import Workspace


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("high", "low"))).first())


def components(ws: Workspace, links: DataFrame) -> DataFrame:
    """For each id in the links (columns a and b): ``id``, ``component_id``, the smallest id that it reaches.

    Every round connects neighbours of an id to the smallest of them; stars at the end. Minima are partial
    aggregates, written before they are joined back, so that joins can split the ids with many neighbours.
    """
    edges = ws.save(
        links.where("a <> b").select(F.greatest("a", "b").alias("high"), F.least("a", "b").alias("low")).distinct(), "edges")
    state = _state(edges)
    while True:
        both = edges.select(F.col("high").alias("id"), F.col("low").alias("other")).unionByName(
            edges.select(F.col("low").alias("id"), F.col("high").alias("other")))
        nearest = ws.save(both.groupBy("id").agg(F.least("id", F.min("other")).alias("low")), "large-star")
        large = ws.save(both.where("other > id").join(nearest, "id").select(F.col("other").alias("high"), "low").distinct(), "large")
        lowest = ws.save(large.groupBy("high").agg(F.min("low").alias("lowest")), "small-star")
        small = large.join(lowest, "high").where("low <> lowest").select(F.col("low").alias("high"), F.col("lowest").alias("low"))
        following = ws.save(small.unionByName(lowest.select("high", F.col("lowest").alias("low"))).distinct(), "edges")
        ws.drop(edges, nearest, large, lowest)
        edges, before = following, state
        state = _state(edges)
        if state == before:
            break
    centres = edges.select(F.col("low").alias("id"), F.col("low").alias("component_id")).distinct()
    return edges.select(F.col("high").alias("id"), F.col("low").alias("component_id")).unionByName(centres)
