"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import checkpointed


def _state(edges: DataFrame) -> tuple:
    """Equal for equal sets of edges, and for others with negligible chance."""
    mark = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(mark)).first())


def components(edges: DataFrame) -> DataFrame:
    """``u`` and the smallest vertex ``root`` of its component, for every vertex with an edge.

    ``edges`` has ``u`` and ``v``.  Every round links all neighbours of a vertex to the smallest
    of them, first the larger ones and then the smaller ones, until each component is a
    star.  A vertex of many neighbours is one row of minima in a join, whose other side
    adaptive execution may split.
    """
    now = checkpointed(edges.filter("u <> v").select(
        F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _state(now)
    while state[0]:
        both = now.select("u", "v").union(now.select("v", "u"))
        smallest = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.join(smallest, "u").filter("v > u").select(
            F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = checkpointed(small.union(least.select("u", "m")).distinct())
        before, state = state, _state(now)
        if state == before:
            break
    return now.select("u", F.col("v").alias("root")).union(
        now.select(F.col("v").alias("u"), F.col("v").alias("root")).distinct()
    )
