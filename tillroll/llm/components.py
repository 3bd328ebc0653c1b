"""Connected components of a graph given as edges, by alternating large-star and small-star steps.

Each step is a minimum per node (pre-aggregated before the shuffle) and a join
that sends it along the edges, so a node with many neighbours is never gathered
in one place.  Every round is written to the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import drop_written, materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step on edges (u, v), v < u, written and deleted here: hangs the neighbours of each node on the smallest of
    them and itself."""
    both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), "component_minima")
    moved = both.join(least, "u")
    if large:
        new = moved.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        new = moved.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    hung = materialize(new.where("u <> v").distinct(), "component_edges")
    drop_written(least), drop_written(edges)
    return hung


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node``, ``root`` (smallest node reachable) of each node that has an edge.  Self-edges and nulls are ignored."""
    now = materialize(edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "component_edges")
    state = None
    while True:
        now = _star(_star(now, large=True), large=False)
        new = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
        if new == state:
            break
        state = new
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    found = materialize(stars.unionByName(stars.select(F.col("root").alias("node"), "root")).distinct(), "components")
    drop_written(now)
    return found
