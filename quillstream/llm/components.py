"""Connected components of a link table by alternating large and small
stars.  Every step is a grouped minimum (partially aggregated, so a hub is
no hot group) and a join back; links and labels never leave the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillstream.llm.scratch import cut


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.join(low, "u").where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """``edges`` point from the larger (u) to the smaller (v) end."""
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(low.select("u", F.col("m").alias("v")))


def connected_components(links: DataFrame) -> DataFrame:
    """(u, v) links -> (id, component): each linked id with the smallest id
    that it reaches.  Self links and nulls are ignored; no links, no rows."""
    edges = cut(
        links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links"
    )
    state = None
    while True:
        new = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if new == state or new["n"] == 0:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).union(
                edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
            )
        state = new
        edges = cut(_small_star(_large_star(edges).distinct()).distinct(), "stars")
