"""Connected components of a link table, with joins and map-side minimums only.

Alternates two edge rewrites until nothing changes: every larger neighbour of
a node is tied to the smallest node around it, then every node and its smaller
neighbours are. Path lengths shrink geometrically. A node with a third of all
links only ever meets them through partial aggregates and skew-splittable
joins, and each round is checkpointed to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from closecast.llm.common import checkpointed


ROWS_PER_TASK = 250_000


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return r[0], r[1]


def components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (columns a, b; nulls dropped): component is the smallest node reached.

    Tasks between shuffles follow the number of links left, so a small graph does not fan out.
    """
    a, b = F.col("a"), F.col("b")
    edges = (links.where(a.isNotNull() & b.isNotNull() & (a != b))
             .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    edges = checkpointed(edges)
    state = _state(edges)
    while True:
        tasks = 1 + state[0] // ROWS_PER_TASK
        if state[0] == 0:
            break
        # around every node u: v is tied to the smallest of u and its neighbours
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))).coalesce(tasks)
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).coalesce(tasks)
        large = (both.where(F.col("v") > F.col("u")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u > v").coalesce(tasks).distinct().coalesce(tasks))
        # below every node u: u and its smaller neighbours are tied to the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m")).coalesce(tasks)
        edges = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .union(least.select("u", F.col("m").alias("v"))).where("u > v").coalesce(tasks).distinct().coalesce(tasks))
        edges = checkpointed(edges)
        before, state = state, _state(edges)
        if state == before:
            break
    nodes = edges.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component")
    return checkpointed(nodes.union(edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()).coalesce(tasks))
