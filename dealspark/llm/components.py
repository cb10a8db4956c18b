"""Connected components of a large link table by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealspark.llm import kernels as K
from dealspark.session import durable

#: Nodes with very many links at most: their least neighbours are broadcast, so that no task gets all links of one.
HUBS = 10_000


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of the links; component is the smallest node reachable.

    Each round points every node's larger neighbours at its smallest one (large star), then its smaller
    neighbours and itself (small star), until every link leads to a root. Both steps aggregate minima by
    node before any join; no neighbourhood is ever gathered. A node is a hub if more than 2 n / ``HUBS`` of the n links
    (and more than 64) meet there, so there are fewer than ``HUBS`` of them. Null ends and loops are ignored.
    """
    links = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    links = durable(links)
    while True:
        seen = _described(links)
        if not seen["open"]:
            break
        many = max(64, 2 * seen["n"] // HUBS)
        hubs = seen["most"] > many
        both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("u", "m"))
        large = _with_least(both.where("v > u"), least, many, hubs).select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = _with_least(large, down, many, hubs).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        links = durable(small.union(down.select("u", F.col("m").alias("v"))).distinct())
        del both, least, large, down, small
        K.release(edges.sparkSession)
    members = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return members.union(roots.distinct())


def _with_least(links: DataFrame, least: DataFrame, many: int, hubs: bool) -> DataFrame:
    """Links with the least neighbour m of their end u; those of hubs are joined by broadcast."""
    if not hubs:
        return links.join(least.select("u", "m"), "u")
    hub = F.broadcast(least.where(F.col("n") > many).select("u", "m"))  # fewer than HUBS rows
    others = links.join(hub.select("u"), "u", "left_anti").join(least.where(F.col("n") <= many).select("u", "m"), "u")
    return links.join(hub, "u").unionByName(others)


def _described(links: DataFrame) -> dict:
    """How many nodes are neither a root nor led to one by a single link (open), the links (n), and the most links of one node."""
    ends = links.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(links.select("v", F.lit(0), F.lit(1)))
    nodes = ends.groupBy("x").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    unsettled = F.count_if((F.col("up") > 1) | (F.col("up") == 1) & (F.col("down") > 0))
    row = nodes.agg(unsettled.alias("open"), F.coalesce(F.sum("up"), F.lit(0)).alias("n"), F.coalesce(F.max(F.col("up") + F.col("down")), F.lit(0)).alias("most")).first()
    return row.asDict()
