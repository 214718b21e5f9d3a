"""Connected components of links, by alternating large-star and small-star steps."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wxodds.llm.storage import remove, written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large: every larger neighbour of u is linked to u's least neighbour (or u).  Small: so are u
    and its smaller neighbours."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    seen = both if large else both.where("v < u")
    least = seen.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    if large:
        linked = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        linked = seen.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(
            least.select("u", F.col("m").alias("v")))
    return linked.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, component) for each node in `links` (columns x, y); the component is its least node.
    Nulls and links of a node to itself are left out.  Every step is written, so lost executors cost
    one step; the number of steps grows with the logarithm of the longest path."""
    edges = written(links.where("x <> y").select(F.greatest("x", "y").alias("u"), F.least("x", "y").alias("v")).distinct(), "edges")
    state = None
    while True:
        stepped = written(_star(_star(edges, large=True), large=False), "edges")
        remove(edges)
        edges = stepped
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == now:
            break
        state = now
    stars = edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return stars.unionAll(stars.select(F.col("component").alias("node"), "component").distinct())
