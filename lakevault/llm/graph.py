"""Connected components of an edge table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakevault.llm.common import staged


def _large_star(e: DataFrame) -> DataFrame:
    """Each node's greater neighbours point to its smallest neighbour (or itself)."""
    both = e.select("u", "v").union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # a table of its own: no aggregate lies between the join and its exchanges, so AQE can split a hot node
    least = staged(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
    return both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(e: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours point to the smallest of them."""
    down = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = staged(down.groupBy("u").agg(F.min("v").alias("m")), "least")
    moved = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v")))


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable from each node that has an edge.

    ``edges`` has two long columns.  Each round is written to the shared
    folder; nothing but a row count and a checksum reaches the driver.
    """
    a, b = edges.columns
    e = staged(edges.select(F.col(a).alias("u"), F.col(b).alias("v")).filter("u <> v").distinct(), "edges")
    mark = None
    while True:
        e = staged(_small_star(_large_star(e)).filter("u <> v").distinct(), "stars")
        now = e.agg(F.count(F.lit(1)), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0))).first()
        if now == mark:
            break
        mark = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct())
