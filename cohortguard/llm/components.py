"""Connected components of an edge table, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach_group, discard, written


def _star(arcs: DataFrame, pick) -> DataFrame:
    """Link each arc's far end to the smallest node around ``u``."""
    least = (arcs.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
             .select("u", F.least("u", "m").alias("m"), "n"))
    return pick(attach_group(arcs, least, "u", "n"))


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Component of every node that occurs in an edge.

    Alternates the large-star and small-star steps: each round links every
    node's larger neighbours, then its smaller ones, to the smallest node
    seen, until the edges are stars around component minima.  A round groups
    by node with partial aggregation and writes its edges to the shared
    folder; nothing but a row count and a checksum reaches the driver.

    Returns ``(node, component)``, ``component`` being the smallest node that
    can be reached.  Self-loops give a component of one; null ends are ignored.
    """
    spark = edges.sparkSession
    cur = written(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                  .where(F.col(a).isNotNull() & F.col(b).isNotNull()).distinct(), "edges")
    loops = cur.where("u = v").select(F.col("u").alias("node"), F.col("u").alias("component"))
    first, state = cur, None
    while True:
        arcs = cur.where("u <> v")
        both = arcs.unionByName(arcs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, lambda r: r.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        large = large.where("u <> v").distinct()
        small = _star(large, lambda r: r.select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*"))
        nxt = written(small.where("u <> v").distinct(), "edges")
        row = nxt.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
        if cur is not first:
            discard(cur)
        cur = nxt
        if (row.n, row.x) == state or row.n == 0:
            break
        state = (row.n, row.x)
    stars = cur.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    nodes = stars.unionByName(roots)
    return nodes.unionByName(loops.join(nodes, "node", "left_anti"))
