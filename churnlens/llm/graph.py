"""Connected components by alternating large-star and small-star, on edge tables of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnlens.llm.textops import forget, saved


def _minimum(edges: DataFrame) -> DataFrame:
    """(u, m): the smallest of u and its neighbours v, stored, so that joins with it can be split at hot nodes."""
    return saved(edges.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "minima")


def large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is linked to the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    found = _minimum(both)
    out = saved(both.filter("v > u").join(found, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct(), "edges")
    forget(found)
    return out


def small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are all linked to the smallest of them."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    found = _minimum(down)
    linked = down.join(found, "u")
    out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(linked.select("u", F.col("m").alias("v")))
    out = saved(out.filter("u <> v").distinct(), "edges")
    forget(found)
    return out


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) of every node of ``edges`` (u, v, any order, repeats allowed): component is the smallest node.

    Nodes without an edge do not appear.  Each round is stored in the shared folder; rounds end when large-star and
    small-star change nothing.  Raises if that takes more than ``most_rounds`` rounds (their number grows with the
    logarithm of the size).
    """
    now = saved(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    mark = _mark(now)
    for _ in range(most_rounds):
        wide = large_star(now)
        then, now = now, small_star(wide)
        forget(then, wide)
        new = _mark(now)
        if new == mark:
            roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
        mark = new
    raise RuntimeError("the components did not settle")


def _mark(edges: DataFrame) -> tuple:
    """A count and two order-free sums of the edge set: equal for equal sets."""
    h = F.xxhash64("u", "v")
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.shiftright(h, 20)), F.bit_xor(h)).first())
