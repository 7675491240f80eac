"""Connected components of an edge table, in Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` -> ``(node, component)``: the smallest node that each node of an edge reaches.

    Each round every node is tied to the least node it knows of, first among its larger neighbours and then
    among its smaller ones, until nothing changes; the number of rounds grows with the logarithm of the
    longest path.  Neighbour lists are never gathered: a round is a minimum per node and a join that adaptive
    execution can split, so a node that touches a third of all others stays cheap.  Null ends and loops are
    dropped; no edges give no rows.
    """
    now = written(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "edges"
    )
    mark = _mark(now)
    while True:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        )
        large = large.union(least.where("m < u").select("u", F.col("m").alias("v"))).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        after = written(small.union(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        new = _mark(after)
        now = after
        if new == mark:
            break
        mark = new
    found = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return found.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def roots(parents: DataFrame) -> DataFrame:
    """``parents(a, b)`` with one smaller ``b`` for each ``a`` -> ``(node, root)`` for every ``a``, by pointer jumping.

    Each round follows every pointer four times as far, so the rounds grow with the logarithm of the depth.
    """
    now = written(parents.select(F.col("a").alias("node"), F.col("b").alias("root")), "roots")
    while True:
        to = now.select(F.col("node").alias("root"), F.col("root").alias("next"))
        once = now.join(to, "root", "left").select("node", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        twice = once.join(to, "root", "left").select("node", F.coalesce("next", "root").alias("root"), (F.col("moved") & F.col("next").isNotNull()).alias("moved"))
        after = written(twice, "roots")
        now = after.select("node", "root")
        if after.where("moved").isEmpty():
            return now


def _mark(edges: DataFrame) -> tuple:
    """A digest of an edge set: equal only if nothing changed."""
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("v", "u"))
    ).first()
    return tuple(row)
