"""Connected components of an edge table, without collecting any of it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.sources.stores import discard, saved


def _nearest(edges: DataFrame) -> DataFrame:
    """m(u) = the smallest of u and its neighbours; partial sums first, so a hub costs no more."""
    return edges.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("m"))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, left: str = "src", right: str = "dst") -> DataFrame:
    """(node, component) for each node of an edge; component is the smallest node reachable.

    Alternates the large-star and small-star steps (Kiveris et al. 2014), which need O(log n)
    rounds on paths and two on stars. Each round is one aggregate and one join per step; a hub's
    edges meet in a join whose other side has one row per node, which adaptive execution can
    split. Loops and repeated edges are fine; null ends are ignored; no edges give no rows.
    """
    e = edges.select(F.col(left).alias("u"), F.col(right).alias("v")).where("u is not null and v is not null and u <> v")
    e = saved(e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = _state(e)
    if not before[0]:
        return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    while True:  # each round that changes the edges lowers their ends, so it settles
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # large star: a node's larger neighbours move to its smallest neighbour
        big = both.join(_nearest(both), "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # small star: a node and its smaller neighbours move to the smallest of them
        low = _nearest(big)
        small = big.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
        made = saved(small.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
        discard(e)
        e = made
        now = _state(e)
        if now == before:
            break
        before = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(e.select("v", "v").distinct())
