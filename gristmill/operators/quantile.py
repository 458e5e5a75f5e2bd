"""Exact order statistics of groups by refinement.

No buffer grows with a group. A pass counts the values of each group over RANGES equal ranges between the smallest and the
largest value that are left; the range that holds the wanted place goes on, between its own smallest and largest value.
It ends when a range has one value, or at most FINISH rows, which are sorted. The first pass reads all rows, and each
pass after it what the one before left, about a RANGES-th.

Defined cases: null and NaN values don't count; a group without any other value has no row; null keys are a group; ties and
infinite values are fine; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.sources.stores import discard, saved

RANGES, FINISH = 1000, 10_000


def _met(rows: DataFrame, targets: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with their group's targets, null keys together."""
    own = targets.select(*(F.col(c).alias(f"_g{i}") for i, c in enumerate(keys)), *(c for c in targets.columns if c not in keys))
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(keys)), F.lit(True))
    return rows.join(own, same).drop(*(f"_g{i}" for i in range(len(keys))))


def _range(v: Column, low: Column, high: Column) -> Column:
    """The number of a value's range; it never falls as values grow, and low and high have the first and the last."""
    return F.when(v <= low, 0).when(v >= high, RANGES - 1).otherwise(F.least(F.floor((v / 2 - low / 2) / (high / 2 - low / 2) * RANGES), F.lit(RANGES - 1))).cast("int")


def order_statistics(df: DataFrame, by: list[str], value: str, places: Column) -> DataFrame:
    """(by..., place, value): the values at some places (from 0, an array of a group's ``_n``) of each group in order."""
    v = F.col(value).cast("double")
    rows = saved(df.where(v.isNotNull() & ~F.isnan(v)).select(*by, (v + F.lit(0.0)).alias("_v")))
    groups = rows.groupBy(*by).agg(F.count("*").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    targets = saved(groups.select(*by, "_low", "_high", F.col("_n").alias("_left"), F.explode(F.array_distinct(places)).alias("_place")).withColumn("_rank", F.col("_place")))
    keys, found = by, None
    while True:
        one = F.col("_low") == F.col("_high")
        known = targets.where(one).select(*by, "_place", F.col("_low").alias("_v"))
        few = _met(rows, targets.where(~one & (F.col("_left") <= FINISH)).select(*keys, *({"_place", "_rank"} - set(keys))), keys)
        at = F.row_number().over(W.partitionBy(*by, "_place").orderBy("_v")) - 1
        last = few.withColumn("_at", at).where(F.col("_at") == F.col("_rank")).select(*by, "_place", "_v")
        found = known.unionByName(last) if found is None else found.unionByName(known).unionByName(last)
        open_ones = targets.where(~one & (F.col("_left") > FINISH))
        if not open_ones.limit(1).count():
            return found.select(*by, F.col("_place").alias("place"), F.col("_v").alias("value"))
        met = saved(_met(rows, open_ones, keys).select(*by, "_place", "_rank", "_v", _range(F.col("_v"), F.col("_low"), F.col("_high")).alias("_part")))
        counts = met.groupBy(*by, "_place", "_rank", "_part").agg(F.count("*").alias("_left"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        upto = counts.withColumn("_end", F.sum("_left").over(W.partitionBy(*by, "_place").orderBy("_part")))  # RANGES rows
        begin = F.col("_end") - F.col("_left")
        next_ones = upto.where((begin <= F.col("_rank")) & (F.col("_rank") < F.col("_end")))
        targets = saved(next_ones.select(*by, "_place", "_part", "_low", "_high", "_left", (F.col("_rank") - begin).alias("_rank")))
        found = saved(found)
        keys = [*by, "_place"]
        rows = saved(_met(met.drop("_rank"), targets.select(*keys, F.col("_part").alias("_own")), keys).where(F.col("_part") == F.col("_own")).select(*keys, "_v"))
        discard(met)


def percentiles(df: DataFrame, by: list[str], value: str, fraction: float, name: str = "percentile") -> DataFrame:
    """(by..., name): the exact percentile of each group, interpolated between the two values around its place."""
    n = saved(df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double"))).groupBy(*by).agg(F.count("*").alias("_n")))
    at = (F.col("_n") - 1) * F.lit(float(fraction))
    found = order_statistics(df, by, value, F.array(F.floor(at), F.ceil(at)))
    ends = found.groupBy(*by).agg(F.min("place").alias("_low"), F.min("value").alias("_a"), F.max("value").alias("_b"))
    met = _met(n.withColumn("_at", at), ends, by)
    part = F.col("_at") - F.col("_low")
    return met.select(*by, F.when(F.col("_a") == F.col("_b"), F.col("_a")).otherwise((1 - part) * F.col("_a") + part * F.col("_b")).alias(name))
