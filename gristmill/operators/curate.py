"""Cleaning, exact dedup with priorities, and the complexity filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.functions.text import MIN_LENGTH, clean_text
from gristmill.operators.quantile import percentiles
from gristmill.sources.stores import saved, spread


def cleaned(df: DataFrame, text: str = "text") -> DataFrame:
    """Text in NFC, stripped; ``reject`` is null, empty or too_short."""
    out = spread(df).withColumn(text, clean_text(F.coalesce(F.col(text), F.lit(""))))
    reject = F.when(F.col(text) == "", "empty").when(F.length(text) < MIN_LENGTH, "too_short")
    return out.withColumn("reject", reject)


def clean(df: DataFrame, text: str = "text") -> DataFrame:
    return cleaned(df, text).where("reject is null").drop("reject")


def clean_stats(df: DataFrame, text: str = "text") -> DataFrame:
    count = lambda c, name: F.count_if(c).alias(name)
    reject = F.col("reject")
    return cleaned(df, text).agg(F.count("*").alias("total"), count(reject.isNull(), "kept"), count(F.coalesce(reject == "empty", F.lit(False)), "dropped_empty"), count(F.coalesce(reject == "too_short", F.lit(False)), "dropped_short"))


def exact_dedup(df: DataFrame, text: str, priority: Column, seq: str) -> DataFrame:
    """One row of each text: the one of the best (lowest) priority, at the place of the first.

    Columns of ``df`` with ``position``, ``copies`` and ``replaced``; ``seq`` is unique. Rows are written once with
    the hash of their text; groups are made of hash, priority and order alone, with partial sums, so no
    text is sorted or compared and one that many rows share is no hot spot. The winners are then joined
    back by their order.
    """
    best = F.struct(F.col("_priority").alias("priority"), F.col(seq).alias("seq"))
    rows = saved(df.withColumns({"_text": F.unhex(F.sha2(F.col(text), 256)), "_priority": priority}))
    groups = rows.groupBy("_text").agg(F.min(best).alias("_best"), F.min(seq).alias("position"), F.count("*").alias("copies"))
    groups = groups.select(F.col("_best.seq").alias("_seq"), "position", "copies")
    out = rows.join(groups, F.col(seq) == F.col("_seq"))
    return out.select(*df.columns, "position", "copies", (F.col(seq) != F.col("position")).alias("replaced"))


def exact_dedup_stats(df: DataFrame, text: str, priority: Column, seq: str) -> DataFrame:
    out = exact_dedup(df, text, priority, seq)
    return out.agg(F.count("*").alias("kept"), F.sum(F.col("copies") - 1).alias("removed"), F.count_if(F.col("replaced")).alias("replaced"))


def cutoffs(df: DataFrame, group: str, length: str, bottom: float, groups: list[str]) -> DataFrame:
    """(group, cutoff): the exact interpolated percentile of the groups that are filtered, cut to an integer."""
    picked = df.where(F.col(group).isin(groups)).select(group, length)
    return percentiles(picked, [group], length, bottom, "cutoff").withColumn("cutoff", F.col("cutoff").cast("long"))


def complexity_filter(df: DataFrame, group: str, length: str, bottom: float, groups: list[str]) -> DataFrame:
    """Drop rows at or under their group's cutoff; other groups pass."""
    known = cutoffs(df, group, length, bottom, groups)  # one row for each of ``groups``
    return df.join(F.broadcast(known), group, "left").where(F.col("cutoff").isNull() | (F.col(length) > F.col("cutoff"))).drop("cutoff")
