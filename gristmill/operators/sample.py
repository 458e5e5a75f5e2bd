"""Quotas, cluster budgets and pools."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.sources.stores import saved


def position(seed: int | str, key: Column | str) -> Column:
    """A reproducible shuffle: the order of md5(seed || key)."""
    return F.md5(F.concat(F.lit(str(seed)), F.col(key).cast("string") if isinstance(key, str) else key))


def quotas(sizes: DataFrame, total: int, overrides: dict[str, int] | None = None) -> DataFrame:
    """(bucket, quota) from (bucket, size, first_seq): overrides first, the rest by largest remainders.

    The table has one row per bucket, so its windows are small.
    """
    fixed = F.create_map(*(F.lit(x) for kv in (overrides or {"": 0}).items() for x in kv)).cast("map<string,bigint>")[F.col("bucket")] if overrides else F.lit(None).cast("long")
    everything = W.partitionBy()
    s = sizes.withColumn("fixed", F.when(fixed.isNotNull(), F.least(fixed, F.col("size"))))  # least alone skips nulls
    s = s.withColumn("left", F.greatest(F.lit(total) - F.coalesce(F.sum("fixed").over(everything), F.lit(0)), F.lit(0)))
    s = s.withColumn("free", F.sum(F.when(F.col("fixed").isNull(), F.col("size"))).over(everything))
    s = s.withColumn("raw", F.when(F.col("fixed").isNull() & (F.col("free") > 0), F.col("left") * F.col("size") / F.col("free")).otherwise(0.0))
    s = s.withColumn("floor", F.floor("raw"))
    s = s.withColumn("rank", F.row_number().over(everything.orderBy(F.col("fixed").isNotNull(), F.desc(F.round(F.col("raw") - F.col("floor"), 9)), "first_seq")))
    spare = F.col("left") - F.sum("floor").over(everything)
    s = s.withColumn("spare", spare)
    more = F.when((F.col("rank") <= F.col("spare")) & (F.col("free") > 0), 1).otherwise(0)
    return s.select("bucket", F.coalesce("fixed", F.col("floor") + more).cast("long").alias("quota"))


def budgets(clusters: DataFrame, strict: bool = False) -> DataFrame:
    """(bucket, cluster, size, budget) from (bucket, cluster, size, first_seq, quota).

    More clusters than quota: the largest get one each. Otherwise shares by the root of the size,
    at least one; a shortage goes to the largest fractions; a surplus is taken in one pass, one
    from each share over one (strict: until the sum is right).
    """
    w = W.partitionBy("bucket")
    c = clusters.withColumns({"n": F.count("*").over(w), "root": F.sqrt("size")})
    c = c.withColumns({"by_size": F.row_number().over(w.orderBy(F.desc("size"), "first_seq")), "raw": F.col("quota") * F.col("root") / F.sum("root").over(w)})
    c = c.withColumn("f", F.greatest(F.floor("raw"), F.lit(1)))
    c = c.withColumns({"diff": F.col("quota") - F.sum("f").over(w), "by_part": F.row_number().over(w.orderBy(F.desc(F.round(F.col("raw") - F.col("f"), 9)), "first_seq"))})
    rank = F.row_number().over(w.orderBy(F.desc("f"), "first_seq"))
    c = c.withColumn("by_share", rank)
    if strict:  # the surplus in whole rounds: what is over a level goes, and the last level in part
        cut = F.expr("aggregate(sequence(1, greatest(1, cast(fmax as int))), named_struct('d', -diff, 'l', fmax), (a, x) -> CASE WHEN a.d <= 0 THEN a ELSE named_struct('d', a.d - size(filter(fs, y -> y >= a.l AND a.l > 1)), 'l', a.l - 1) END)")
        c = c.withColumns({"fs": F.collect_list("f").over(w), "fmax": F.max("f").over(w)}).withColumn("cut", cut)
        level, over = F.col("cut.l"), -F.col("cut.d")
        lowered = F.least(F.col("f"), level)
        back = F.when((F.col("f") > level) & (F.row_number().over(w.orderBy((F.col("f") <= level).cast("int"), "first_seq")) <= over), 1).otherwise(0)
        less = lowered + back
    else:
        less = F.col("f") - F.when((F.col("f") > 1) & (F.col("by_share") <= -F.col("diff")), 1).otherwise(0)
    share = F.when(F.col("diff") > 0, F.col("f") + F.when(F.col("by_part") <= F.col("diff"), 1).otherwise(0)).when(F.col("diff") < 0, less).otherwise(F.col("f"))
    budget = F.when(F.col("quota") <= 0, 0).when(F.col("n") >= F.col("quota"), F.when(F.col("by_size") <= F.col("quota"), 1).otherwise(0)).otherwise(share)
    return c.select("bucket", "cluster", "size", budget.cast("long").alias("budget"))


def pool(df: DataFrame, budget: DataFrame) -> DataFrame:
    """The ``budget`` nearest rows of each cluster, ties by seq: df has bucket, cluster, dist, seq."""
    most = budget.agg(F.max("budget")).first()[0] or 0
    rn = F.row_number().over(W.partitionBy("bucket", "cluster").orderBy("dist", "seq"))
    ranked = df.withColumn("rn", rn).where(F.col("rn") <= most)  # a literal bound lets the window stop early
    return ranked.join(budget.select("bucket", "cluster", "budget"), ["bucket", "cluster"]).where("rn <= budget").drop("rn", "budget")


def high_priority(rows: DataFrame, n: int, seed: int | str, key: str) -> DataFrame:
    """n rows round-robin over clusters, nearest first, clusters in order of first appearance.

    Running counts of the rounds give the last one that is needed; only that one is sorted.
    """
    order = position(seed, key)
    by = W.partitionBy("bucket", "cluster")
    ranked = rows.withColumn("pos", order).withColumns({"rn": F.row_number().over(by.orderBy("dist", "pos")), "cluster_pos": F.min("pos").over(by)})
    r = saved(ranked.where(F.col("rn") <= n))
    rounds = r.groupBy("rn").agg(F.count("*").alias("c")).withColumn("have", F.sum("c").over(W.orderBy("rn")))  # at most n rows
    whole, have = rounds.where(F.col("have") <= n).agg(F.coalesce(F.max("rn"), F.lit(0)), F.coalesce(F.max("have"), F.lit(0))).first()
    last = r.where(F.col("rn") == whole + 1).orderBy("cluster_pos").limit(n - have)
    return r.where(F.col("rn") <= whole).unionByName(last).drop("pos", "rn", "cluster_pos")


def remainder(rows: DataFrame, taken: DataFrame, key: str) -> DataFrame:
    return rows.join(taken.select(key), key, "left_anti")


def hashed_sample(df: DataFrame, n: int, key: str, seed: int | str = 42) -> DataFrame:
    """A reproducible sample of n rows, in order of the key."""
    return df.orderBy(position(seed, key), key).limit(n).orderBy(key)


def first_n(df: DataFrame, n: int, key: str) -> DataFrame:
    return df.orderBy(key).limit(n)
