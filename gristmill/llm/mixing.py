"""Mixing sources to target weights by systematic sampling.

Each document's expected copies are its source's target over its source's size. Within a source,
documents are laid end to end in order of size, each as wide as its expected copies; one random
offset per source puts marks one apart on that line, and a document is emitted once for each mark
that it covers. Neighbours on the line have like sizes, so the words taken come within about one
document's length of the target.

Nothing is gathered: the line's positions are rank times width, and ranks come from counts of
(source, size) cells, of 256 hashed buckets within a cell, and of rows within a bucket, so that a
source or a group of copies with a third of all rows is still dealt over many tasks.

Defined cases: null text has size 0; a null source is a source of its own, last in order; null
ids are allowed; repeated rows are separate documents; sources of size 0 take nothing; an empty
table gives an empty result; extra columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.llm.text import quoted
from gristmill.sources.stores import saved

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
CAP = 3
SEED = "mix-1"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size, target) from (source, size, n): n documents of a size.

    Water filling: target = min(cap * size, weight * level), the level being such that targets
    add up to all sizes. A few rounds find it, each one aggregate over the sources.
    """
    per = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    order = [F.col("source").isNull(), F.col("source")]
    ranged = saved(per.repartitionByRange(8, *order).withColumn("part", F.spark_partition_id()))
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row per partition
    starts = ranged.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    place = F.col("start") + F.row_number().over(W.partitionBy("part").orderBy(*order)) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(place, F.lit(len(weights))) + 1).cast("int"))
    weighed = saved(ranged.join(F.broadcast(starts), "part").select("source", "source_size", weight.cast("long").alias("weight")))
    limit = F.col("source_size") * cap
    capped = (0, 0)
    while True:  # the level only rises, so the capped sources only grow in number
        free = limit >= F.col("weight") * F.lit(capped[1])
        total, full, rest = weighed.agg(F.sum("source_size"), F.sum(F.when(~free, limit)), F.sum(F.when(free, F.col("weight")))).first()
        level = (total - (full or 0)) / rest if rest else 0.0
        if level == capped[1]:
            break
        capped = (full, level)
    target = F.least(limit.cast("double"), F.col("weight") * F.lit(float(level)))
    return weighed.select("source", "source_size", target.alias("target"))


def copies(docs: DataFrame, keep: list[str], seed: str = SEED, weights: tuple = WEIGHTS, cap: int = CAP) -> DataFrame:
    """Columns ``keep`` of ``docs`` as _k0, _k1, ... with _size, source_size, target, copies."""
    own = [f"_k{i}" for i in range(len(keep))]
    key = F.coalesce(F.col("doc_id").cast("string"), "text", F.lit(""))
    narrow = docs.select(
        *(F.col(quoted(k)).alias(n) for k, n in zip(keep, own, strict=True)), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_tie"), F.col("source").alias("_source"), n_words(F.col("text")).alias("_size"), F.substring(F.md5(key), 1, 2).alias("_bucket")
    )
    if keep == ["doc_id"]:
        narrow = saved(narrow)
    buckets = saved(narrow.groupBy("_source", "_size", "_bucket").agg(F.count("*").alias("n")))
    targets = source_targets(buckets.select(F.col("_source").alias("source"), F.col("_size").alias("size"), "n"), weights, cap)
    cells = buckets.groupBy("_source", "_size").agg(F.sum("n").alias("n"))
    upto = lambda *by: F.coalesce(F.sum("n").over(W.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    outer = cells.select(F.col("_source").alias("_s"), F.col("_size").alias("_z"), upto("_source", "_size").alias("outer"))
    outer = outer.join(targets, F.col("_s").eqNullSafe(F.col("source"))).drop("source")
    inner = buckets.select("*", upto("_source", "_size", "_bucket").alias("inner"))
    before = inner.join(outer, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_size") == F.col("_z")))
    before = before.select(F.col("_source").alias("_s"), F.col("_size").alias("_z"), F.col("_bucket").alias("_b"), (F.col("outer") + F.col("inner")).alias("_before"), "source_size", "target")
    within = F.row_number().over(W.partitionBy("_source", "_size", "_bucket").orderBy("_id", "_tie"))
    ranked = narrow.withColumn("_rank", within).join(before, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_size") == F.col("_z")) & (F.col("_bucket") == F.col("_b")))
    rank = F.col("_before") + F.col("_rank")
    width = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(seed + "|"), F.coalesce("_source", F.lit("")))), 1, 5), 16, 10).cast("double") / F.lit(1048576.0)
    made = (F.floor(offset + width * rank) - F.floor(offset + width * (rank - 1))).cast("long")
    return ranked.select(*own, "_size", "source_size", "target", made.alias("copies"))


def mixed(docs: DataFrame, seed: str = SEED, weights: tuple = WEIGHTS, cap: int = CAP) -> DataFrame:
    """The mix itself: each document once for each copy, with the columns of ``docs``.

    Rows of one id and size are told apart by their text, and repeated rows are the same whichever is
    taken, so reruns agree. Documents without a word have size 0 and width like others of their source.
    """
    names = docs.columns
    made = copies(docs, names, seed, weights, cap).where("copies > 0")
    every = made.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return every.select(*(F.col(f"_k{i}").alias(n) for i, n in enumerate(names)))


def taken(docs: DataFrame) -> DataFrame:
    made = copies(docs, ["doc_id"])
    return made.select(F.col("_k0").alias("doc_id"), F.col("_size").alias("size"), "source_size", "target", (F.col("_size") * F.col("copies")).alias("taken"))


TAKEN_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         substr(md5(coalesce(doc_id::VARCHAR, text, '')), 1, 2) AS bucket
  FROM documents),
s0 AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
s1 AS (SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM s0),
s2 AS (SELECT *, sum(source_size) OVER () AS total,
         coalesce(sum(3 * source_size) OVER o, 0) AS full_before,
         sum(weight) OVER () - coalesce(sum(weight) OVER o, 0) AS rest, row_number() OVER o AS place
       FROM s1 WINDOW o AS (ORDER BY 3.0::DOUBLE * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lvl AS (SELECT arg_min((total - full_before)::DOUBLE / rest::DOUBLE, place) AS level FROM s2
        WHERE (total - full_before)::DOUBLE / rest::DOUBLE * weight <= 3 * source_size),
s AS (SELECT source, source_size, least((3 * source_size)::DOUBLE, weight::DOUBLE * level) AS target,
        ('0x' || substr(md5('mix-1|' || coalesce(source, '')), 1, 5))::BIGINT::DOUBLE / 1048576.0::DOUBLE AS u
      FROM s1, lvl),
r AS (SELECT d.doc_id, d.size, s.source_size, s.target, s.u,
        CASE WHEN s.source_size > 0 THEN s.target / s.source_size::DOUBLE ELSE 0.0::DOUBLE END AS width,
        row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.bucket, d.doc_id) AS rk
      FROM d JOIN s ON d.source IS NOT DISTINCT FROM s.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(u + width * rk) - floor(u + width * (rk - 1))))::BIGINT AS taken
FROM r
"""
