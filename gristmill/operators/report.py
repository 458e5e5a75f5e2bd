"""Profiles, funnels, metrics and histograms."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.operators.quantile import percentiles
from gristmill.sources.stores import saved


def profile(records: DataFrame) -> DataFrame:
    """One row: counts and the sorted distinct roles, item types, formats and prompts of chat records."""
    turns = records.select("meta_prompt", F.explode_outer("data").alias("t")).select("meta_prompt", "t.role", F.explode_outer("t.content").alias("c"))
    return turns.agg(
        F.sort_array(F.collect_set("role")).alias("roles"), F.sort_array(F.collect_set("c.type")).alias("types"),
        F.sort_array(F.collect_set(F.coalesce("c.image.format", "c.text.format"))).alias("formats"), F.bool_or(F.col("c.type") == "image").alias("has_images"),
        F.sort_array(F.collect_set(F.array_join("meta_prompt", "|"))).alias("prompts"),
    )


SETS = ("roles", "types", "formats", "prompts")


def _partial(n: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's counts and distinct values in one row, and its ``n`` lines of the smallest places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = rejects = 0
        sets: dict[str, set] = {c: set() for c in SETS}
        best = pa.table({"place": pa.array([], pa.string()), "line": pa.array([], pa.string())})
        for batch in batches:
            bad = batch["bad"]
            rows += batch.num_rows
            rejects += pc.sum(bad.cast(pa.int64())).as_py() or 0
            for c in SETS:
                sets[c].update(v for v in pc.unique(batch[c].flatten()).to_pylist() if v)
            good = pa.table({c: batch[c] for c in ("place", "line")}).filter(pc.invert(bad))
            best = pa.concat_tables([best, good.cast(best.schema)]).sort_by([("place", "ascending"), ("line", "ascending")]).slice(0, n)
        whole = {"rows": [rows], "rejects": [rejects], **{c: [sorted(sets[c])] for c in SETS}, "place": [None], "line": [None]}
        picked = {"rows": [None] * len(best), "rejects": [None] * len(best), **{c: [None] * len(best) for c in SETS}, "place": best["place"].to_pylist(), "line": best["line"].to_pylist()}
        kind = pa.schema([("rows", pa.int64()), ("rejects", pa.int64()), *((c, pa.list_(pa.string())) for c in SETS), ("place", pa.string()), ("line", pa.string())])
        for part in (whole, picked):
            yield pa.RecordBatch.from_pydict(part, kind)

    return run


def viewed(lines: DataFrame, n: int, seed: int | str = 42, line: str = "value", key: str = "$.id") -> tuple[DataFrame, DataFrame]:
    """What a viewer shows of JSON lines of chat records, from one scan of them.

    First one row: rows and rejects (lines that can't be read), the distinct roles, item types, image formats and prompts in order (a prompt's parts
    joined by |), has_image and has_video. Then a sample: (place, line) of the n lines of the smallest md5(seed || key), in that order.
    Blank and null lines don't count. Records of any shape can be read: what isn't there has no values. Each task keeps n lines at most.
    """
    v = F.try_parse_json(line)
    own = lines.where(F.length(F.trim(line)) > 0).select(F.col(line).alias("line"), v.alias("v"))
    every = lambda of, path: F.transform(of, lambda x: F.try_variant_get(x, path, "string"))
    turns = F.coalesce(F.try_variant_get("v", "$.data", "array<variant>"), F.array().cast("array<variant>"))
    own = own.select("line", "v", turns.alias("turns"))
    items = F.flatten(F.transform("turns", lambda t: F.coalesce(F.try_variant_get(t, "$.content", "array<variant>"), F.array().cast("array<variant>"))))
    own = own.select("line", "v", "turns", items.alias("items"))
    place = F.md5(F.concat(F.lit(str(seed)), F.coalesce(F.try_variant_get("v", key, "string"), F.lit(""))))
    images = F.filter("items", lambda x: F.try_variant_get(x, "$.type", "string") == "image")
    prompt = F.array_join(F.try_variant_get("v", "$.meta_prompt", "array<string>"), "|")
    ready = own.select(
        "line", F.col("v").isNull().alias("bad"), place.alias("place"), F.array_distinct(every(F.col("turns"), "$.role")).alias("roles"), F.array_distinct(every(F.col("items"), "$.type")).alias("types"),
        F.array_distinct(every(images, "$.image.format")).alias("formats"), F.array(F.concat(F.lit(">"), prompt)).alias("prompts"),
    )
    lists = ", ".join(f"{c} array<string>" for c in SETS)
    parts = saved(ready.mapInArrow(_partial(n), f"rows long, rejects long, {lists}, place string, line string"))
    union = lambda c: F.array_sort(F.array_distinct(F.flatten(F.collect_set(c)))).alias(c)
    whole = parts.where("rows is not null").agg(F.sum("rows").alias("rows"), F.sum("rejects").alias("rejects"), *map(union, SETS))
    whole = whole.withColumns({"prompts": F.transform("prompts", lambda p: F.substr(p, F.lit(2))), "has_image": F.array_contains("types", "image"), "has_video": F.array_contains("types", "video")})
    return whole, parts.where("place is not null").select("place", "line").orderBy("place", "line").limit(n)


def funnel(stages: list[tuple[str, DataFrame]], lag: bool = True) -> DataFrame:
    """(step, stage, rows, percent_of_previous) of stages in order."""
    out = None
    for step, (name, df) in enumerate(stages):
        one = df.agg(F.count("*").alias("rows")).select(F.lit(step).alias("step"), F.lit(name).alias("stage"), "rows")
        out = one if out is None else out.unionByName(one)
    before = F.lag("rows").over(W.orderBy("step"))  # a row for each stage
    return out.withColumn("percent_of_previous", F.round(100.0 * F.col("rows") / before, 1)) if lag else out


def numbers(df: DataFrame, column: str) -> DataFrame:
    """mean, median, sample standard deviation (0 for one row), min and max."""
    c, own = F.col(column), saved(df.select(column))
    middle = percentiles(own, [], column, 0.5, "median")  # one row, or none
    rest = own.agg(F.avg(c).alias("mean"), F.coalesce(F.nullif(F.stddev_samp(c), F.lit(float("nan"))), F.lit(0.0)).alias("stdev"), F.min(c).alias("min"), F.max(c).alias("max"))
    return rest.join(F.broadcast(middle), how="left").select("mean", "median", "stdev", "min", "max")


def mix(df: DataFrame, by: str) -> DataFrame:
    """(by, n, percent): shares over all rows, 1 decimal."""
    n = df.groupBy(by).agg(F.count("*").alias("n"))
    return n.withColumn("percent", F.round(100.0 * F.col("n") / F.sum("n").over(W.partitionBy()), 1))  # a row for each value


def coverage(pool: DataFrame, clustered: DataFrame) -> DataFrame:
    """(bucket, clusters, total, percent): clusters of a bucket that the pool has; total defaults to that."""
    mine = pool.groupBy("bucket").agg(F.countDistinct("cluster").alias("clusters"))
    every = clustered.groupBy("bucket").agg(F.countDistinct("cluster").alias("total"))
    total = F.coalesce("total", "clusters")
    return mine.join(every, "bucket", "left").select("bucket", "clusters", total.alias("total"), F.round(100.0 * F.col("clusters") / total, 1).alias("percent"))


def histogram(df: DataFrame, column: str, bins: int, density: bool = False) -> DataFrame:
    """(bin, low, high, n): equal bins over the range, the last one closed; empty bins are left out."""
    span = df.agg(F.min(column).cast("double").alias("lo"), F.max(column).cast("double").alias("hi"))
    width = (F.col("hi") - F.col("lo")) / bins
    at = F.when(F.col("hi") > F.col("lo"), F.least(F.floor((F.col(column) - F.col("lo")) / width), F.lit(bins - 1))).otherwise(0).cast("int")
    rows = df.where(F.col(column).isNotNull()).crossJoin(F.broadcast(span)).select(at.alias("bin"), "lo", width.alias("w"))  # span is one row
    out = rows.groupBy("bin").agg(F.count("*").alias("n"), F.first("lo").alias("lo"), F.first("w").alias("w"))
    out = out.select("bin", (F.col("lo") + F.col("bin") * F.col("w")).alias("low"), (F.col("lo") + (F.col("bin") + 1) * F.col("w")).alias("high"), "n")
    if density:
        out = out.withColumn("density", F.col("n") / (F.sum("n").over(W.partitionBy()) * (F.col("high") - F.col("low"))))
    return out


def compared(pool: DataFrame, high: DataFrame, by: str) -> DataFrame:
    """(by, pool, high): counts of both, 0 where one has none."""
    a, b = pool.groupBy(by).agg(F.count("*").alias("pool")), high.groupBy(by).agg(F.count("*").alias("high"))
    return a.join(b, by, "full").na.fill(0, ["pool", "high"])


def rates(extracted: int, exact: int, near: int, pool: int, high: int, anneal: int) -> dict[str, float | bool]:
    """Dedup rates against the rows that went in, and whether the pool is the disjoint union of its parts."""
    return {"exact_rate": 1 - exact / extracted if extracted else 0.0, "near_rate": 1 - near / exact if exact else 0.0, "pool_ok": pool == high + anneal}


#: What a healthy run looks like.
HEALTHY = {"exact_rate": (0.40, 0.65), "near_rate": (0.03, 0.20), "coverage": (95.0, 100.0), "length_stdev": (30.0, float("inf"))}


def verdicts(metrics: dict[str, float]) -> dict[str, bool]:
    return {k: lo <= metrics[k] <= hi for k, (lo, hi) in HEALTHY.items() if k in metrics}


def text_report(rows: list, metrics: dict) -> str:
    lines = [f"{r['stage']:<24}{r['rows']:>14,}" + (f"{r['percent_of_previous']:>8.1f}%" if r["percent_of_previous"] is not None else "") for r in rows]
    good = verdicts(metrics)
    return "\n".join(lines + [f"{k}: {v}" + (" ok" if good.get(k) else " check" if k in good else "") for k, v in sorted(metrics.items())]) + "\n"


def search(df: DataFrame, query: str, *columns: str) -> Column:
    """Rows with the query in one of the columns, as text."""
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.coalesce(F.contains(F.col(c).cast("string"), F.lit(query)), F.lit(False))
    return hit
