"""Embedding, joining vectors to records, k-means per bucket, distances and inertia."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.resource import ResourceProfile
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from gristmill.functions.vectors import distance
from gristmill.operators import lloyd
from gristmill.operators.sample import hashed_sample
from gristmill.sources.stores import saved

#: Centroids of at most so many bytes are broadcast; more are met in blocks.
BROADCAST = 32 << 20


def device() -> str | None:
    """The accelerator that this task was given by its resource profile, else null."""
    task = TaskContext.get()
    for found in (task.resources() if task else {}).values():
        return found.addresses[0]
    return None


def embedded(
    df: DataFrame, key: str, text: str, model: Callable[..., Callable[[list[str]], np.ndarray]] | None, dim: int, batch: int = 64, keep: list[str] | None = None, barrier: bool = False, profile: ResourceProfile | None = None
) -> DataFrame:
    """(id, embedding) of unit length, with the columns ``keep``. ``model`` makes an encoder once per task; None gives zero vectors.

    A stage-level ``profile`` gives each task its own accelerator, whose address ``model`` then gets as an argument; with
    ``barrier`` all tasks of the stage start together, for models that span tasks.
    """
    own = df.select(F.col(key).alias("id"), F.col(text).alias("text"), *(keep or []))
    names, devices = keep or [], profile is not None
    if model is None:
        return own.select("id", F.array_repeat(F.lit(0.0).cast("float"), dim).alias("embedding"), *names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = model(device()) if devices else model()
        for b in batches:
            texts, parts = [t or "" for t in b["text"].to_pylist()], []
            for lo in range(0, len(texts), batch):
                x = np.asarray(encode(texts[lo : lo + batch]), np.float32)[:, :dim]
                parts.append(x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-8))
            x = np.concatenate(parts) if parts else np.zeros((0, dim), np.float32)
            flat = pa.array(x.ravel(), pa.float32())
            yield pa.RecordBatch.from_arrays([b["id"], pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, dim), pa.int32()), flat), *(b[n] for n in names)], ["id", "embedding", *names])

    kinds = "".join(f", {n} {own.schema[n].dataType.simpleString()}" for n in names)
    return own.mapInArrow(run, f"id {own.schema['id'].dataType.simpleString()}, embedding array<float>{kinds}", barrier=barrier, profile=profile)


def embed_pending(df: DataFrame, done: DataFrame, key: str, text: str, model: Callable | None, dim: int) -> DataFrame:
    """Vectors of the rows that have none yet (resume)."""
    return embedded(df.join(done.select(F.col("id").alias(key)), key, "left_anti"), key, text, model, dim)


def with_vectors(records: DataFrame, vectors: DataFrame, key: str, order: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Records with their vectors, and the number of records without one.

    Of several vectors of one key the last by ``order`` counts (without it, the largest row).
    """
    rest = [c for c in vectors.columns if c != key]
    row = F.struct(*rest)
    last = vectors.groupBy(key).agg((F.max_by(row, order) if order else F.max(row)).alias("_v")).select(key, *(F.col(f"_v.{c}").alias(c) for c in rest if c != order))
    return records.join(last, key), records.join(last, key, "left_anti").agg(F.count("*").alias("missing"))


def centroids(df: DataFrame, by: list[str], vector: str = "embedding") -> DataFrame:
    """(by, centroid): component means; components are summed apart, so no vector list is gathered."""
    parts = df.select(*by, F.posexplode(vector).alias("pos", "x")).groupBy(*by, "pos").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return parts.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("centroid"))


def described(df: DataFrame, by: list[str], vector: str = "embedding") -> DataFrame:
    """``df`` with cluster_size and distance_to_centroid (6 decimals)."""
    middle = centroids(df, by, vector)
    size = F.count("*").over(W.partitionBy(*by))
    return df.withColumn("cluster_size", size).join(middle, by).withColumn("distance_to_centroid", F.round(distance(F.col(vector), F.col("centroid")), 6)).drop("centroid")


def inertia(df: DataFrame, by: list[str], vector: str = "embedding") -> DataFrame:
    return df.join(centroids(df, by, vector), by).agg(F.sum(F.pow(distance(F.col(vector), F.col("centroid")), F.lit(2.0))).alias("inertia"))


def nearest(df: DataFrame, middles: DataFrame, vector: str = "embedding") -> DataFrame:
    """``df`` with nearest (centroid's label) and its distance; ties go to the smaller label.

    middles: (label, centroid). Centroids are broadcast behind a check of their size; beyond it
    rows meet them in blocks and keep the best by an aggregate.
    """
    count, dim = middles.agg(F.count("*"), F.max(F.size("centroid"))).first()
    if count * (dim or 0) * 8 <= BROADCAST:
        known = sorted(((r["label"], r["centroid"]) for r in middles.collect()), key=lambda x: x[0])
        c = np.array([m for _, m in known], np.float64)
        labels = np.array([n for n, _ in known], object)
        kind = to_arrow_type(middles.schema["label"].dataType)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            middle = lloyd.Middles(c)
            for b in batches:
                at, far = middle.nearest(b[vector].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(b.num_rows, -1))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(labels[at].tolist(), kind), pa.array(np.sqrt(far))], [*b.schema.names, "nearest", "distance"])

        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
        return df.mapInArrow(run, f"{kinds}, nearest {middles.schema['label'].dataType.simpleString()}, distance double")
    blocks = middles.withColumn("_block", F.pmod(F.xxhash64("label"), F.lit(-(-count // 1000)))).groupBy("_block").agg(F.collect_list(F.struct("label", "centroid")).alias("_middles"))
    rows = df.withColumn("_row", F.monotonically_increasing_id())
    rows = saved(rows)
    best = F.array_min(F.transform("_middles", lambda m: F.struct(distance(F.col(vector), m["centroid"]).alias("d"), m["label"].alias("label"))))
    met = rows.select("_row", vector, F.explode(F.sequence(F.lit(0), F.lit(-(-count // 1000) - 1))).alias("_block")).join(blocks, "_block")
    found = met.select("_row", best.alias("b")).groupBy("_row").agg(F.min("b").alias("b"))
    return rows.join(found, "_row").select(*df.columns, F.col("b.label").alias("nearest"), F.col("b.d").alias("distance"))


def kmeans(df: DataFrame, k: int, vector: str = "embedding", key: str | None = None, **settings) -> DataFrame:
    """``df`` with cluster_id of the best of several seeded runs, as one bucket."""
    names = df.columns
    return lloyd.fitted(df.withColumn("_all", F.lit("")), "_all", {}, k, vector, key, **settings).select(*names, "cluster_id")


def clustered(
    df: DataFrame, bucket: str, sizes: dict[str, int], default: int = 1000, vector: str = "embedding", backend: Callable[[DataFrame, int], DataFrame] | None = None, key: str | None = None, **settings
) -> DataFrame:
    """Each bucket clustered for itself, then described. Buckets are few (the keys of a config).

    All buckets share one pass of exact Lloyd a round, or of mini-batches (``batch``); another ``backend`` gets one bucket after the other.
    """
    if backend is None:
        return described(saved(lloyd.fitted(df, bucket, sizes, default, vector, key, **settings)), [bucket, "cluster_id"], vector)
    names = [r[0] for r in df.select(bucket).distinct().limit(1001).collect()]
    if len(names) > 1000:
        raise ValueError("more than 1000 buckets; cluster them by a coarser key")
    out = None
    for name in sorted(names, key=str):
        part = backend(df.where(F.col(bucket).eqNullSafe(F.lit(name))), sizes.get(name, default))
        out = part if out is None else out.unionByName(part)
    if out is None:
        return df.withColumns({"cluster_id": F.lit(0), "cluster_size": F.lit(0), "distance_to_centroid": F.lit(0.0)})
    return described(out, [bucket, "cluster_id"], vector)


def actual_k(label: str = "cluster_id") -> Column:
    """The largest label and one, which counts empty labels below it too."""
    return F.max(label) + 1


#: Rows of a projection at most.
PROJECTED = 50_000


def projected(df: DataFrame, key: str, vector: str = "embedding", rows: int | None = PROJECTED, seed: int | str = 42) -> DataFrame:
    """(key, x, y): the two main axes of a reproducible sample of rows (None: of all rows), each axis' largest load positive.

    Fewer than two rows, or vectors of one component, have zeros where there is no axis.
    """
    from pyspark.ml.feature import PCA
    from pyspark.ml.functions import array_to_vector, vector_to_array

    own = df.where(F.col(vector).isNotNull()).select(F.col(key), F.transform(vector, lambda x: x.cast("double")).alias("_x"))
    own = saved(own if rows is None else hashed_sample(own, rows, key, seed))
    n, dim = own.agg(F.count("*"), F.max(F.size("_x"))).first()
    if n < 2:
        return own.select(key, F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    ready = own.withColumn("_v", array_to_vector("_x"))
    model = PCA(k=min(2, dim), inputCol="_v", outputCol="_p").fit(ready)
    axes = model.pc.toArray()
    signs = np.where(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])] < 0, -1.0, 1.0).tolist()
    at = vector_to_array("_p")
    return model.transform(ready).select(key, (at[0] * signs[0]).alias("x"), (at[1] * signs[1] if dim > 1 else F.lit(0.0)).alias("y"))
