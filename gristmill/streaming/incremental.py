"""Incremental runs over folders that grow: a file stream appended to a sink in batches of their own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.operators import lsh
from gristmill.sources.stores import discard, saved


def _files(spark: SparkSession, path: str):
    """(file system, path) of the session's Hadoop configuration."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def batch_folder(batch: DataFrame, sink: str, number: int) -> str:
    """Where a batch of a stream lies: by the stream's own id, which its checkpoint keeps, and its number.

    A batch that is run again after a failure writes its folder anew, so it counts once, whatever the sink's size.
    """
    name = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "0"
    return f"{sink}/stream={name}/batch={number}"


def appended(spark: SparkSession, sink: str, schema: T.StructType, format: str = "parquet") -> DataFrame:
    """The rows of a sink's whole batches; one that was cut off in the middle isn't among them."""
    files, root = _files(spark, sink)
    whole = []
    if files.exists(root):
        for stream in files.listStatus(root):
            if stream.isDirectory():
                whole += [b.getPath().toString() for b in files.listStatus(stream.getPath()) if b.isDirectory() and files.exists(_files(spark, b.getPath().toString() + "/_SUCCESS")[1])]
    if not whole:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).format(format).load(whole)


def run_available(spark: SparkSession, source: str, schema: T.StructType, step: Callable[[DataFrame], DataFrame], sink: str, checkpoint: str, key: str | None = None, format: str = "parquet", per_batch: int = 1000) -> int:
    """Put all new files of ``source`` through ``step`` and append to ``sink``; the rows appended.

    The checkpoint says which files are done, and each batch has a folder of its own, so rows are appended once
    even where a batch is cut off between its write and its commit. With a ``key`` (a column of the source) the first row
    of each key counts: keys are state of the stream, and no batch reads the sink.
    """
    rows = []

    def write(batch: DataFrame, number: int) -> None:
        seen = Observation()
        step(batch).observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(format).save(batch_folder(batch, sink, number))
        rows.append(seen.get["rows"])

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch).format(format).load(source)
    if key:
        if key not in schema.names:
            raise ValueError(f"{key} is no column of the source")
        stream = stream.dropDuplicates([key])
    stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return sum(rows)


def near_dedup_stream(rows: DataFrame, seq: str, text: str, domain: str, thresholds: dict[str, float], sink: str, checkpoint: str, default: float = 0.8, finish: int = lsh.FINISH, keep: int | None = None) -> int:
    """Near-dedup of a stream by the sequential rule: batches in order, and rows by ``seq`` within a batch; the rows kept.

    A batch is the next prefix of the order: rows that share a band key with a row kept before go first, the rest is settled as
    on tables. The keys that its kept rows take lie beside the sink, a folder for each batch; with ``keep`` only those of
    so many batches before count, and older ones are deleted. Folders are written anew when a batch is run again.
    """
    spark, kept = rows.sparkSession, []
    kind = T.StructType([T.StructField("band", T.IntegerType()), T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])

    def write(batch: DataFrame, number: int) -> None:
        out, taken_at = batch_folder(batch, sink, number), batch_folder(batch, sink + "-keys", number)
        files, root = _files(spark, taken_at.rsplit("/", 1)[0])
        before = []
        for b in files.listStatus(root) if files.exists(root) else []:
            n = int(b.getPath().getName().removeprefix("batch="))
            if n < number and (keep is None or n >= number - keep):
                before.append(b.getPath().toString())
            elif n < number:
                files.delete(b.getPath(), True)
        own = saved(batch)
        keys = saved(lsh.domain_keys(own, seq, text, domain, thresholds, default))
        part = saved(lsh.untaken(keys, spark.read.schema(kind).parquet(*before))) if before else keys
        now = saved(lsh.settled(part, finish))
        part.join(now, "seq", "left_semi").select("band", "a", "b").write.mode("overwrite").parquet(taken_at)
        seen = Observation()
        own.join(now.withColumnRenamed("seq", seq), seq, "left_semi").observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(out)
        kept.append(seen.get["rows"])
        discard(own, keys, part, now)

    rows.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return sum(kept)


def windowed_counts(events: DataFrame, time: str, by: str, width: str = "1 hour", late: str | None = "10 minutes") -> DataFrame:
    """Counts per window and key; works on streams (with a watermark) and on tables."""
    if late and events.isStreaming:
        events = events.withWatermark(time, late)
    return events.groupBy(F.window(time, width).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), by, "n")


def first_seen(rows: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    """The first row of each key; works on streams and on tables.

    On a stream the keys seen are kept as state across batches for as long as ``late`` rows may come, so the state is
    bounded by the keys of that span. On a table the earliest row by ``time`` stays, ties by all columns.
    """
    if rows.isStreaming:
        return rows.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
    rest = [c for c in rows.columns if c not in (key, time)]
    first = rows.groupBy(key).agg(F.min(F.struct(time, *rest)).alias("_first"))
    return first.select(*((F.col(key) if c == key else F.col(f"_first.{c}").alias(c)) for c in rows.columns))
