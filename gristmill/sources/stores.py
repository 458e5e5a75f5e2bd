"""Working tables in the folder that the driver and all executors share."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
#: Rows in an Arrow batch: texts may be long, and a worker holds a batch several times over.
BATCH, BATCH_SETTING = 2000, "spark.sql.execution.arrow.maxRecordsPerBatch"


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder; a local one only where driver and executors are one process."""
    folder = spark.conf.get(SETTING, None)
    if not folder and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError(f"{SETTING} must name a folder that the driver and all executors share")
    return folder or os.path.join(tempfile.gettempdir(), "gristmill-shared")


def saved(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write ``df`` once as a Parquet table in the shared folder and read it back.

    This cuts the lineage: a lost executor costs at most the tasks that were running, and
    branches that use the table twice don't compute it twice. Values of ``by`` (few) get folders of
    their own, so that who reads one value reads no other.
    """
    spark = df.sparkSession
    path = f"{_folder(spark)}/{uuid.uuid4().hex}"
    was = spark.conf.get(BATCH_SETTING, "10000")
    if not 0 < int(was) <= BATCH:
        spark.conf.set(BATCH_SETTING, str(BATCH))
    try:
        df.write.parquet(path, partitionBy=by)
    finally:
        if spark.conf.get(BATCH_SETTING, was) != was:
            spark.conf.set(BATCH_SETTING, was)
    made = spark.read.schema(df.schema).parquet(path)
    made._saved_at = path
    return made


#: Bytes of a table that is small for its readers' CPU time, whatever its files are like.
SMALL = 64 << 20


def spread(df: DataFrame) -> DataFrame:
    """``df`` over all cores if the plan says that it is small; a small file may be one row group, thus one task."""
    if df.isStreaming or int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > SMALL:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


def _folder(spark: SparkSession) -> str:
    """The folder of this application's tables; it goes when the driver ends, if nobody drops it before."""
    path = f"{shared_folder(spark)}/tables-{spark.sparkContext.applicationId}"
    if path not in _known:
        _known.add(path)
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        store = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        store.mkdirs(where)
        store.deleteOnExit(where)
    return path


_known: set[str] = set()


def discard(*tables: DataFrame) -> None:
    """Delete working tables made by ``saved`` that no later plan reads; others are left alone."""
    for df in tables:
        if path := getattr(df, "_saved_at", None):
            _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the input tables (a Parquet file or folder)."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def drop_tables(spark: SparkSession) -> None:
    """Delete the working tables of this application; results that weren't written yet need them."""
    path = f"{shared_folder(spark)}/tables-{spark.sparkContext.applicationId}"
    _known.discard(path)
    _delete(spark, path)
