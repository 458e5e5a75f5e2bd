"""JSON-lines scans and sinks with an explicit order and counted rejects."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill.functions.text import strip

BAD = "_corrupt_record"


def lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(file, at, line) of all lines that aren't blank; ``at`` orders a file's lines."""
    raw = spark.read.text(paths).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"), strip(F.col("value")).alias("line"))
    return raw.where("line <> ''").select("file", F.struct("block", "row").alias("at"), "line")


def scan(spark: SparkSession, paths: str | list[str], schema: T.StructType, mode: str = "lenient") -> DataFrame:
    """Parsed rows with file and at.

    lenient: malformed lines are left out. counted: they stay, with skip_reason. strict: they fail
    the query.
    """
    if mode == "strict":
        return lines(spark, paths).withColumn("r", F.from_json("line", schema, {"mode": "FAILFAST"})).select("file", "at", "r.*")
    with_bad = T.StructType([*schema.fields, T.StructField(BAD, T.StringType())])
    parsed = lines(spark, paths).withColumn("r", F.from_json("line", with_bad, {"columnNameOfCorruptRecord": BAD}))
    bad = F.col("r").isNull() | F.col(f"r.{BAD}").isNotNull()
    out = parsed.withColumn("skip_reason", F.when(bad, "json_parse_error"))
    own = [F.col(f"r.{f.name}").alias(f.name) for f in schema.fields]
    if mode == "counted":
        return out.select("file", "at", *own, "skip_reason")
    return out.where("skip_reason is null").select("file", "at", *own)


def numbered(df: DataFrame, first: int = 0) -> DataFrame:
    """With line_no: the place among a file's valid rows.

    Rows are ranked within their block (a split of a file, which is one task) and start where the counts
    of the file's blocks before it end, so a large file isn't one group.
    """
    block = F.col("at.block")
    sizes = df.groupBy("file", block.alias("_block")).agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(W.partitionBy("file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))  # a row for each block
    starts = sizes.select(F.col("file").alias("_file"), "_block", before.alias("_before"))
    ranked = df.withColumn("_rank", F.row_number().over(W.partitionBy("file", block).orderBy("at")))
    out = ranked.join(starts, (F.col("file") == F.col("_file")) & (F.col("at.block") == F.col("_block")))
    return out.withColumn("line_no", (F.col("_before") + F.col("_rank") + (first - 1)).cast("long")).select(*df.columns, "line_no")


def limited(df: DataFrame, n: int) -> DataFrame:
    """The first n valid rows of each file; 0 is all."""
    return numbered(df).where(F.col("line_no") < n) if n else numbered(df)


def count_lines(spark: SparkSession, paths: str | list[str]) -> int:
    return lines(spark, paths).count()


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file, wherever Spark can write."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def scan_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The lenient scan; a missing path has no rows."""
    if exists(spark, path):
        return scan(spark, path, schema)
    return spark.createDataFrame([], T.StructType([T.StructField("file", T.StringType()), T.StructField("at", T.StringType()), *schema.fields]))


def write(df: DataFrame, path: str, append: bool = False) -> int:
    """Write rows as JSON lines and return how many; keys with null values are kept."""
    seen = F.count(F.lit(1)).alias("rows")
    from pyspark.sql import Observation

    rows = Observation()
    df.observe(rows, seen).write.mode("append" if append else "overwrite").option("ignoreNullFields", "false").json(path)
    return rows.get["rows"]


def ordered_union(frames: list[DataFrame]) -> DataFrame:
    """UNION ALL that keeps the order of the inputs in file_rank."""
    out = None
    for rank, df in enumerate(frames):
        df = df.withColumn("file_rank", F.lit(rank))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def field(df: DataFrame, path: str) -> DataFrame:
    """One nested field, rows without it left out; only that column is read."""
    return df.select(F.col(path).alias("value")).dropna()


def domain_of(path: Column) -> Column:
    return F.when(F.replace(F.lower(path), F.lit("\\"), F.lit("/")).contains("illustration"), "stage2_illustration").otherwise("stage1_icon")


def source_of(path: Column) -> Column:
    return F.when(F.lower(path).contains("text2svg"), "text2svg").otherwise("img2svg")


def record_id(domain: Column, source: Column, path: Column, line_no: Column) -> Column:
    """domain/source/folders-stem:line; up to three folders keep ids of equally named files apart."""
    stem = F.regexp_extract(path, r"([^/]+?)(?:\.[^./]*)?$", 1)
    folders = F.replace(F.regexp_extract(path, r"((?:[^/:]+/){0,3})[^/]+$", 1), F.lit("/"), F.lit("-"))
    return F.concat(domain, F.lit("/"), source, F.lit("/"), folders, stem, F.lit(":"), line_no.cast("string"))
