"""Conversion of many raw files and the whole way from raw files to a report.

python -m gristmill.plans.batch convert RAW OUT
python -m gristmill.plans.batch all RAW OUT
"""

from __future__ import annotations

import argparse
import json
import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill import schema
from gristmill.operators import convert
from gristmill.plans.pipeline import Config, Run
from gristmill.sources import jsonl

#: The ending of a raw file's name and the name of what is made of it, in the same folder of the output.
RAW_END, MADE = "_alpaca.jsonl", "data_000000.jsonl"


def pairs(spark: SparkSession, raw: str, out: str) -> list[tuple[str, str]]:
    """(raw file, output) for every raw file at or below ``raw``, in order of path."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(raw)
    store = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    base = store.makeQualified(root).toString().rstrip("/")
    files, found = store.listFiles(root, True), []
    while files.hasNext():
        path = files.next().getPath().toString()
        if path.endswith(RAW_END):
            found.append((path, f"{out.rstrip('/')}{posixpath.dirname(path)[len(base):]}/{MADE}"))
    return sorted(found)


def convert_file(spark: SparkSession, source: str, target: str, mode: str = "sft", prefix: str = "") -> DataFrame:
    """Write the good records of one raw file as JSON lines; (skip_reason, n), ok for those written."""
    raw = jsonl.scan(spark, source, schema.RAW, "counted").withColumnRenamed("skip_reason", "_scan")
    rows = convert.converted(raw, mode, prefix).withColumn("skip_reason", F.coalesce("_scan", "skip_reason"))
    good = rows.where("skip_reason is null").orderBy("file", "at")
    good.select("meta_prompt", "data").write.mode("overwrite").json(target)
    return convert.skip_counts(rows)


def convert_all(spark: SparkSession, raw: str, out: str, mode: str = "sft", prefix: str = "") -> dict[str, dict[str, int]]:
    """Counts of reasons by output, a few numbers for each file; they are written beside the outputs too."""
    counts = {target: {r["skip_reason"]: r["n"] for r in convert_file(spark, source, target, mode, prefix).collect()} for source, target in pairs(spark, raw, out)}
    jsonl.write_text(spark, f"{out.rstrip('/')}/conversion.json", json.dumps(counts, sort_keys=True))
    return counts


def everything(spark: SparkSession, raw: str, out: str, **settings) -> str:
    """Convert, select, analyze; the text of the report."""
    made = convert_all(spark, raw, f"{out}/processed")
    run = Run(spark, Config.load(settings | {"files": list(made), "out": f"{out}/selected"}))
    run.run()
    return run.analyze()[2]


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser()
    p.add_argument("command", choices=["convert", "all"])
    p.add_argument("raw")
    p.add_argument("out")
    a = p.parse_args(args)
    spark = SparkSession.builder.appName("gristmill").getOrCreate()
    print(json.dumps(convert_all(spark, a.raw, a.out)) if a.command == "convert" else everything(spark, a.raw, a.out))


if __name__ == "__main__":
    main()
