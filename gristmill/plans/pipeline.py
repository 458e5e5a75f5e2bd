"""The curation run: stages with Parquet between them, resume, dry run, a report.

python -m gristmill.plans.pipeline run --out DIR FILE... [--resume] [--dry-run] [--stage NAME]
"""

from __future__ import annotations

import argparse
import json
import time
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gristmill import schema
from gristmill.operators import cluster, convert, curate, lsh, report, sample
from gristmill.sources import jsonl

STAGES = ("extract", "clean", "dedup_exact", "dedup_near", "svg_filter", "embed", "cluster", "sample")
#: Sources in order of priority, and the two domains.
PRIORITY = {"img2svg": 0, "text2svg": 1}
DOMAINS = ("stage1_icon", "stage2_illustration")


@dataclass(frozen=True)
class Config:
    files: list[str] = field(default_factory=list)
    out: str = "out"
    thresholds: dict[str, float] = field(default_factory=lambda: {"stage1_icon": 0.8, "stage2_illustration": 0.7})
    bottom: float = 0.10
    filtered: list[str] = field(default_factory=lambda: ["stage1_icon"])
    dim: int = 256
    embed_shards: int = 8
    clusters: dict[str, int] = field(default_factory=dict)
    default_clusters: int = 1000
    pool_size: int = 1_000_000
    high_size: int = 200_000
    quotas: dict[str, int] = field(default_factory=dict)
    seed: int = 42
    dry_run_rows: int = 0

    @classmethod
    def load(cls, values: dict) -> Config:
        """Unknown keys are an error."""
        unknown = set(values) - set(cls.__dataclass_fields__)
        if unknown:
            raise ValueError(f"unknown settings: {sorted(unknown)}")
        return cls(**values)


class Run:
    def __init__(self, spark: SparkSession, config: Config, model=None, profile=None):
        """``model`` makes encoders (see ``cluster.embedded``); ``profile`` gives its tasks their accelerators."""
        self.spark, self.config, self.model, self.profile = spark, config, model, profile

    def path(self, stage: str) -> str:
        return f"{self.config.out}/{stage}"

    def read(self, stage: str) -> DataFrame:
        return self.spark.read.parquet(self.path(stage))

    def done(self, stage: str) -> bool:
        return jsonl.exists(self.spark, self.path(stage) + "/_SUCCESS")

    def extract(self) -> DataFrame:
        parts = [jsonl.limited(jsonl.scan(self.spark, f, schema.CANONICAL), self.config.dry_run_rows) for f in self.config.files]
        rows = convert.extracted(jsonl.ordered_union(parts))
        domain, source = jsonl.domain_of(F.col("file")), jsonl.source_of(F.col("file"))
        good = rows.where("skip_reason is null")
        return good.select(
            F.struct("file_rank", "line_no").alias("seq"), "instruction", jsonl.record_id(domain, source, F.col("file"), F.col("line_no")).alias("id"), domain.alias("domain"), source.alias("source"), "svg_len", F.col("reply").alias("gt_svg")
        )

    def clean(self) -> DataFrame:
        return curate.clean(self.read("extract"), "instruction")

    def dedup_exact(self) -> DataFrame:
        rank = F.coalesce(F.create_map(*(F.lit(x) for kv in PRIORITY.items() for x in kv))[F.col("source")], F.lit(len(PRIORITY)))
        out = curate.exact_dedup(self.read("clean"), "instruction", rank, "seq")
        return out.withColumn("seq", F.col("position")).drop("position", "copies", "replaced")

    def dedup_near(self) -> DataFrame:
        # files and lines fit one number, in their order
        df = self.read("dedup_exact").withColumn("n", F.col("seq.file_rank").cast("long") * (1 << 40) + F.col("seq.line_no"))
        return lsh.near_dedup(df, "n", "instruction", "domain", self.config.thresholds)

    def svg_filter(self) -> DataFrame:
        return curate.complexity_filter(self.read("dedup_near"), "domain", "svg_len", self.config.bottom, self.config.filtered)

    def embed(self, shards: list[int]) -> DataFrame:
        """(id, embedding, shard) of the rows of some shards, a task or more for each."""
        n = self.config.embed_shards
        rows = self.read("svg_filter").withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")).where(F.col("shard").isin(shards))
        return cluster.embedded(rows.repartition(len(shards), "shard"), "id", "instruction", self.model, self.config.dim, keep=["shard"], profile=self.profile)

    def write_embeddings(self, resume: bool) -> None:
        """Shards by a hash of the id, a folder each, all that are pending in one scan and one job.

        On resume those whose folder is marked as done stay, and only the others are made.
        """
        folder = self.path("embed")
        mark = lambda i: f"{folder}/shard={i}/_SUCCESS"
        pending = [i for i in range(self.config.embed_shards) if not (resume and jsonl.exists(self.spark, mark(i)))]
        if pending:
            self.embed(pending).write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("shard").parquet(folder)
            for i in pending:
                jsonl.write_text(self.spark, mark(i), "")
        jsonl.write_text(self.spark, f"{folder}/_SUCCESS", "")

    def cluster(self) -> DataFrame:
        rows, _ = cluster.with_vectors(self.read("svg_filter").drop("gt_svg"), self.read("embed").drop("shard"), "id")
        return cluster.clustered(rows, "domain", self.config.clusters, self.config.default_clusters, key="id").drop("embedding")

    def sample(self) -> DataFrame:
        c = self.config
        rows = self.read("cluster").select("id", F.col("domain").alias("bucket"), F.col("cluster_id").alias("cluster"), F.col("distance_to_centroid").alias("dist"), F.col("n").alias("seq"), "source", "instruction")
        sizes = rows.groupBy("bucket").agg(F.count("*").alias("size"), F.min("seq").alias("first_seq"))
        per = rows.groupBy("bucket", "cluster").agg(F.count("*").alias("size"), F.min("seq").alias("first_seq")).join(sample.quotas(sizes, c.pool_size, c.quotas), "bucket")
        pool = sample.pool(rows, sample.budgets(per))
        high = sample.high_priority(pool, c.high_size, c.seed, "id").select("id").withColumn("high", F.lit(True))
        return pool.join(high, "id", "left").withColumn("high", F.coalesce("high", F.lit(False)))

    def run(self, stages: list[str] | None = None, resume: bool = False) -> dict:
        wrong = set(stages or ()) - set(STAGES)
        if wrong:
            raise ValueError(f"unknown stages: {sorted(wrong)}")
        took = {}
        for stage in STAGES:
            if (stages and stage not in stages) or (resume and self.done(stage)):
                continue
            began = time.time()
            if stage == "embed":
                self.write_embeddings(resume)
            else:
                getattr(self, stage)().write.mode("overwrite").parquet(self.path(stage))
            took[stage] = round(time.time() - began, 1)
        out = {"config": asdict(self.config), "seconds": took}
        jsonl.write_text(self.spark, f"{self.config.out}/run_stats.json", json.dumps(out))
        return out

    def analyze(self) -> tuple[DataFrame, dict, str]:
        have = [(s, self.read(s)) for s in STAGES[:-1] if s != "embed" and self.done(s)]
        pool = self.read("sample")
        rows = report.funnel([*have, ("pool", pool)]).collect()
        n = {r["stage"]: r["rows"] for r in rows}
        high = pool.where("high").count()
        metrics = report.rates(n["extract"], n["dedup_exact"], n["dedup_near"], n["pool"], high, pool.where("not high").count())
        length = report.numbers(pool.withColumn("l", F.length("instruction")), "l").first().asDict()
        distance = report.numbers(pool, "dist").first().asDict()
        metrics |= {f"length_{k}": v for k, v in length.items()} | {f"distance_{k}": v for k, v in distance.items()}
        every = self.read("cluster").select(F.col("domain").alias("bucket"), F.col("cluster_id").alias("cluster"))
        covered = report.coverage(pool, every).orderBy("bucket").collect()  # a row for each bucket
        for r in covered:
            metrics[f"coverage {r['bucket']}"] = r["percent"]
        metrics["coverage"] = round(100.0 * sum(r["clusters"] for r in covered) / max(1, sum(r["total"] for r in covered)), 1)
        metrics |= {f"source {r['source']}": r["percent"] for r in report.mix(pool, "source").collect()}  # a row for each source
        text = report.text_report(rows, metrics)
        jsonl.write_text(self.spark, f"{self.config.out}/report.txt", text)
        jsonl.write_text(self.spark, f"{self.config.out}/metrics.json", json.dumps(dict(sorted(metrics.items()))))
        return self.spark.createDataFrame(rows), metrics, text


def settings(path: str) -> dict:
    """A JSON file of settings, or a YAML one where its reader is installed."""
    with open(path) as f:
        if path.endswith((".yaml", ".yml")):
            import yaml

            return yaml.safe_load(f) or {}
        return json.load(f)


def main(args: list[str] | None = None) -> None:
    p = argparse.ArgumentParser()
    p.add_argument("command", choices=["run", "analyze", "estimate"])
    p.add_argument("files", nargs="*")
    p.add_argument("--config", help="a JSON or YAML file of settings")
    p.add_argument("--out")
    p.add_argument("--resume", action="store_true")
    p.add_argument("--dry-run", action="store_true")
    p.add_argument("--dry-run-n", type=int, default=100)
    p.add_argument("--stage", action="append")
    a = p.parse_args(args)
    values = settings(a.config) if a.config else {}
    values |= {"files": a.files} if a.files else {}
    values |= {"out": a.out} if a.out else {}
    values |= {"dry_run_rows": a.dry_run_n} if a.dry_run else {}
    spark = SparkSession.builder.appName("gristmill").getOrCreate()
    run = Run(spark, Config.load(values))
    if a.command == "estimate":
        sizes = spark.read.format("binaryFile").load(run.config.files).select("length").agg(F.sum("length")).first()[0]
        print(json.dumps({"bytes": sizes, "stages": STAGES}))
    elif a.command == "run":
        print(json.dumps(run.run(a.stage, a.resume)))
    else:
        _, metrics, text = run.analyze()
        print(text + json.dumps(metrics))


if __name__ == "__main__":
    main()
