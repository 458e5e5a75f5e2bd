import json
import math
import random

import pyarrow as pa
import pytest

from gristmill import schema
from gristmill.operators import cluster, convert, enrich, report, sample
from gristmill.plans.pipeline import STAGES, Config, Run
from gristmill.sources import jsonl
from gristmill.streaming.incremental import run_available
from pyspark.sql import functions as F


def turn(role, *texts, image=None):
    items = [{"type": "image", "image": {"type": "image", "format": "image/png", "relative_path": image, "width": 0, "height": 0}}] if image else []
    return {"role": role, "content": items + [{"type": "text", "text": {"type": "text", "format": "text/plain", "string": t}} for t in texts]}


def chat(user, reply, **kw):
    return json.dumps({"meta_prompt": [""], "data": [turn("user", user, **kw)] + ([turn("assistant", reply)] if reply is not None else [])})


@pytest.fixture
def files(tmp_path):
    """Five, two, two and three records, with what a scan has to bear between them."""
    names = [("stage1/icon/img2svg", 5), ("stage2/icon/img2svg", 2), ("stage2/illustration/img2svg", 2), ("stage1/icon/text2svg", 3)]
    out = []
    for name, n in names:
        path = tmp_path / name / "data_000000.jsonl"
        path.parent.mkdir(parents=True)
        path.write_text("\n".join([chat(f"  Draw a {name} number {i} with many shapes ", f"<svg>{'x' * (i + 1) * 7}</svg>", image="a.png" if i else None) for i in range(n)] + ["", "{bad", chat("", "<svg/>"), chat("no reply", None)]))
        out.append(str(path))
    return out


def test_scans(spark, files):
    assert jsonl.count_lines(spark, files[0]) == 8
    assert jsonl.scan(spark, files[0], schema.CANONICAL).count() == 7
    assert jsonl.scan(spark, files[0], schema.CANONICAL, "counted").where("skip_reason is not null").count() == 1
    with pytest.raises(Exception):
        jsonl.scan(spark, files[0], schema.CANONICAL, "strict").collect()
    assert jsonl.scan_or_empty(spark, files[0] + ".none", schema.CANONICAL).count() == 0
    assert jsonl.limited(jsonl.scan(spark, files[0], schema.CANONICAL), 3).count() == 3


def test_sink_returns_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, "é"), (2, None)], "a long, b string")
    assert jsonl.write(df, str(tmp_path / "o")) == 2 and jsonl.write(df, str(tmp_path / "o"), append=True) == 2
    assert spark.read.text(str(tmp_path / "o")).where(F.col("value").contains("é")).count() == 2




def test_domain_source_id(spark):
    p = F.lit("file:/x/Illustration/text2svg/data_000000.jsonl")
    r = spark.range(1).select(jsonl.domain_of(p).alias("d"), jsonl.source_of(p).alias("s"), jsonl.record_id(jsonl.domain_of(p), jsonl.source_of(p), p, F.lit(3)).alias("i")).first()
    assert (r.d, r.s, r.i) == ("stage2_illustration", "text2svg", "stage2_illustration/text2svg/x-Illustration-text2svg-data_000000:3")


def test_convert_reasons_in_order(spark):
    rows = [
        ("Instruction: \"draw\"", "", [], "missing_assistant_text"), ("no mark", "<svg/>", [], "missing_user_content"), ("<image> Instruction: a", "<svg/>", [], "invalid_image_format"),
        ("<image> Instruction: a", "<svg/>", [""], "invalid_relative_path"), ("<image> Instruction: a", "<svg/>", ["/a.png"], "invalid_relative_path"), ("<image> Instruction: a", "<svg/>", ["a.gif"], "invalid_image_format"),
        ("<image> Instruction: a", "<svg/>", ["a.PNG"], None), ("Instruction: a\nb ", "<svg/>", ["a.png"], None),
    ]
    df = spark.createDataFrame([(i, "", o, m) for i, o, m, _ in rows], schema.RAW).withColumn("n", F.monotonically_increasing_id())
    got = convert.converted(df).orderBy("n").collect()
    assert [r.skip_reason for r in got] == [w for *_, w in rows]
    assert [c.type for c in got[6].data[0].content] == ["image", "text"] and got[7].warning == "images_without_tag"
    assert got[7].data[0].content[0].text.string == "a\nb" and got[7].data[1].content[0].text.string == "```svg\n<svg/>\n```"
    assert {r.skip_reason: r.n for r in convert.skip_counts(convert.converted(df)).collect()}["ok"] == 2


def quota_plain(sizes, total, fixed):
    own = {b: min(fixed[b], s) for b, s in sizes.items() if b in fixed}
    rest, left = {b: s for b, s in sizes.items() if b not in fixed}, max(0, total - sum(own.values()))
    raw = {b: left * s / sum(rest.values()) for b, s in rest.items()}
    out = {b: math.floor(x) for b, x in raw.items()}
    for b in sorted(rest, key=lambda b: -(raw[b] - out[b]))[: left - sum(out.values())]:
        out[b] += 1
    return own | out


@pytest.mark.parametrize("sizes,total,fixed,want", [({"a": 300, "b": 700}, 100, {}, {"a": 30, "b": 70}), ({"a": 450, "b": 900}, 1000, {"a": 300}, {"a": 300, "b": 700}), ({"a": 100, "b": 950}, 1000, {"a": 500}, {"a": 100, "b": 900})])
def test_quota(spark, sizes, total, fixed, want):
    df = spark.createDataFrame([(b, s, i) for i, (b, s) in enumerate(sizes.items())], "bucket string, size long, first_seq long")
    got = {r.bucket: r.quota for r in sample.quotas(df, total, fixed).collect()}
    assert got == want == quota_plain(sizes, total, fixed)


def budget_plain(sizes, budget):
    if budget <= 0:
        return [0] * len(sizes)
    if len(sizes) >= budget:
        top = sorted(range(len(sizes)), key=lambda i: -sizes[i])[:budget]
        return [int(i in top) for i in range(len(sizes))]
    root = [math.sqrt(s) for s in sizes]
    raw = [budget * r / sum(root) for r in root]
    f = [max(1, math.floor(x)) for x in raw]
    diff = budget - sum(f)
    if diff > 0:
        for i in sorted(range(len(f)), key=lambda i: -(raw[i] - f[i]))[:diff]:
            f[i] += 1
    for i in sorted(range(len(f)), key=lambda i: -f[i])[: max(0, -diff)]:
        f[i] -= f[i] > 1
    return f


def test_budget(spark):
    rng = random.Random(1)
    cases = [([100, 400, 25], 50), (list(range(1, 101)), 10), ([10**6] + [1] * 100, 150)] + [([rng.randrange(1, 500) for _ in range(rng.randrange(1, 12))], rng.randrange(0, 60)) for _ in range(12)]
    rows = [(f"c{n}", i, s, i, b) for n, (sizes, b) in enumerate(cases) for i, s in enumerate(sizes)]
    df = spark.createDataFrame(rows, "bucket string, cluster int, size long, first_seq long, quota long")
    got = {(r.bucket, r.cluster): r.budget for r in sample.budgets(df).collect()}
    for n, (sizes, b) in enumerate(cases):
        assert [got[(f"c{n}", i)] for i in range(len(sizes))] == budget_plain(sizes, b), (sizes, b)
    strict = sample.budgets(df, strict=True).where("bucket = 'c2'").agg(F.sum("budget")).first()[0]
    assert strict == 150


def rows_of(spark, clusters, each):
    return spark.createDataFrame([("b", c, j / 10, c * each + j) for c in range(clusters) for j in range(each)], "bucket string, cluster int, dist double, seq long")


def test_pool_and_high_priority(spark):
    df = rows_of(spark, 4, 10)
    budget = spark.createDataFrame([("b", c, 8) for c in range(4)], "bucket string, cluster int, budget long")
    p = sample.pool(df, budget)
    high = sample.high_priority(p, 16, 42, "seq")
    rest = sample.remainder(p, high, "seq")
    assert p.count() == 32 and high.count() == 16 and rest.count() == 16
    assert [r["count"] for r in high.groupBy("cluster").count().collect()] == [4] * 4 and high.agg(F.max("dist")).first()[0] == 0.3
    assert sample.high_priority(p, 10, 42, "seq").count() == 10 and sample.high_priority(p, 0, 42, "seq").count() == 0 and sample.high_priority(p, 99, 42, "seq").count() == 32


def test_cluster_and_nearest(spark, monkeypatch):
    rng = random.Random(2)
    df = spark.createDataFrame([(i, "xy"[i % 2], [rng.random() for _ in range(6)]) for i in range(60)], "id long, bucket string, embedding array<double>")
    out = cluster.clustered(df, "bucket", {"x": 4}, 100)
    assert out.count() == 60 and out.where("bucket = 'x'").select("cluster_id").distinct().count() <= 4
    middles = spark.createDataFrame([(k, [rng.random() for _ in range(6)]) for k in range(5)], "label int, centroid array<double>")
    a = {r.id: r.nearest for r in cluster.nearest(df, middles).collect()}
    monkeypatch.setattr(cluster, "BROADCAST", 0)
    assert a == {r.id: r.nearest for r in cluster.nearest(df, middles).collect()}
    joined, missing = cluster.with_vectors(df.select("id", "bucket"), df.where("id < 50").select("id", "embedding"), "id")
    assert joined.count() == 50 and missing.first().missing == 10


def test_embedding(spark):
    df = spark.createDataFrame([(f"r{i}", "text " * i) for i in range(7)], "id string, text string")

    def model():
        import numpy as np

        return lambda texts: np.array([[len(t) + 1.0, 2.0, 3.0] for t in texts])

    out = cluster.embedded(df, "id", "text", model, 2).collect()
    assert len(out) == 7 and all(abs(sum(x * x for x in r.embedding) - 1) < 1e-5 and len(r.embedding) == 2 for r in out)
    done = cluster.embedded(df.where("id < 'r3'"), "id", "text", None, 4)
    assert cluster.embed_pending(df, done, "id", "text", None, 4).count() == 4


def test_enrichment(spark):
    calls = []

    def flaky(prompt):
        calls.append(prompt)
        if len(calls) < 3:
            raise enrich.CallError(429, "Wed, 21 Oct 2015 07:28:00 GMT")
        return "ok"

    waits = []
    assert enrich.attempt(flaky, "p", 3, waits.append) == "ok" and waits == [1.0, 2.0]
    with pytest.raises(enrich.CallError):
        enrich.attempt(lambda p: (_ for _ in ()).throw(enrich.CallError(404)), "p", 5, waits.append)
    assert enrich.delay(0, enrich.CallError(503, "7")) == 7.0 and len(waits) == 2
    done = spark.createDataFrame([("1", "ok"), ("2", "error"), ("", "ok")], "id string, status string")
    df = spark.createDataFrame([("1", "a"), ("2", "b"), ("", "c")], "id string, t string")
    assert sorted(r.id for r in enrich.pending(df, done.withColumnRenamed("id", "id"), "id").collect()) == ["", "2"]
    assert enrich.pending(df, done, "id", retry_errors=False).count() == 1


def test_reports(spark):
    df = spark.range(10).withColumn("k", F.col("id") % 2)
    f = report.funnel([("a", df), ("b", df.where("id < 5"))]).orderBy("step").collect()
    assert [(r.rows, r.percent_of_previous) for r in f] == [(10, None), (5, 50.0)]
    assert report.numbers(df.limit(1), "id").first().stdev == 0.0
    h = report.histogram(df, "id", 3).orderBy("bin").collect()
    assert [r.n for r in h] == [3, 3, 4]
    assert "check" in report.text_report(f, {"exact_rate": 0.1}) and report.rates(10, 5, 4, 3, 1, 2)["pool_ok"]


def test_whole_run_and_resume(spark, files, tmp_path):
    c = Config(files=files, out=str(tmp_path / "out"), dim=8, default_clusters=3, pool_size=8, high_size=3, bottom=0.1)
    run = Run(spark, c)
    run.run()
    n = {s: run.read(s).count() for s in STAGES}
    assert n["extract"] == 12 and n["clean"] == 12 and n["dedup_exact"] == 12 and n["sample"] <= n["cluster"] <= n["svg_filter"] < 12
    assert run.read("extract").select("id").distinct().count() == 12
    assert run.read("sample").where("high").count() == min(3, n["sample"])
    assert run.run(resume=True)["seconds"] == {}
    with pytest.raises(ValueError):
        run.run(["nonsense"])
    with pytest.raises(ValueError):
        Config.load({"unknown": 1})
    _, metrics, text = run.analyze()
    assert metrics["pool_ok"] and "extract" in text


def test_incremental(spark, tmp_path):
    src, sink, check = (str(tmp_path / x) for x in ("src", "sink", "check"))
    df = spark.createDataFrame([(i, f"t{i}") for i in range(10)], "id long, t string")
    df.coalesce(1).write.parquet(src)
    step = lambda b: b.where("id % 2 = 0")
    assert run_available(spark, src, df.schema, step, sink, check, "id") == 5
    assert run_available(spark, src, df.schema, step, sink, check, "id") == 0
    df.coalesce(1).write.mode("append").parquet(src)
    assert run_available(spark, src, df.schema, step, sink, check, "id") == 0
    assert spark.read.parquet(sink).count() == 5


def test_enrichment_holds_parts_of_a_batch(spark, monkeypatch):
    """A batch of long texts is worked on in parts; before, it was held whole several times over."""
    batch = pa.record_batch({"id": [str(i) for i in range(7)], "instruction": ["a" * 600_000, None, "b" * 600_000, "", "c" * 3_000_000, "d", "e"]})
    made = list(enrich.parts(batch))
    assert [p.num_rows for p in made] == [2, 2, 1, 2] and pa.Table.from_batches(made).combine_chunks().to_batches()[0].equals(batch)
    rows = spark.createDataFrame([(i, "x" * (i % 7)) for i in range(50)], "id long, t string")

    def make():
        def call(prompt):
            if len(prompt) == 3:
                raise enrich.CallError(400)
            return prompt[:2]

        return call

    got = {r.id: (r.instruction, r.status, r.response, r.error) for r in enrich.enriched(rows, "id", "t", make, pause=False).collect()}
    assert len(got) == 50 and got["3"] == ("xxx", "error", None, "CallError: status 400") and got["8"] == ("x", "ok", "x", None)


def against_sql(spark, folder, *names):
    """Rows of queries and of their SQL on odd texts: none, blank ones, marks and image tags within."""
    import duckdb

    from gristmill.plans import queries

    odd = ["plain", None, "", ' "', '" " "', " \x85\x0b\x1c", "a <image> b", "<image>", "Instruction:", 'Instruction: x"', "a "]
    rows = spark.createDataFrame([(n * len(odd) + i, t) for n in range(1155) for i, t in enumerate(odd)], "doc_id long, text string")
    rows.union(rows.selectExpr("doc_id + 12706", "text")).coalesce(1).write.parquet(f"{folder}/documents.parquet")  # a text meets each remainder of 11
    sql = duckdb.connect()
    sql.execute(f"CREATE VIEW documents AS FROM '{folder}/documents.parquet/*.parquet'")
    order = lambda got: sorted(map(tuple, got), key=str)
    return [(order(queries.QUERIES[n](spark, str(folder)).collect()), order(sql.execute(queries.ORACLE_SQL[n]).fetchall())) for n in names]


def test_rows_convert_as_in_their_sql(spark, tmp_path):
    (got, want), *_ = against_sql(spark, tmp_path, "convert_rows")
    assert got == want and {r[3] for r in got} == {None, 1, 2}


def test_skip_reasons_count_as_in_their_sql(spark, tmp_path):
    (got, want), *_ = against_sql(spark, tmp_path, "convert_skip_reasons")
    assert got == want and len(got) == 5
