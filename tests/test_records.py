import base64
import json

import numpy as np
from gristmill import schema
from gristmill.operators import cluster, curate, enrich
from gristmill.plans import batch, record_queries
from gristmill.streaming.incremental import first_seen
from pyspark.sql import functions as F


def test_uris_have_no_line_breaks(spark):
    data = bytes(range(256)) * 3
    df = spark.createDataFrame([("a/b.PNG", data), ("c.bin", b"")], "path string, content binary")
    got = {r.path: r.uri for r in enrich.data_uri(df).collect()}
    assert got == {"a/b.PNG": "data:image/png;base64," + base64.b64encode(data).decode(), "c.bin": "data:application/octet-stream;base64,"}


def test_limit_before_resume(spark):
    df = spark.createDataFrame([(str(i), i) for i in range(9)], "id string, n int")
    done = spark.createDataFrame([("0", "ok"), ("1", "error")], "id string, status string")
    assert sorted(r.id for r in enrich.pending(df, done, "id", limit=3, order="n").collect()) == ["1", "2"]
    numbers = spark.createDataFrame([(1,), (2,)], "id long")
    assert [r.id for r in enrich.pending(numbers, numbers.where("id = 1").withColumn("status", F.lit("ok")), "id").collect()] == [2]


def test_call_log_appends_and_never_fails(spark, tmp_path):
    rows = spark.createDataFrame([("1", "a b", "ok", "c", None)], schema.ENRICHED)
    log = enrich.call_log(rows, "u", "m")
    path = str(tmp_path / "log")
    assert enrich.log_calls(log, path) == 1 and enrich.log_calls(log, path) == 1
    assert spark.read.schema(schema.CALL_LOG).json(path).count() == 2
    (tmp_path / "file").write_text("")
    assert enrich.log_calls(log, str(tmp_path / "file" / "log")) is None


def test_projection(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 2)) * [5, 2] @ np.linalg.qr(rng.normal(size=(6, 6)))[0][:2]
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)] + [(99, None)], "id long, embedding array<double>")
    got = {r.id: (r.x, r.y) for r in cluster.projected(df, "id").collect()}
    p = np.array([got[i] for i in range(60)])
    apart = lambda y: np.linalg.norm(y[:, None] - y[None], axis=2)
    assert np.allclose(apart(p), apart(x)) and p[:, 0].var() > p[:, 1].var()  # a plane keeps its distances
    assert cluster.projected(df, "id", rows=7).count() == 7
    assert [tuple(r) for r in cluster.projected(df.where("id = 3"), "id").collect()] == [(3, 0.0, 0.0)]
    assert cluster.projected(df.where("id > 99"), "id").count() == 0


def test_kmeans_ends_at_a_fixed_point(spark):
    rng = np.random.default_rng(6)
    middle = rng.normal(size=(3, 4)) * 20
    df = spark.createDataFrame([(i, "b", (middle[i % 3] + rng.normal(size=4)).tolist()) for i in range(90)], "id long, bucket string, embedding array<double>")
    rows = cluster.clustered(df, "bucket", {"b": 3}).collect()
    x, own = np.array([r.embedding for r in rows]), np.array([r.cluster_id for r in rows])
    means = np.array([x[own == k].mean(0) for k in range(own.max() + 1)])
    apart = np.linalg.norm(x[:, None] - means[None], axis=2)
    assert (apart.argmin(1) == own).all() and np.allclose(apart.min(1), [r.distance_to_centroid for r in rows], atol=1e-5)


def raw_line(n, reply="<svg/>", image=None):
    return json.dumps({"instruction": ("<image>\n" if image else "") + f"Instruction: draw number {n} of many", "input": "", "output": reply, "images": [image] if image else []})


def test_batch_conversion(spark, tmp_path):
    raw = tmp_path / "raw"
    for name, rows in (("stage1/icon/img2svg/a", [raw_line(0, image="a.png"), raw_line(1), "{bad", raw_line(2, reply="")]), ("stage2/illustration/text2svg/b", [raw_line(n) for n in range(5)])):
        path = raw / f"{name}_alpaca.jsonl"
        path.parent.mkdir(parents=True)
        path.write_text("\n".join(rows) + "\n")
    (raw / "other.jsonl").write_text(raw_line(9))
    out = str(tmp_path / "out")
    counts = batch.convert_all(spark, str(raw), out)
    a, b = f"{out}/stage1/icon/img2svg/data_000000.jsonl", f"{out}/stage2/illustration/text2svg/data_000000.jsonl"
    assert counts == {a: {"ok": 2, "json_parse_error": 1, "missing_assistant_text": 1}, b: {"ok": 5}}
    assert spark.read.schema(schema.CANONICAL).json(a).count() == 2 and json.loads((tmp_path / "out" / "conversion.json").read_text()) == counts
    text = batch.everything(spark, str(raw), str(tmp_path / "all"), dim=4, default_clusters=2, pool_size=4, high_size=2, filtered=[])
    assert "extract" in text and "pool_ok: True" in text


def test_first_seen_holds_across_batches(spark, tmp_path):
    source, kind = str(tmp_path / "in"), "k string, ts timestamp, v int"
    parts = [[("a", 1, 1), ("b", 2, 2), ("a", 3, 3)], [("a", 4, 4), ("c", 5, 5)]]
    rows = lambda part: spark.createDataFrame(part, "k string, s long, v int").selectExpr("k", "timestamp_seconds(s) AS ts", "v")
    got = []
    for part in parts:
        rows(part).coalesce(1).write.mode("append").json(source)
        stream = first_seen(spark.readStream.schema(kind).json(source), "k", "ts")
        stream.writeStream.foreachBatch(lambda b, _: got.extend(r.k for r in b.collect())).option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(got) == ["a", "b", "c"]
    assert sorted((r.k, r.v) for r in first_seen(rows(sum(parts, [])), "k", "ts").collect()) == [("a", 1), ("b", 2), ("c", 5)]


def test_projection_has_every_row(spark, tmp_path):
    n = cluster.PROJECTED + 3
    spark.range(n).selectExpr("id AS vec_id", "array(float(id % 7), float(id % 3), float(id % 2)) AS embedding").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = record_queries.projection(spark, str(tmp_path))
    assert got.count() == n and got.select("vec_id").distinct().count() == n


def test_rates_make_each_stage_once(spark, small, monkeypatch):
    calls = {"clean": 0, "pooled": 0}

    def counted(where, name):
        f = getattr(where, name)

        def run(*a):
            calls[name] += 1
            return f(*a)

        monkeypatch.setattr(where, name, run)

    counted(curate, "clean")
    counted(record_queries.queries, "pooled")
    r = record_queries.dedup_rates(spark, small).first()
    assert calls == {"clean": 1, "pooled": 1} and r.pool_ok
