import os

import pytest
from pyspark.sql import functions as F

from gristmill.operators import lsh
from gristmill.streaming import incremental
from test_lsh_graph import greedy, variants

KIND = "id long, text string, domain string"


def put(spark, rows, folder, n):
    """One file, whose time is in order."""
    spark.createDataFrame(rows, KIND).coalesce(1).write.mode("append").parquet(folder)
    for f in sorted(os.listdir(folder)):
        path = os.path.join(folder, f)
        if f.endswith(".parquet") and os.path.getmtime(path) > 2_000_000:
            os.utime(path, (1_000_000 + n, 1_000_000 + n))


def test_a_batch_cut_off_before_its_commit_counts_once(spark, tmp_path):
    source, sink, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = spark.createDataFrame([], KIND).schema
    put(spark, [(i, "a", "d") for i in range(5)], source, 1)
    assert incremental.run_available(spark, source, schema, lambda b: b.where("id <> 2"), sink, check) == 4
    put(spark, [(i, "a", "d") for i in range(5, 8)], source, 2)
    commits = os.path.join(check, "commits")
    assert incremental.run_available(spark, source, schema, lambda b: b, sink, check) == 3
    last = max((f for f in os.listdir(commits) if f.isdigit()), key=int)
    for f in (last, f".{last}.crc"):  # as if it was killed after its write
        os.remove(os.path.join(commits, f))
    incremental.run_available(spark, source, schema, lambda b: b, sink, check)
    assert sorted(r.id for r in incremental.appended(spark, sink, schema).collect()) == [0, 1, 3, 4, 5, 6, 7]
    assert spark.read.parquet(sink).count() == 7
    stream = next(f for f in os.listdir(sink) if f.startswith("stream="))
    os.remove(os.path.join(sink, stream, f"batch={last}", "_SUCCESS"))  # as if it was killed within its write
    assert sorted(r.id for r in incremental.appended(spark, sink, schema).collect()) == [0, 1, 3, 4]
    assert incremental.appended(spark, str(tmp_path / "none"), schema).count() == 0


def test_keys_are_state_and_the_sink_is_not_read(spark, tmp_path):
    source, sink, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = spark.createDataFrame([], KIND).schema
    for n in range(3):
        put(spark, [(i, f"batch {n}", "d") for i in range(n, n + 3)], source, n)
        assert incremental.run_available(spark, source, schema, lambda b: b, sink, check, "id") == (3 if n == 0 else 1)
    got = {r.id: r.text for r in incremental.appended(spark, sink, schema).collect()}
    assert got == {0: "batch 0", 1: "batch 0", 2: "batch 0", 3: "batch 1", 4: "batch 2"}
    with pytest.raises(ValueError):
        incremental.run_available(spark, source, schema, lambda b: b, sink, check, "other")


def test_near_dedup_of_a_stream_equals_the_rule(spark, tmp_path):
    source, sink, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    rows = variants(4, 90)
    schema = spark.createDataFrame([], KIND).schema
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    run = lambda **kw: incremental.near_dedup_stream(stream(), "id", "text", "domain", {"d": 0.7}, sink, check, **kw)
    for n in range(2):
        put(spark, [(*r, "d") for r in rows[n * 30 : n * 30 + 30]], source, n)
    kept = run()
    put(spark, [(*r, "d") for r in rows[60:]], source, 2)
    kept += run()  # another query on the same checkpoint
    want = greedy(rows, 0.7)
    assert sorted(r.id for r in incremental.appended(spark, sink, schema).collect()) == want and kept == len(want)
    assert run() == 0
    whole = spark.createDataFrame([(*r, "d") for r in rows], KIND)
    assert sorted(r.id for r in lsh.near_dedup(whole, "id", "text", "domain", {"d": 0.7}).collect()) == want


def test_taken_keys_of_old_batches_go(spark, tmp_path):
    source, sink, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    schema = spark.createDataFrame([], KIND).schema
    text = "a quick brown fox jumps over the lazy dog again and again"
    for n in range(4):
        put(spark, [(n, text if n in (0, 3) else f"something else number {n * 777}", "d")], source, n)
    rows = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    incremental.near_dedup_stream(rows, "id", "text", "domain", {}, sink, check, keep=2)
    assert sorted(r.id for r in incremental.appended(spark, sink, schema).collect()) == [0, 1, 2, 3]  # the first is three batches back
    keys = [f for f in os.listdir(sink + "-keys") if f.startswith("stream=")][0]
    assert sorted(f for f in os.listdir(os.path.join(sink + "-keys", keys)) if f.startswith("batch=")) == ["batch=1", "batch=2", "batch=3"]
    assert spark.read.parquet(sink).where(F.col("batch") == 3).count() == 1
