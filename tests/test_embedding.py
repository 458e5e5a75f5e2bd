import os

import numpy as np
import pyarrow as pa
import pytest

from gristmill.functions import tables
from gristmill.operators import cluster
from gristmill.plans.pipeline import Config, Run


@pytest.fixture
def model():
    """Made within a function, so that workers get it by value."""

    def make(*device):
        return lambda texts: np.array([[len(t), t.count("a"), len(device), 1.0] for t in texts], np.float32)

    return make


@pytest.fixture
def run(spark, tmp_path, model):
    out = str(tmp_path / "out")
    spark.createDataFrame([(f"r{i}", "a" * (i % 7) + "b") for i in range(60)], "id string, instruction string").write.parquet(out + "/svg_filter")
    return Run(spark, Config(out=out, dim=3, embed_shards=4), model)


def test_pending_shards_are_made_in_one_scan(spark, run):
    assert str(run.embed([0, 1, 2, 3])._jdf.queryExecution().executedPlan()).count("FileScan") == 1
    run.write_embeddings(False)
    got = run.read("embed")
    assert got.count() == 60 and got.select("shard").distinct().count() == 4
    folder = run.path("embed")
    files = {f: os.path.getmtime(os.path.join(folder, d, f)) for d in os.listdir(folder) if d.startswith("shard=") for f in os.listdir(os.path.join(folder, d)) if f.endswith(".parquet")}
    for f in os.listdir(os.path.join(folder, "shard=2")):  # a lost shard
        os.remove(os.path.join(folder, "shard=2", f))
    run.write_embeddings(True)
    again = {f: os.path.getmtime(os.path.join(folder, d, f)) for d in os.listdir(folder) if d.startswith("shard=") for f in os.listdir(os.path.join(folder, d)) if f.endswith(".parquet")}
    kept = set(files) & set(again)
    assert len(kept) >= len(files) - 2 and all(files[f] == again[f] for f in kept) and len(kept) < len(files)
    assert run.read("embed").select("id").distinct().count() == 60
    run.write_embeddings(True)  # nothing is pending
    assert run.read("embed").count() == 60


def test_devices_and_barrier(spark, model):
    from pyspark.resource import ResourceProfileBuilder, TaskResourceRequests

    df = spark.createDataFrame([(i, "a" * i) for i in range(6)], "id long, text string").repartition(2)
    assert cluster.device() is None
    assert cluster.embedded(df, "id", "text", model, 2, barrier=True).count() == 6
    profile = ResourceProfileBuilder().require(TaskResourceRequests().cpus(1)).build
    plan = str(cluster.embedded(df, "id", "text", model, 2, profile=profile)._jdf.queryExecution().optimizedPlan())
    assert "ResourceProfile" in plan or "MapInArrow" in plan


def test_table_functions(spark):
    tables.register(spark)
    text = "see\n```svg\n<a/>\n``` \n ```\n```x"
    rows = spark.sql("SELECT * FROM text_segments({text})", text=text).collect()
    assert [(r.place, r.kind, r.language, r.body) for r in rows] == [(0, "text", "", "see\n"), (1, "code", "svg", "<a/>"), (2, "code", "", ""), (3, "text", "", "x")]
    assert spark.sql("SELECT * FROM text_segments(null)").collect() == []
    assert sorted(tuple(r) for r in spark.sql("SELECT * FROM text_shingles('aaab', 2)").collect()) == [(0x6161, 2), (0x6162, 1)]
    assert [tuple(r) for r in spark.sql("SELECT * FROM text_shingles('', 2)").collect()] == [(0, 1)]
    for wrong in ("text_segments(1)", "text_shingles('a', 9)", "text_shingles('a', 'b')"):
        with pytest.raises(Exception, match="takes a"):
            spark.sql(f"SELECT * FROM {wrong}").collect()


def test_shingles_are_batches(spark):
    """A text's rows come as one Arrow batch; before, each was made in Python."""
    made = list(tables.TableShingles().eval(pa.record_batch({"id": [1, 2, 3, 4], "t": ["aaab", None, "é", "ab"]}), pa.array([2])))
    assert [list(zip(*b.to_pydict().values(), strict=True)) for b in made] == [[(1, 0x6161, 2), (1, 0x6162, 1)], [(2, 0, 1)], [(3, 0xC3A9, 1)], [(4, 0x6162, 1)]]
    tables.register(spark)
    rows = spark.createDataFrame([(1, "abcabc"), (2, None), (3, "x" * 5000), (4, "ab")], "id long, t string")
    got = spark.sql("SELECT id, count(*) AS n, sum(n) AS places, max(shingle) AS most FROM table_shingles(TABLE({rows}), 5) GROUP BY id", rows=rows).collect()
    assert sorted(tuple(r) for r in got) == [(1, 2, 2, 0x6263616263), (2, 1, 1, 0), (3, 1, 4996, 0x7878787878), (4, 1, 1, 0x6162)]
