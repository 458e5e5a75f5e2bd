import os
import sys
import unicodedata

import pytest

from gristmill.functions import text as T
from gristmill.operators import curate
from pyspark.sql import functions as F


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "t string").select(f(F.col("t")).alias("x")).first().x


def test_strip_takes_all_white_space(spark):
    assert one(spark, " \t hello world  \n", T.strip) == "hello world"


@pytest.mark.parametrize("raw", ["é", "plain", "", "Évié élan", "가"])
def test_nfc(spark, raw):
    assert one(spark, raw, T.nfc) == unicodedata.normalize("NFC", raw)


def test_clean_counts(spark):
    df = spark.createDataFrame([("  hello ",), ("ab",), ("   ",), (None,), ("abc",)], "text string")
    s = curate.clean_stats(df).first()
    assert (s.total, s.kept, s.dropped_empty, s.dropped_short) == (5, 2, 2, 1)
    assert sorted(r.text for r in curate.clean(df).collect()) == ["abc", "hello"]


def priority():
    return F.when(F.col("source") == "img2svg", 0).otherwise(1)


def test_exact_dedup_prefers_priority_then_order(spark):
    rows = [(1, "same", "text2svg"), (2, "same", "img2svg"), (3, "other", "text2svg"), (4, "twin", "img2svg"), (5, "twin", "img2svg")]
    df = spark.createDataFrame(rows, "seq long, text string, source string")
    got = {r.text: (r.seq, r.position, r.replaced) for r in curate.exact_dedup(df, "text", priority(), "seq").collect()}
    assert got == {"same": (2, 1, True), "other": (3, 3, False), "twin": (4, 4, False)}
    s = curate.exact_dedup_stats(df, "text", priority(), "seq").first()
    assert (s.kept, s.removed, s.replaced) == (3, 2, 1)


def test_percentile_filter(spark):
    df = spark.createDataFrame([("icon", n) for n in range(10, 101, 10)] + [("illustration", 5)], "d string, n long")
    out = [tuple(r) for r in curate.complexity_filter(df, "d", "n", 0.1, ["icon"]).select("d", "n").collect()]
    assert len(out) == 10 and ("illustration", 5) in out and min(n for d, n in out if d == "icon") == 20
    tie = spark.createDataFrame([("icon", n) for n in (10, 10, 10, 40)], "d string, n long")
    assert curate.complexity_filter(tie, "d", "n", 0.5, ["icon"]).count() == 1


def test_blocks_and_elements(spark):
    assert one(spark, "x ```SVG\n <a/> \n``` y", lambda c: T.code_block(c, "svg")) == "<a/>"
    assert one(spark, "none", lambda c: T.code_block(c, "svg")) is None
    assert one(spark, "t <SVG w='1'>\n</svg> <svg>2</svg>", T.raw_element) == "<SVG w='1'>\n</svg>"
    assert one(spark, "<svg>raw</svg>", T.best_element) == "<svg>raw</svg>"
    assert one(spark, "a<b>&\"'", T.escape_html) == "a&lt;b&gt;&amp;&quot;&#39;"
    parts = one(spark, "hi ```py\nx=1\n``` bye", T.segments)
    assert [(p.kind, p.language, p.body.strip()) for p in parts] == [("text", "", "hi"), ("code", "py", "x=1"), ("text", "", "bye")]


@pytest.mark.parametrize("pipeline", [True, False])
def test_entry_works_without_the_optional_parts(tmp_path, pipeline):
    import shutil
    import subprocess

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if pipeline and not os.path.exists(f"{root}/corpus_pipeline.py"):
        pytest.skip("the pipeline isn't there")
    skip = shutil.ignore_patterns("llm", "__pycache__", ".git", "*.json", "spark-warehouse", *([] if pipeline else ["corpus_pipeline.py"]))
    shutil.copytree(root, tmp_path / "copy", ignore=skip)
    assert (tmp_path / "copy" / "corpus_pipeline.py").exists() == pipeline and not (tmp_path / "copy" / "tests" / "llm").exists()
    code = "import __spark_entry__ as e; n = set(e.queries()); assert n and not any(x.startswith('op') or x == 'pipeline' for x in n); assert set(e.oracle_sql()) <= n"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path / "copy", check=True, env=env)
    subprocess.run([sys.executable, "-m", "pytest", "-q", "--collect-only", "tests"], cwd=tmp_path / "copy", check=True, env=env)


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from gristmill.sources import stores

    made = lambda master, folder: SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: folder), sparkContext=SimpleNamespace(master=master))
    assert stores.shared_folder(made("spark://x:7077", "s3a://b/c")) == "s3a://b/c" and stores.shared_folder(made("local[4]", None))
    with pytest.raises(RuntimeError):
        stores.shared_folder(made("local-cluster[3,2,1024]", None))


def test_saved_leaves_the_session_as_it_was(spark):
    from gristmill.sources import stores

    was = spark.conf.get(stores.BATCH_SETTING)
    made = stores.saved(spark.range(10))
    assert spark.conf.get(stores.BATCH_SETTING) == was and made.count() == 10
    stores.discard(made)
    assert not os.path.exists(made._saved_at)


def test_strip_takes_time_in_proportion(spark):
    """Long white space within a text: a search for white space at the end began anew at each of its characters."""
    import time

    texts = ["x" + " " * 300_000 + "y", " \t\u00a0a b\n c\u2028\x85\n", "\u3000 \n", "", "a", "\x1c\x1fb\r\n"]
    began = time.time()
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", T.clean_text(F.col("t")).alias("t")).orderBy("i").collect()
    assert [r["t"] for r in rows] == [texts[0], "a b\n c", "", "", "a", "b"]
    assert time.time() - began < 20
