"""run() against plain versions of its stages, on a small table."""

import corpus_pipeline
import pytest
from gristmill.llm import mixing, neardup, secrets, toxicity


def test_stages_are_the_five_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash_near_dedup", "secret_scan", "mixing", "packing"]


def test_run_equals_its_stages(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = spark.read.parquet(f"{small}/labels.parquet")
    scores = {r.doc_id: r.score for r in toxicity.digest(docs, labels).collect()}
    clean = docs.where(docs.doc_id.isin([i for i, s in scores.items() if s < toxicity.CUT]))
    kept = [r.doc_id for r in neardup.components(clean).collect() if r.kept]
    rest = clean.where(clean.doc_id.isin(kept))
    mix = {r.doc_id: r.taken // r.size if r.size else 0 for r in mixing.taken(secrets.masked(rest)).collect()}
    out = corpus_pipeline.run(spark, small).collect()
    whole = {}
    for r in out:
        whole[r.doc_id] = whole.get(r.doc_id, 0) + r.length / r.doc_tokens
    assert {i: round(n) for i, n in whole.items()} == {i: n for i, n in mix.items() if n}


@pytest.mark.parametrize("stage", range(4))
def test_stages_keep_columns(spark, small, stage):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    name, f = corpus_pipeline.STAGES[stage]
    out = f(spark, docs, small)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    assert f(spark, docs.limit(0), small).count() == 0


def test_stages_on_odd_rows(spark, small):
    """Null, empty, long and repeated rows, null ids, and columns whose names have dots and quotes."""
    long = " ".join(f"w{i}" for i in range(40000))
    one, two, three, four = range(10**6, 10**6 + 4)  # ids without labels
    rows = [(one, None), (two, ""), (two, ""), (three, long), (three, long), (four, "token=Ab1cdefgh and more words"), (four, "other words of one id"), (None, "no id at all"), (None, "no id at all"), (None, None)]
    kind = "doc_id long, text string, lang string, source string, n_chars long, `a.b` string, `c``d` string"
    docs = spark.createDataFrame([(i, t, "en", None if n % 3 else "s", 1, "x", "y") for n, (i, t) in enumerate(rows)], kind)
    kept = {}
    for name, f in corpus_pipeline.STAGES[:4]:
        out = f(spark, docs, small)
        assert out.columns == docs.columns
        kept[name] = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    given = sorted(rows, key=str)
    assert kept["toxicity"] == given
    once = [(one, None), (two, ""), (two, ""), (three, long), (four, rows[5][1]), (four, rows[6][1]), (None, "no id at all"), (None, None)]
    assert kept["minhash_near_dedup"] == sorted(once, key=str)
    assert kept["secret_scan"] == sorted([(i, "[secret] and more words" if i == four and "token" in t else t) for i, t in rows], key=str)
    assert set(kept["mixing"]) <= set(rows) and mixing.mixed(docs).exceptAll(mixing.mixed(docs)).count() == 0
    packed = corpus_pipeline.STAGES[4][1](spark, docs, small).collect()
    assert sum(r.length / r.doc_tokens for r in packed) == pytest.approx(len(rows))
