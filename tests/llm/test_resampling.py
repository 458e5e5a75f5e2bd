import hashlib
import math
import re
import zlib

import pytest

from gristmill.llm import resampling as rs
from conftest import ODD  # tests/llm/conftest


def grams(text, longest=3):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)], len(words)


def brute(rows, target, share=5, least=20, buckets=10_000):
    hashed = lambda text: [zlib.crc32(g.encode()) % buckets for g in grams(text)[0]]
    s, t = [0] * buckets, [0] * buckets
    for _, text in rows:
        for b in hashed(text):
            s[b] += 1
    for text in target:
        for b in hashed(text):
            t[b] += 1
    gain = [math.floor(1000 * math.log((t[b] + 1) * (sum(s) + buckets) / ((s[b] + 1) * (sum(t) + buckets)))) for b in range(buckets)]
    out = []
    for i, text in rows:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in hashed(text))
        out.append([i, len(hashed(text)), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), grams(text)[1]])
    able = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): n + 1 for n, r in enumerate(able[: share * len(able) // 100])}
    return sorted(repr((*r[:4], rank.get(id(r)))) for r in out)


def run(spark, documents, rows, target, **kw):
    return sorted(repr(tuple(r)) for r in rs.resampled(documents(rows), spark.createDataFrame([(t, 1) for t in target], "text string, item_id int"), **kw).collect())


@pytest.fixture(scope="module")
def given(spark, small):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    return rows, [r.text for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()]


def test_equals_plain_version(spark, documents, given):
    rows, target = given
    assert run(spark, documents, rows, target) == brute(rows, target)
    assert run(spark, documents, rows, target, share=60) == brute(rows, target, share=60)


def test_odd_repeated_and_null_rows(spark, documents, given):
    rows = [*ODD, *((i, f"w{i} " * 19) for i in range(50, 60)), *((i, f"w{i} " * 20) for i in range(60, 70)), *[(7, "Same Text, " * 15)] * 40, *[(None, "No id " * 12)] * 40, *given[0][:20]]
    assert run(spark, documents, rows, [*given[1], None, ""], share=70) == brute(rows, [*given[1], None, ""], share=70)
    assert run(spark, documents, rows, []) == brute(rows, [])
    assert run(spark, documents, [], given[1]) == []


def test_ring_runs_on_over_blocks(monkeypatch, given):
    for held in (1, 10, 1 << 18):
        monkeypatch.setattr(rs, "HELD", held)
        for longest in (1, 2, 3, 5):
            for text in ["", "a", "a b", "é È Z9", "\x00", *(t for _, t in given[0][:30])]:
                got = sorted(b for part in rs.emitted(text.encode(), 10_000, longest) for b in part.tolist())
                assert got == sorted(zlib.crc32(g.encode()) % 10_000 for g in grams(text, longest)[0])


def test_the_draw_leans_to_the_target(spark, documents):
    rows = [(i, ("red green blue " if i % 10 == 0 else f"one two three {i} ") * 10) for i in range(400)]
    target = spark.createDataFrame([("red green blue " * 20,)], "text string")
    got = rs.drawn(documents(rows), target, share=5).collect()
    assert len(got) == 20 and all(r.doc_id % 10 == 0 for r in got) and sorted(r._rank for r in got) == list(range(1, 21))
