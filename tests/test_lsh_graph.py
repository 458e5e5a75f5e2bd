import random

import numpy as np
import pyarrow as pa
import pytest

from gristmill.operators import lsh
from gristmill.operators.graph import connected_components

SCHEMA = "seq long, text string, domain string"


def greedy(rows, threshold):
    b, r = lsh.bands(threshold)
    seen, kept = set(), []
    for seq, text in sorted(rows):
        sig = lsh.signature(text)
        keys = {(i, sig[i * r : (i + 1) * r].tobytes()) for i in range(b)}
        if not keys & seen:
            seen |= keys
            kept.append(seq)
    return kept


def variants(seed, n=120):
    rng, rows = random.Random(seed), []
    bases = [" ".join(rng.choice("alpha beta gamma delta icon red blue circle square line".split()) + str(rng.randrange(90)) for _ in range(30)) for _ in range(8)]
    for i in range(n):
        w = rng.choice(bases).split()
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = str(rng.randrange(1000))
        rows.append((i, " ".join(w)))
    return rows


def test_band_numbers():
    assert lsh.bands(0.8) == (9, 13) and lsh.bands(0.7) == (14, 9)


def test_byte_shingles():
    assert len(lsh.byte_shingles("")) == 1 and len(lsh.byte_shingles("abc")) == 1 and len(lsh.byte_shingles("abcdef")) == 2
    assert len(lsh.byte_shingles("éé")) == 1 and len(lsh.byte_shingles("ééé")) == 2


@pytest.mark.parametrize("finish", [0, 10_000])
@pytest.mark.parametrize("partitions", [1, 5])
def test_rounds_equal_the_sequential_rule(spark, finish, partitions):
    rows = variants(3)
    df = spark.createDataFrame([(*r, "d") for r in rows], SCHEMA).repartition(partitions)
    got = sorted(r.seq for r in lsh.near_dedup(df, "seq", "text", "domain", {"d": 0.7}, finish=finish).collect())
    want = greedy(rows, 0.7)
    assert got == want and len(want) < len(rows)


def test_domains_do_not_meet(spark):
    text = "a quick brown fox jumps over the lazy dog again and again"
    df = spark.createDataFrame([(1, text, "a"), (2, text, "b"), (3, text, "a"), (4, text, None), (5, text, None)], SCHEMA)
    assert sorted(r.seq for r in lsh.near_dedup(df, "seq", "text", "domain", {"a": 0.8}).collect()) == [1, 2, 4]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(150), rng.randrange(150)) for _ in range(110)] + [(i, i + 1) for i in range(200, 260)] + [(7, 7), (None, 3)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i

    for a, b in edges:
        if a is not None and a != b:
            ra, rb = find(a), find(b)
            root[max(ra, rb)] = min(ra, rb)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {i: find(i) for i in root}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_signature_estimates_likeness():
    a, b = "the quick brown fox " * 3 + "x" * 40, "the quick brown fox " * 3 + "y" * 40
    x, y = set(lsh.byte_shingles(a).tolist()), set(lsh.byte_shingles(b).tolist())
    assert abs(np.mean(lsh.signature(a) == lsh.signature(b)) - len(x & y) / len(x | y)) < 0.15


def in_order(rows):
    """The sequential rule on (seq, key) rows."""
    own, taken, kept = {}, set(), []
    for seq, key in rows:
        own.setdefault(seq, set()).add(key)
    for seq in sorted(own):
        if not own[seq] & taken:
            taken |= own[seq]
            kept.append(seq)
    return kept


@pytest.mark.parametrize("finish", [16, 60, 10_000])
def test_blocks_components_and_halves_equal_the_sequential_rule(spark, finish):
    rng = random.Random(5)
    rows = [(i, rng.randrange(250)) for i in range(300) for _ in range(2)] + [(i, 1000 + i // 2 * 2 + d) for i in range(0, 40) for d in (0, 2)] + [(i, -1) for i in range(100, 300, 3)]
    rng.shuffle(rows)
    keys = spark.createDataFrame([(s, k, f"x{k % 3}") for s, k in rows], "seq long, a long, b string")
    assert sorted(r.seq for r in lsh.greedy(keys, finish).collect()) == in_order(rows)


def test_a_long_chain_takes_few_jobs(spark):
    n = 100_000
    keys = spark.range(n).selectExpr("id as seq", "explode(array(id, id + 1)) as key")
    got = [r.seq for r in lsh.greedy(keys, 30_000).orderBy("seq").collect()]
    assert got == list(range(0, n, 2))
    ends = lsh.blocks(keys, 30_000)
    assert len(ends) == 2 and abs(ends[0] - 30_000) < 200


def test_greedy_on_nothing_and_repeated_rows(spark):
    assert lsh.greedy(spark.createDataFrame([], "seq long, key long")).collect() == []
    assert [r.seq for r in lsh.greedy(spark.createDataFrame([(2, 5), (2, 5), (1, 5), (1, 6), (3, 6), (3, 7), (4, 7)], "seq long, key long")).orderBy("seq").collect()] == [1, 4]


def test_shared_shingles_are_hashed_once(monkeypatch):
    rng, hashed, plain = np.random.default_rng(5), [], lsh._hashed
    phrases = ["".join(map(chr, rng.integers(97, 123, 400))) for _ in range(20)]
    texts = [" ".join(phrases[i] for i in rng.integers(0, 20, 1 + k % 7)) for k in range(150)] + ["", "ab", "\u00e9" * 30, None]
    monkeypatch.setattr(lsh, "_hashed", lambda h, *x: hashed.append(len(h)) or plain(h, *x))
    got = lsh.flat_signatures(pa.array(texts), 16)
    assert sum(hashed) < 16 * 20_000  # 240,000 shingles, some 10,000 of them distinct
    a, b = lsh.family(16)
    for row, text in zip(got, texts, strict=True):
        h = lsh.byte_shingles(text or "") % lsh.PRIME
        assert row.tolist() == [int(((int(x) * h + int(y)) % lsh.PRIME).min()) for x, y in zip(a, b, strict=True)]
    # texts that have little in common
    other = ["".join(map(chr, rng.integers(33, 127, 700))) for _ in range(40)]
    assert (lsh.flat_signatures(pa.array(other), 16) == np.concatenate([lsh.flat_signatures(pa.array([t]), 16) for t in other])).all()
