import numpy as np

from gristmill.llm import neighbours as nn


def brute(rows, every=50, k=5):
    good = {}
    for i, x in rows:
        if i is None or x is None or not len(x) or any(c is None or not np.isfinite(c) for c in x) or not any(x):
            continue
        good[i] = np.array(x, float) / np.abs(x).max()
    out = {}
    for q in good:
        if q % every:
            continue
        near = sorted((-round(float(good[q] @ y / np.sqrt((good[q] @ good[q]) * (y @ y))), 12), i) for i, y in good.items() if i != q and len(y) == len(good[q]))
        out[q] = [i for _, i in near[:k]]
    return out


def run(spark, rows, **kw):
    got = {}
    for r in sorted(nn.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, score int"), **kw).collect(), key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r.vec_id)
    return got


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(nn, "QUERY_TILE", 4)
    monkeypatch.setattr(nn, "TILE", 32)
    monkeypatch.setattr(nn, "GROUP", 2)
    rng = np.random.default_rng(1)
    middle = rng.normal(size=(6, 16))
    rows = [(i, (middle[i % 6] + 0.3 * rng.normal(size=16)).tolist(), 0, 0) for i in range(700)]
    rows += [(1000 + i, rows[50][1], 0, 0) for i in range(9)]  # ties
    rows += [(1050, None, 0, 0), (1100, [0.0] * 16, 0, 0), (1150, [float("nan")] * 16, 0, 0), (1200, [None] * 16, 0, 0), (1250, [], 0, 0), (1300, [1.0, 2.0], 0, 0), (1301, [2.0, 4.0], 0, 0), (None, rows[0][1], 0, 0), (1350, (1e-200 * middle[0]).tolist(), 0, 0), (7, rows[7][1], 0, 0)]
    assert run(spark, rows, every=10) == {q: v for q, v in brute([r[:2] for r in rows], 10).items() if v}


def test_bounds_hold():
    rng = np.random.default_rng(2)
    for dim in (3, 64, 1500):
        a, b = (nn.Tile(np.arange(20), rng.normal(size=(20, dim))) for _ in range(2))
        near, off = nn.bounds(a, b)
        true = (a.x / np.linalg.norm(a.x, axis=1)[:, None]) @ (b.x / np.linalg.norm(b.x, axis=1)[:, None]).T
        assert (np.abs(true - near) <= off).all()


def test_packing_round_trip():
    rng = np.random.default_rng(3)
    for kind in (np.float32, np.float64):
        a = nn.Tile(np.arange(7), rng.normal(size=(7, 5)).astype(kind))
        b = nn.Tile.unpacked(a.packed(), 5, kind)
        assert all((getattr(a, n) == getattr(b, n)).all() for n in nn.PARTS)


def test_best_of_each_row():
    row, score = np.array([1, 0, 1, 1, 1, 0]), np.array([0.5, 0.1, 0.9, 0.9, 0.7, 0.1])
    got = nn.best(row, score, np.array([4, 9, 8, 3, 4, 2]), 2)
    assert list(zip(*got)) == [(0, 0.1, 2), (0, 0.1, 9), (1, 0.9, 3), (1, 0.9, 8)]


def test_many_copies(spark, monkeypatch):
    monkeypatch.setattr(nn, "PAIRS", 100)  # pairs are recomputed in several parts
    rows = [(i, [1.0, 2.0, 0.5], 0, 0) for i in range(900)] + [(900, [1.0, -1.0, 0.0], 0, 0)]
    assert run(spark, rows, every=300) == brute([r[:2] for r in rows], 300)


def test_floats(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {}
    for r in nn.nearest(df, every=10).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == brute(rows, 10)


def test_few_rows(spark):
    assert run(spark, []) == {}
    assert run(spark, [(0, [1.0, 0.0], 0, 0), (1, [1.0, 1.0], 0, 0)]) == {0: [1]}
    assert run(spark, [(1, [1.0, 0.0], 0, 0), (2, [1.0, 1.0], 0, 0)]) == {}
