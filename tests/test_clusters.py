import hashlib
import math

import numpy as np
import pytest

from gristmill.functions import vectors
from gristmill.operators import cluster, layout, lloyd

SCHEMA = "id long, bucket string, embedding array<double>, cluster_size string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "z") for r in rows], SCHEMA)


def blobs(n, k=5, dim=6, seed=1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(k, dim)) * 3
    return [(i, "ab"[i % 2], (middle[i % k] + rng.normal(size=dim)).tolist()) for i in range(n)]


def far(x, c):
    return ((x[:, None] - c[None]) ** 2).sum(2)


def place(seed, key, prefix=""):
    return int(hashlib.md5(f"{prefix}{seed}|{key}".encode()).hexdigest()[:15], 16)


def start(rows, k, seed):
    first = {}
    for i, _, x in rows:
        first[tuple(x)] = min(first.get(tuple(x), 1 << 62), place(seed, i))
    return np.array(sorted(first, key=lambda x: first[x])[:k])


def rounds(x, c, max_iter=100, tol=1e-4):
    """Lloyd's rounds in plain numpy; empty clusters take the farthest distinct vectors."""
    for _ in range(max_iter):
        d = far(x, c)
        label, new = d.argmin(1), c.copy()
        empty = [k for k in range(len(c)) if not (label == k).any()]
        for k in set(range(len(c))) - set(empty):
            new[k] = x[label == k].mean(0)
        rest = sorted({(-v, tuple(p)) for v, p in zip(d.min(1).tolist(), x.tolist(), strict=True)})
        for k, (_, p) in zip(empty, rest, strict=False):
            new[k] = p
        shift = np.sqrt(((new - c) ** 2).sum(1)).mean()
        c = new
        if shift < tol:
            break
    return c


def best(rows, k, seeds=(1, 2, 3)):
    x = np.array([r[2] for r in rows])
    found = [rounds(x, start(rows, k, s)) for s in seeds]
    c = min(found, key=lambda c: far(x, c).min(1).sum())
    return {r[0]: int(label) for r, label in zip(rows, far(x, c).argmin(1), strict=True)}


@pytest.mark.parametrize("k,dim", [(1, 3), (7, 3), (300, 4), (900, 2)])
def test_pruned_assignment_equals_all_distances(k, dim):
    rng = np.random.default_rng(k)
    c, x = rng.normal(size=(k, dim)), rng.normal(size=(3000, dim))
    c[k // 2] = c[0]  # a tie goes to the smaller label
    x[:50] = c[rng.integers(0, k, 50)]
    label, d = lloyd.Middles(c).nearest(x)
    want = far(x, c)
    assert (label == want.argmin(1)).all() and np.allclose(d, want.min(1), rtol=1e-12, atol=1e-15)
    same = np.full((4, dim), 2.0)
    assert lloyd.Middles(np.full((100, dim), 2.0)).nearest(same)[0].tolist() == [0] * 4


def test_buckets_in_one_pass_equal_plain_rounds(spark):
    rows = blobs(300)
    want = best([r for r in rows if r[1] == "a"], 4) | best([r for r in rows if r[1] == "b"], 3)
    for parts in (1, 7):
        got = cluster.clustered(frame(spark, rows).repartition(parts).drop("cluster_size"), "bucket", {"a": 4}, 3, key="id").collect()
        assert {r.id: r.cluster_id for r in got} == want
        sizes = {(r.bucket, r.cluster_id): r.cluster_size for r in got}
        assert sum(sizes.values()) == 300


def test_empty_clusters_take_the_farthest_vectors(spark):
    rows = [(i, "a", r[2]) for i, r in enumerate(blobs(120))] + [(500, "a", [40.0] * 6), (501, "a", [40.0] * 6)]
    x = np.array([r[2] for r in rows])
    books = np.vstack([x[:3], np.full((2, 6), 1e4), x[3:5]])
    fit = lloyd.Fit(frame(spark, rows), "bucket", "embedding", "id")
    got = fit.lloyd({0: books.copy()}, 100, 1e-4)[0]
    assert np.allclose(got, rounds(x, books), atol=1e-6) and len(np.unique(far(x, got).argmin(1))) == 7


def test_odd_rows(spark):
    rows = [(1, "a", [1.0, 0.0]), (2, "a", [1.0, 0.0]), (3, "a", None), (4, "a", [float("nan"), 0.0]), (5, None, [0.0, 1.0]), (6, None, [0.0, 1.5]), (7, "a", []), (8, "a", [1.0, 2.0, 3.0]), (9, "a", [5.0, 5.0]), (None, "a", [5.0, 5.1])]
    got = {r.id: r.cluster_id for r in lloyd.fitted(frame(spark, rows), "bucket", {"a": 5}, 1, key="id").collect()}
    assert got[1] == got[2] and got[3] is got[4] is got[7] is got[8] is None and got[5] == got[6] == 0 and len({got[1], got[9], got[None]}) == 3
    assert lloyd.fitted(frame(spark, []), "bucket", {}, key="id").collect() == []
    assert cluster.kmeans(frame(spark, rows[:2]), 3).select("cluster_id").distinct().count() == 1


def test_many_centroids_in_bounded_memory(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 8))
    rows = [(i, "a", v) for i, v in enumerate(x.tolist())]
    got = lloyd.fitted(frame(spark, rows), "bucket", {"a": 1200}, key="id", seeds=(1,), max_iter=2).collect()
    c = rounds(x, start(rows, 1200, 1), 2)
    assert {r.id: r.cluster_id for r in got} == dict(enumerate(far(x, c).argmin(1).tolist()))
    monkeypatch.setattr(lloyd, "CENTROIDS", 1000)
    with pytest.raises(ValueError):
        lloyd.fitted(frame(spark, rows), "bucket", {"a": 1200}, key="id")


def batches(rows, k, size, epochs, seed, ratio, patience):
    """Mini-batches in plain numpy."""
    x, c = np.array([r[2] for r in rows]), start(rows, k, seed)
    slots = max(1, -(-len(rows) // size))
    slot = np.array([place(seed, r[0], "slot|") % slots for r in rows])
    given, smooth, low, idle, share = np.zeros(len(c)), None, math.inf, 0, min(1.0, 2.0 * size / (len(rows) + 1))
    for step in range(slots * epochs):
        b = x[slot == step % slots]
        if not len(b):
            continue
        d, before = far(b, c), c.copy()
        label = d.argmin(1)
        n = np.bincount(label, minlength=len(c))
        given += n
        for j in np.flatnonzero(n):
            c[j] += (b[label == j].sum(0) - n[j] * c[j]) / given[j]
        few = np.flatnonzero(given < ratio * given.max())
        few = few[np.argsort(given[few], kind="stable")][: max(1, len(b) // 2)]
        if len(few):
            far_first = sorted({(-v, tuple(p)) for v, p in zip(far(b, before).min(1).tolist(), b.tolist(), strict=True)})[: len(few)]
            at = few[: len(far_first)]
            c[at] = [p for _, p in far_first]
            others = np.delete(given, at)
            given[at] = others.min() if len(others) else 1
        part = d.min(1).sum() / len(b)
        smooth = part if smooth is None else smooth * (1 - share) + part * share
        low, idle = (smooth, 0) if smooth < low else (low, idle + 1)
        if idle >= patience:
            break
    return c


def test_minibatches_equal_a_plain_version(spark):
    rows = [(i, "a", x) for i, _, x in blobs(400, k=8)]
    x = np.array([r[2] for r in rows])
    fit = lloyd.Fit(frame(spark, rows).repartition(3), "bucket", "embedding", "id")
    for ratio, patience in ((0.01, 10), (0.4, 2)):
        got = fit.minibatch(fit.start({0: 8}, 2), 90, 3, 2, ratio, patience)[0]
        assert np.allclose(got, batches(rows, 8, 90, 3, 2, ratio, patience), atol=1e-6)
    cost = lambda c: far(x, c).min(1).sum()
    mini = min(cost(batches(rows, 8, 90, 6, s, 0.01, 10)) for s in (1, 2, 3))
    assert mini <= 1.05 * min(cost(rounds(x, start(rows, 8, s))) for s in (1, 2, 3))


def test_graph_equals_brute_force(spark, monkeypatch):
    rows = [(i, "a", x) for i, _, x in blobs(150)]
    rows += [(200 + i, "a", rows[3][2]) for i in range(12)] + [(300, "a", None), (301, "a", [1.0]), (302, "a", [float("inf")] * 6), (None, "a", rows[0][2]), (7, "a", rows[7][2])]
    x = {i: np.array(v) for i, _, v in rows if i is not None and v is not None and len(v) == 6 and np.isfinite(v).all()}
    want = {}
    for i, v in x.items():
        near = sorted((float(((v - w) ** 2).sum()), j) for j, w in x.items() if j != i)[:5]
        want |= {(i, n + 1): (j, round(math.sqrt(d), 9)) for n, (d, j) in enumerate(near)}
    for block in (1 << 21, 40):
        monkeypatch.setattr(layout, "BLOCK", block)
        got = layout.graph(frame(spark, rows), "id", k=5).collect()
        assert {(r.id, r.rank): (r.other, round(r.distance, 9)) for r in got} == want
    few = layout.graph(frame(spark, rows[:3]), "id", k=5).collect()
    assert len(few) == 6 and layout.graph(frame(spark, []), "id").collect() == []


def test_bandwidths_reach_their_sum():
    rng = np.random.default_rng(2)
    d = np.sort(rng.uniform(0.5, 3, (40, 15)), 1)
    nearest, width = layout.bandwidths(d, d.mean())
    assert np.allclose(np.exp(-np.maximum(d - nearest[:, None], 0) / width[:, None]).sum(1), math.log2(15), atol=1e-6)
    nearest, width = layout.bandwidths(np.zeros((1, 4)), 2.0)  # copies alone: the least share of the mean
    assert nearest[0] == 0 and width[0] == 2.0 * layout.LEAST


def test_layout_keeps_more_neighbours_than_axes(spark):
    rng = np.random.default_rng(6)
    turn = rng.uniform(0, 6.28, 240)[:, None] * np.arange(1, 11)  # a curve that main axes fold onto itself
    x = np.hstack([np.cos(turn), np.sin(turn)]) + 0.05 * rng.normal(size=(240, 20))
    df = frame(spark, [(i, "a", v) for i, v in enumerate(x.tolist())])
    high = layout.graph(df, "id", k=10)
    keeps = lambda p: layout.kept_neighbours(high, layout.graph(p.withColumn("at", lloyd.F.array("x", "y")), "id", "at", k=10)).first()["share"]
    made = layout.laid_out(df, "id", epochs=60)
    assert keeps(made) > 1.2 * keeps(cluster.projected(df, "id"))
    again = layout.laid_out(df.repartition(5), "id", epochs=60)
    assert sorted(made.collect()) == sorted(again.collect())


def test_layout_of_few_rows(spark):
    df = frame(spark, [(1, "a", [1.0, 2.0]), (2, "a", [1.0, 2.0]), (3, "a", None)])
    assert sorted(r.id for r in layout.laid_out(df, "id", epochs=10).collect()) == [1, 2]
    assert len(layout.laid_out(df.where("id = 1"), "id").collect()) == 1 and layout.laid_out(df.where("id = 3"), "id").collect() == []


def test_a_second_rounding_goes_by_the_number(spark):
    ends_in_5 = [1.00185, 1.00395, 1.02005, 1.00595, 0.5, 1.00186, -1.00395]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in ends_in_5], "x double").select(vectors.rounded(lloyd.F.col("x"), 4)).collect()]
    assert got == [1.0018, 1.0039, 1.02, 1.0059, 0.5, 1.0019, -1.0039]


def jobs(spark, made):
    """The result of a call and the number of jobs that it took."""
    spark.sparkContext.setJobGroup(made.__name__, "")
    out = made()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return out, len(spark.sparkContext.statusTracker().getJobIdsForGroup(made.__name__))


def test_small_batches_share_jobs(spark, monkeypatch):
    """Batches of a run are worked on within one job; before, each took several."""
    rows = [(i, "ab"[i % 2], x) for i, _, x in blobs(400, k=8)]
    fit = lloyd.Fit(frame(spark, rows).repartition(3), "bucket", "embedding", "id")
    first = fit.start({0: 5, 1: 4}, 2)

    def in_runs():
        return fit.minibatch(first, 40, 2, 2, 0.2, 1000)

    got, n = jobs(spark, in_runs)
    assert n <= 12  # 20 batches
    monkeypatch.setattr(lloyd, "RUN", 0)
    apart = fit.minibatch(first, 40, 2, 2, 0.2, 1000)
    assert all(np.array_equal(got[b], apart[b]) for b in (0, 1))


def test_seeds_share_passes(spark):
    """The rounds of several seeds are those of each alone, in as many passes as the longest takes."""
    rows = [(i, "ab"[i % 2], x) for i, _, x in blobs(300, k=8)]
    fit = lloyd.Fit(frame(spark, rows).repartition(3), "bucket", "embedding", "id")
    starts = [fit.start({0: 4, 1: 5}, s) for s in (1, 2, 3)]
    alone = [fit.lloyd(c, 30, 1e-4) for c in starts]
    books = fit.lloyd({n * fit.buckets + b: c for n, s in enumerate(starts) for b, c in s.items()}, 30, 1e-4)
    assert all(np.array_equal(books[n * fit.buckets + b], c) for n, own in enumerate(alone) for b, c in own.items())
    cost = fit.inertia(books)
    assert all(cost[n * fit.buckets + b] == c for n, own in enumerate(alone) for b, c in fit.inertia(own).items())


def test_graphs_take_all_rows_or_say_so(spark, monkeypatch):
    """A sample has its limit; all rows are never cut to it."""
    rows = frame(spark, [(i, "a", x) for i, _, x in blobs(120)])
    monkeypatch.setattr(layout, "POINTS", 50)
    assert layout.graph(rows, "id", k=3).select("id").distinct().count() == 50
    assert layout.graph(rows, "id", k=3, rows=None).select("id").distinct().count() == 120
    assert layout.laid_out(rows, "id", rows=None, epochs=2).count() == 120
    monkeypatch.setattr(layout, "NUMBERS", 500)
    with pytest.raises(ValueError):
        layout.graph(rows, "id", rows=None)


def test_graph_of_all_has_no_limit(spark, monkeypatch):
    """Tables of many parts, beyond what a sample may have: each row and tie as by brute force."""
    from gristmill.operators import nearest

    monkeypatch.setattr(layout, "NUMBERS", 500)
    for name, value in (("CELL", 20), ("LEAST", 40), ("BLOCK", 16), ("NUMBERS", 300)):
        monkeypatch.setattr(nearest, name, value)
    rows = [(i, "a", x) for i, _, x in blobs(150)]
    rows += [(200 + i, "a", rows[3][2]) for i in range(60)] + [(300 + i, "a", [float(i % 3), float(i % 5), 9.0, 9.0, 9.0, 9.0]) for i in range(90)]
    rows += [(400, "a", None), (401, "a", [1.0]), (402, "a", [float("inf")] * 6), (None, "a", rows[0][2]), (7, "a", rows[7][2])]
    x = {i: np.array(v) for i, _, v in rows if i is not None and v is not None and len(v) == 6 and np.isfinite(v).all()}
    want = {}
    for i, v in x.items():
        near = sorted((math.sqrt(sum((v - w) ** 2)), j) for j, w in x.items() if j != i)[:5]
        want |= {(i, n + 1): (j, d) for n, (d, j) in enumerate(near)}
    df = frame(spark, rows)
    assert {(r.id, r["rank"]): (r.other, r.distance) for r in layout.graph_of_all(df, "id", k=5).collect()} == want
    named = df.withColumn("id", lloyd.F.format_string("%03d", "id"))  # keys that are no numbers
    assert {(int(r.id), r["rank"]): int(r.other) for r in layout.graph_of_all(named.where("id <> 'null'"), "id", k=5).collect()} == {a: b for a, (b, _) in want.items()}
    assert len(layout.graph_of_all(frame(spark, rows[:3]), "id", k=5).collect()) == 6 and layout.graph_of_all(frame(spark, []), "id").collect() == []


def test_fuzzy_of_all_has_no_limit(spark, monkeypatch):
    rows = frame(spark, [(i, "a", x) for i, _, x in blobs(150)])
    want = {(r.id, r.other): r.weight for r in layout.fuzzy(rows, "id", k=5).collect()}
    monkeypatch.setattr(layout, "NUMBERS", 500)
    got = {(r.id, r.other): r.weight for r in layout.fuzzy_of_all(rows, "id", k=5).collect()}
    assert got.keys() == want.keys() and all(abs(w - want[e]) < 1e-9 for e, w in got.items())


def test_layout_of_all_keeps_neighbours_beyond_the_limit(spark, monkeypatch):
    """The curve that main axes fold, with more numbers than a sample may have; the same from other partitions."""
    monkeypatch.setattr(layout, "NUMBERS", 500)
    rng = np.random.default_rng(6)
    turn = rng.uniform(0, 6.28, 240)[:, None] * np.arange(1, 11)
    x = np.hstack([np.cos(turn), np.sin(turn)]) + 0.05 * rng.normal(size=(240, 20))
    df = frame(spark, [(3 * i, "a", v) for i, v in enumerate(x.tolist())])
    high = layout.graph_of_all(df, "id", k=10)
    keeps = lambda p: layout.kept_neighbours(high, layout.graph_of_all(p.withColumn("at", lloyd.F.array("x", "y")), "id", "at", k=10)).first()["share"]
    made = layout.layout_of_all(df, "id", epochs=60, directed=high)
    assert keeps(made) > 1.2 * keeps(cluster.projected(df, "id"))
    assert sorted(made.collect()) == sorted(layout.layout_of_all(df.repartition(5), "id", epochs=60, k=10).collect())
    assert layout.layout_of_all(df.where("id < 0"), "id").collect() == [] and len(layout.layout_of_all(df.where("id = 3"), "id").collect()) == 1
    with pytest.raises(ValueError):  # positions, not vectors
        layout.layout_of_all(df.union(df.withColumn("id", lloyd.F.col("id") + 1)), "id")
