import hashlib

import numpy as np

from gristmill.llm import vectorcodes as vc


def brute(rows, entries=256, rounds=4, parts=4):
    """(id, label, vector) rows; plain loops over Python integers."""
    fine = [r for r in rows if r[2] is not None and len(r[2]) and len(r[2]) % parts == 0 and all(v is not None and np.isfinite(v) for v in r[2])]
    kept = sorted(((r[0], r[1], [int(np.floor(1024 * v)) for v in r[2]]) for r in fine), key=lambda r: (r[0] is None, r[0] or 0, r[2]))
    if not kept:
        return []
    size = len(kept[0][2]) // parts
    cut = lambda x, p: x[p * size : (p + 1) * size]
    books = [[cut(r[2], p) for r in kept[:entries]] for p in range(parts)]
    far = lambda a, b: sum((s - t) ** 2 for s, t in zip(a, b, strict=True))
    best = lambda x, book: min((far(x, e), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            own = [(best(cut(r[2], p), books[p])[1], cut(r[2], p)) for r in kept]
            for k in range(len(books[p])):
                mine = [x for at, x in own if at == k]
                if mine:
                    books[p][k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    h = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    out, sums = [], {}
    for i, label, x in kept:
        found = [best(cut(x, p), books[p]) for p in range(parts)]
        out.append((i, label, "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found)))
        sums[label] = sums.get(label, 0) + out[-1][3]
    return sorted(map(repr, ((i, code, error, sums[label], h) for i, label, code, error in out)))


def run(spark, rows, **kw):
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, label int, embedding array<float>, code string, _salt int")
    return sorted(repr(tuple(r)) for r in vc.encoded(frame, **kw).collect())


def made(n, dim=16, seed=1):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(20, dim))
    return [(i, int(i % 3) if i % 7 else None, np.float32(middle[i % 20] * (1 + i % 3) + 0.2 * rng.normal(size=dim)).tolist()) for i in range(n)]


def test_equals_plain_loops(spark):
    rows = made(400)
    rows += [(9, 1, rows[9][2]), (9, 2, rows[10][2]), (None, None, rows[3][2]), (500, 1, None), (501, 1, [float("nan")] * 16), (502, 1, [float("inf")] * 16), (503, 1, [None] * 16), (504, 1, []), (505, 0, [0.0] * 16), (506, 0, [-0.0001] * 16)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, entries=7) == brute(rows, entries=7)
    assert run(spark, rows[:5]) == brute(rows[:5])


def test_copies_ties_and_unused_entries(spark):
    rows = [(i, 0, [float(i // 4)] * 8) for i in range(40)] + [(100 + i, 1, [0.0] * 8) for i in range(30)]
    assert run(spark, rows, entries=16) == brute(rows, entries=16)


def test_lengths_and_none(spark):
    rows = [*made(20, 8), (100, 1, [1.0] * 12), (101, 1, [1.0] * 6)]
    assert run(spark, rows) == brute(rows[:20])
    assert run(spark, []) == [] and run(spark, [(1, 1, None)]) == []


def test_many_labels_by_a_shuffle(spark, monkeypatch):
    rows = made(60)
    monkeypatch.setattr(vc, "LABELS", 1)
    assert run(spark, rows) == brute(rows)


def test_large_numbers_stay_in_bounds(spark):
    rows = [(i, 0, [3e38 if i % 2 else -3e38] * 8) for i in range(4)]
    got = vc.encoded(spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>"), entries=1).collect()
    assert len(got) == 4 and all(0 <= r.error < 1 << 63 for r in got)


def test_annulus_equals_all_entries():
    rng = np.random.default_rng(5)
    for dim, scale in ((1, 50), (4, 3), (16, 900)):
        for n in (1, 5, 256):
            entries, x = rng.integers(-scale, scale, (n, dim)), rng.integers(-scale, scale, (500, dim))
            entries[n // 2] = entries[0]
            all_of = ((x[:, None] - entries[None]) ** 2).sum(2)
            index, far = vc.assigned(x, entries)
            assert (index == all_of.argmin(1)).all() and (far == all_of.min(1)).all()
