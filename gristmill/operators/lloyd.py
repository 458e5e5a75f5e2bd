"""k-means by exact Lloyd rounds, and by seeded mini-batches; all buckets in one pass.

The start is Forgy's: of each bucket the first k distinct vectors in a seeded hash order. A round is one pass over
the rows: tasks hold the centroids of all buckets, assign their rows and send one partial sum for each
centroid that they used; partial sums meet by centroid. Sums are of fixed-point numbers, so they don't depend
on how rows are dealt, and a run is the same in every session.

Most centroids are never compared with a row. They are grouped around a root's number of pivots; by the
triangle inequality a group whose pivot is farther than the best distance so far and the group's radius can't hold a
nearer centroid. What is left is compared by matrix products with a bound on their error, and whatever may be
nearest within that bound is computed again from differences, so labels don't depend on blocks or pruning.

The driver and each task hold k * dimension numbers for all buckets together: at most CENTROIDS of them, or it is an error.

Defined cases: rows whose vector is null, empty, or holds null or NaN or infinity take no part in the fit and
have a null label, and so have those of another length than the first by order; k is at most the number of distinct vectors of a bucket; a null
bucket is a bucket; ties go to the smaller label; an empty table stays empty.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.sources.stores import discard, saved

#: Numbers of all centroids together at most, which the driver and every task hold.
CENTROIDS = 1 << 26
#: Bits of the fixed-point numbers that are summed.
BITS = 30
#: Rows compared at a time, and numbers of a block of distances.
ROWS, BLOCK = 4096, 1 << 21
#: Numbers of the mini-batches that one task works on in order.
RUN = 1 << 22
#: Fewer centroids are one group.
GROUPED = 64


class Middles:
    """Centroids of one bucket, grouped around pivots."""

    def __init__(self, c: np.ndarray):
        self.c = np.asarray(c, np.float64)
        self.square = (self.c * self.c).sum(1)
        k = len(self.c)
        pivots, near = [0], ((self.c - self.c[0]) ** 2).sum(1)
        group = np.zeros(k, np.int64)
        for _ in range(math.isqrt(k) - 1 if k >= GROUPED else 0):
            far = int(near.argmax())
            if near[far] == 0:
                break
            d = ((self.c - self.c[far]) ** 2).sum(1)
            group[d < near] = len(pivots)
            near = np.minimum(near, d)
            pivots.append(far)
        self.pivots = self.c[pivots]
        self.members = [np.flatnonzero(group == g) for g in range(len(pivots))]
        self.radius = np.array([math.sqrt(near[m].max()) for m in self.members])

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Label and squared distance of each row's nearest centroid."""
        label, best = np.zeros(len(x), np.int64), np.full(len(x), np.inf)
        for lo in range(0, len(x), ROWS):
            part = slice(lo, lo + ROWS)
            label[part], best[part] = self._part(np.asarray(x[part], np.float64))
        return label, best

    def _part(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own = (x * x).sum(1)
        slack = 8.0 * (x.shape[1] + 4) * np.finfo(float).eps * (own + self.square.max()) + 1e-300
        label, best = np.full(len(x), len(self.c)), np.full(len(x), np.inf)
        if len(self.members) == 1:
            self._meet(x, own, slack, np.arange(len(x)), self.members[0], label, best)
            return label, best
        far = np.sqrt(np.maximum(own[:, None] - 2 * (x @ self.pivots.T) + (self.pivots**2).sum(1), 0))
        home = far.argmin(1)
        for g, members in enumerate(self.members):
            self._meet(x, own, slack, np.flatnonzero(home == g), members, label, best)
        wide = np.sqrt(slack)
        for g, members in enumerate(self.members):
            least = np.maximum(far[:, g] - wide - self.radius[g], 0.0)
            self._meet(x, own, slack, np.flatnonzero((home != g) & (least * least * (1 - 1e-9) <= best + slack)), members, label, best)
        return label, best

    def _meet(self, x: np.ndarray, own: np.ndarray, slack: np.ndarray, rows: np.ndarray, members: np.ndarray, label: np.ndarray, best: np.ndarray) -> None:
        """Let some rows meet some centroids; label and best change in place."""
        step = max(1, BLOCK // len(members))
        for lo in range(0, len(rows), step):
            r = rows[lo : lo + step]
            near = own[r, None] - 2 * (x[r] @ self.c[members].T) + self.square[members]
            limit = np.minimum(near.min(1), best[r]) + 2 * slack[r]
            i, j = np.nonzero(near <= limit[:, None])
            if not len(i):
                continue
            d = ((x[r[i]] - self.c[members[j]]) ** 2).sum(1)
            order = np.lexsort((members[j], d, i))
            i, j, d = i[order], j[order], d[order]
            first = np.ones(len(i), bool)
            first[1:] = i[1:] != i[:-1]
            at, d, found = r[i[first]], d[first], members[j[first]]
            better = (d < best[at]) | ((d == best[at]) & (found < label[at]))
            best[at[better]], label[at[better]] = d[better], found[better]


def fixed(x: np.ndarray, scale: float) -> np.ndarray:
    return np.floor(x * scale + 0.5).astype(np.int64)


def batches_of(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, vectors) of each bucket of each batch; of packed ones, of each block."""
    for batch in batches:
        bucket = batch["_bucket"].to_numpy()
        if pa.types.is_list(batch["_x"].type) or pa.types.is_large_list(batch["_x"].type):
            for b in np.unique(bucket).tolist():
                yield b, batch.filter(pa.array(bucket == b))["_x"].flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
        else:
            for b, block in zip(bucket.tolist(), batch["_x"], strict=True):
                yield b, np.frombuffer(block.as_buffer(), np.float64).reshape(-1, dim)


def _pack(dim: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Blocks of vectors as bytes, which rounds read without taking lists apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, x in batches_of(batches, dim):
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.int32()), pa.array([x.tobytes()], pa.binary())], ["_bucket", "_x"])

    return run


PARTIAL = "_bucket int, label int, n long, total array<long>"


def lists(x: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, x.shape[1]), pa.int32()), pa.array(x.ravel()))


def of_bucket(books: dict[int, np.ndarray], buckets: int) -> dict[int, list[int]]:
    """The books of each bucket; book and bucket are equal modulo the number of buckets."""
    out: dict[int, list[int]] = {}
    for n in books:
        out.setdefault(n % buckets, []).append(n)
    return out


def add_at(sums: np.ndarray, label: np.ndarray, x: np.ndarray) -> None:
    """Add whole numbers to the sums of their labels."""
    if len(sums) <= GROUPED:
        for n in np.unique(label).tolist():
            sums[n] += x[label == n].sum(0)
    else:
        np.add.at(sums, label, x)


def _sums(books: dict[int, np.ndarray], dim: int, scale: float, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's partial sum of each centroid that it used."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, middles, sums, count = of_bucket(books, buckets), {}, {}, {}
        for bucket, x in batches_of(batches, dim):
            whole = fixed(x, scale)
            for b in own.get(bucket, ()):
                if b not in middles:
                    middles[b] = Middles(books[b])
                    sums[b], count[b] = np.zeros(books[b].shape, np.int64), np.zeros(len(books[b]), np.int64)
                label, _ = middles[b].nearest(x)
                add_at(sums[b], label, whole)
                count[b] += np.bincount(label, minlength=len(count[b]))
        for b, n in count.items():
            at = np.flatnonzero(n)
            for lo in range(0, len(at), ROWS):
                k = at[lo : lo + ROWS]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k), b, np.int32)), pa.array(k.astype(np.int32)), pa.array(n[k]), lists(sums[b][k])], ["_bucket", "label", "n", "total"])

    return run


def _merge(dim: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Totals of each centroid from its partial sums, which lie together; in two halves, so that 64 bits never overflow."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n, high, low = None, 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)

        def found() -> pa.RecordBatch:
            total = high.astype(np.float64) * float(1 << 32) + low
            return pa.RecordBatch.from_arrays([pa.array([last[0]], pa.int32()), pa.array([last[1]], pa.int32()), pa.array([n], pa.int64()), lists(total[None])], ["_bucket", "label", "n", "total"])

        for batch in batches:
            keys = list(zip(batch["_bucket"].to_pylist(), batch["label"].to_pylist(), strict=True))
            totals = batch["total"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
            for r, key in enumerate(keys):
                if key != last:
                    if last is not None:
                        yield found()
                    last, n, high, low = key, 0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)
                n += batch["n"][r].as_py()
                high += totals[r] >> 32
                low += totals[r] & 0xFFFFFFFF
        if last is not None:
            yield found()

    return run


def _inertia(books: dict[int, np.ndarray], dim: int, scale: float, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Squared distances summed as fixed-point numbers of units of 1/scale each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, middles, sums = of_bucket(books, buckets), {}, {}
        for bucket, x in batches_of(batches, dim):
            for b in own.get(bucket, ()):
                if b not in middles:
                    middles[b] = Middles(books[b])
                sums[b] = sums.get(b, 0) + int(np.floor(middles[b].nearest(x)[1] * scale).astype(np.int64).sum())
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(list(sums.values()), pa.int64())], ["_bucket", "total"])

    return run


def farthest(far: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The n farthest distinct vectors, ties to the smaller one."""
    rows, at = np.unique(rows, axis=0, return_index=True)
    top = np.argsort(-far[at], kind="stable")[:n]
    return far[at][top], rows[top]


def _farthest(books: dict[int, np.ndarray], want: dict[int, int], dim: int, buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of each bucket the distinct vectors that are farthest from their centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, middles, have = of_bucket(want, buckets), {}, {}
        for bucket, x in batches_of(batches, dim):
            for b in own.get(bucket, ()):
                if b not in middles:
                    middles[b] = Middles(books[b])
                    have[b] = (np.zeros(0), np.zeros((0, dim)))
                far, rows = (np.concatenate(p) for p in zip(have[b], (middles[b].nearest(x)[1], x), strict=True))
                have[b] = farthest(far, rows, want[b])
        for b, (far, rows) in have.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(far), b, np.int32)), pa.array(far), lists(rows)], ["_bucket", "far", "x"])

    return run


def totals(rows: DataFrame, books: dict[int, np.ndarray], dim: int, scale: float, buckets: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each book the number of rows of each centroid and their sums in units of 1/scale."""
    partial = rows.select("_bucket", "_x").mapInArrow(_sums(books, dim, scale, buckets), PARTIAL)
    met = partial.repartition("_bucket", "label").sortWithinPartitions("_bucket", "label").mapInArrow(_merge(dim), "_bucket int, label int, n long, total array<double>")
    out = {b: (np.zeros(len(c), np.int64), np.zeros(c.shape)) for b, c in books.items()}
    got = met.toArrow()  # a row for each centroid
    if got.num_rows:
        bucket, label, n = (got[c].to_numpy() for c in ("_bucket", "label", "n"))
        total = got["total"].combine_chunks().flatten().to_numpy().reshape(-1, dim)
        for b in np.unique(bucket).tolist():
            at = bucket == b
            out[b][0][label[at]], out[b][1][label[at]] = n[at], total[at]
    return out


def _reseed(rows: DataFrame, books: dict[int, np.ndarray], empty: dict[int, np.ndarray], dim: int, buckets: int) -> dict[int, np.ndarray]:
    """New centroids for the empty ones: the vectors farthest from their centroid, each once."""
    want = {b: len(e) for b, e in empty.items()}
    far = saved(rows.where(F.col("_bucket").isin(sorted({b % buckets for b in want}))).select("_bucket", "_x").mapInArrow(_farthest(books, want, dim, buckets), "_bucket int, far double, x array<double>"))
    once, out = far.groupBy("_bucket", "x").agg(F.max("far").alias("far")), {}
    for b, n in want.items():
        out[b] = np.array([r["x"] for r in once.where(F.col("_bucket") == b).orderBy(F.desc("far"), "x").limit(n).collect()])
    discard(far)
    return out


class Batches:
    """Where seeded mini-batches have come to: centroids, the rows they were given, and the smoothed inertia."""

    def __init__(self, books: dict[int, np.ndarray], share: float, ratio: float, patience: int):
        self.books, self.given = books, {b: np.zeros(len(c)) for b, c in books.items()}
        self.share, self.ratio, self.patience = share, ratio, patience
        self.smooth, self.low, self.idle = None, math.inf, 0

    def moved(self, sums: dict[int, tuple[np.ndarray, np.ndarray]], scale: float) -> dict[int, np.ndarray]:
        """Move centroids by a batch's sums; those that are given too few rows, of each bucket."""
        for b, (c, t) in sums.items():
            hit = c > 0
            self.given[b] += c
            self.books[b][hit] += (t[hit] / scale - c[hit, None] * self.books[b][hit]) / self.given[b][hit, None]
        few = {b: np.flatnonzero(g < self.ratio * g.max()) for b, g in self.given.items()}
        rows = {b: int(sums[b][0].sum()) if b in sums else 0 for b in few}
        return {b: at[np.argsort(self.given[b][at], kind="stable")][: max(1, rows[b] // 2)] for b, at in few.items() if len(at) and rows[b]}

    def reseeded(self, far: dict[int, np.ndarray], few: dict[int, np.ndarray]) -> None:
        """Put them on a batch's farthest vectors."""
        for b, x in far.items():
            at = few[b][: len(x)]
            self.books[b][at] = x
            others = np.delete(self.given[b], at)
            self.given[b][at] = others.min() if len(others) else 1

    def cost(self, inertia: float, rows: int) -> None:
        part = inertia / rows
        self.smooth = part if self.smooth is None else self.smooth * (1 - self.share) + part * self.share
        self.low, self.idle = (self.smooth, 0) if self.smooth < self.low else (self.low, self.idle + 1)


def _batches(state: Batches, dim: int, scale: float, unit: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The batches of a run in order, with the numbers that ``totals``, ``_reseed`` and ``_inertia`` have for each."""

    def step(slot: dict[int, list[np.ndarray]]) -> None:
        x = {b: np.concatenate(parts) for b, parts in slot.items()}
        met = {b: Middles(state.books[b]).nearest(v) for b, v in x.items()}
        sums = {}
        for b, v in x.items():
            total = np.zeros(state.books[b].shape, np.int64)
            add_at(total, met[b][0], fixed(v, scale))
            sums[b] = np.bincount(met[b][0], minlength=len(total)), total.astype(np.float64)
        few = state.moved(sums, scale)
        state.reseeded({b: farthest(met[b][1], x[b], len(at))[1] for b, at in few.items()}, few)
        cost = sum(int(np.floor(far * unit).astype(np.int64).sum()) for _, far in met.values())
        state.cost(cost / unit, sum(map(len, x.values())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, slot = None, {}
        for batch in batches:
            number = batch["_slot"].to_numpy()
            for n in np.unique(number).tolist():
                if n != last and slot and state.idle < state.patience:
                    step(slot)
                last, slot = n, slot if n == last else {}
                for b, x in batches_of([batch.filter(pa.array(number == n))], dim):
                    slot.setdefault(b, []).append(x)
        if not slot:
            return
        if state.idle < state.patience:
            step(slot)
        for b, c in state.books.items():
            for lo in range(0, len(c), ROWS):
                x = c[lo : lo + ROWS]
                same = [pa.array([v] * len(x), kind) for v, kind in ((state.smooth, pa.float64()), (state.low, pa.float64()), (state.idle, pa.int32()))]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(x), b, np.int32)), pa.array(np.arange(lo, lo + len(x), dtype=np.int32)), pa.array(state.given[b][lo : lo + ROWS]), lists(x), *same], ["_bucket", "label", "given", "x", "smooth", "low", "idle"])

    return run


class Fit:
    """Rows made ready: buckets by number, vectors as doubles, and the scale of fixed-point numbers."""

    def __init__(self, df: DataFrame, bucket: str, vector: str, key: str | None):
        fine = F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
        own = df.where(fine).select(F.col(bucket).cast("string").alias("_name"), F.transform(vector, lambda v: v.cast("double")).alias("_x"), (F.col(key).cast("string") if key else F.xxhash64(vector).cast("string")).alias("_key"))
        first = own.orderBy(F.col("_key").isNull(), "_key").select(F.size("_x").alias("n")).first()
        self.dim = first["n"] if first else 1
        own = own.where(F.size("_x") == self.dim)
        self.names = sorted((r[0] for r in own.select("_name").distinct().limit(1001).collect()), key=lambda n: (n is None, n or ""))
        if len(self.names) > 1000:
            raise ValueError("more than 1000 buckets; cluster them by a coarser key")
        self.buckets = max(1, len(self.names))
        self.rows = saved(own.select(self.number(F.col("_name")).alias("_bucket"), "_x", "_key"))
        self.blocks = saved(self.rows.select("_bucket", "_x").mapInArrow(_pack(self.dim), "_bucket int, _x binary"))
        self.max = self.rows.agg(F.max(F.array_max(F.transform("_x", F.abs)))).first()[0] or 1.0
        self.scale = math.ldexp(1.0, BITS - math.frexp(self.max)[1])
        self.far = 2.0**40 / (4.0 * self.dim * self.max**2)

    def number(self, name: Column) -> Column:
        """The bucket's number by its name."""
        out = F.lit(None).cast("int")
        for n, value in enumerate(self.names):
            out = F.when(name.eqNullSafe(F.lit(value)), F.lit(n)).otherwise(out)
        return out

    def start(self, sizes: dict[int, int], seed: int) -> dict[int, np.ndarray]:
        """The first distinct vectors of each bucket in the order of md5('<seed>|<key>')."""
        place = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce("_key", F.lit("")))), 1, 15), 16, 10).cast("long")
        once = saved(self.rows.groupBy("_bucket", "_x").agg(F.min(place).alias("place")))
        count = {r["_bucket"]: r["n"] for r in once.groupBy("_bucket").agg(F.count("*").alias("n")).collect()}
        out, want = {}, {b: min(max(k, 1), count[b]) for b, k in sizes.items() if b in count}
        if sum(want.values()) * self.dim > CENTROIDS:
            raise ValueError(f"k * dimension of all buckets is over {CENTROIDS}")
        spare = 1.2
        while left := {b: k for b, k in want.items() if b not in out}:
            # places are even, so about so many rows lie below these; where they don't, twice as many are asked for
            below = F.lit(False)
            for b, k in left.items():
                below = below | ((F.col("_bucket") == b) & (F.col("place") <= int(min(1.0, (spare * k + 50) / count[b]) * ((1 << 60) - 1))))
            got: dict[int, list] = {}
            for r in once.where(below).collect():
                got.setdefault(r["_bucket"], []).append((r["place"], r["_x"]))
            for b, k in left.items():
                if len(got.get(b, ())) >= k:
                    out[b] = np.array([x for _, x in sorted(got[b])[:k]], np.float64)
            spare *= 2
        discard(once)
        return out

    def inertia(self, books: dict[int, np.ndarray]) -> dict[int, float]:
        part = self.blocks.mapInArrow(_inertia(books, self.dim, self.far, self.buckets), "_bucket int, total long")
        return {r["_bucket"]: int(r["t"]) / self.far for r in part.groupBy("_bucket").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("t")).collect()}

    def lloyd(self, books: dict[int, np.ndarray], max_iter: int, tol: float) -> dict[int, np.ndarray]:
        """Centroids after rounds until they move by less than ``tol`` in the mean, each book for itself; all books share a pass."""
        books, live = dict(books), set(books)
        for _ in range(max_iter):
            if not live:
                break
            now = {b: books[b] for b in live}
            own = sorted({b % self.buckets for b in live})
            rows = self.blocks if len(own) == self.buckets else self.blocks.where(F.col("_bucket").isin(own))
            sums = totals(rows, now, self.dim, self.scale, self.buckets)
            moved = {b: np.where(n[:, None] > 0, t / (np.maximum(n, 1)[:, None] * self.scale), now[b]) for b, (n, t) in sums.items()}
            empty = {b: np.flatnonzero(n == 0) for b, (n, _) in sums.items() if (n == 0).any()}
            if empty:
                for b, x in _reseed(rows, now, empty, self.dim, self.buckets).items():
                    moved[b][empty[b][: len(x)]] = x
            for b, c in moved.items():
                if np.sqrt(((c - books[b]) ** 2).sum(1)).mean() < tol:
                    live.discard(b)
                books[b] = c
        return books

    def minibatch(self, books: dict[int, np.ndarray], size: int, epochs: int, seed: int, ratio: float, patience: int) -> dict[int, np.ndarray]:
        """Centroids after seeded batches: each moves to the mean of all rows that it was given so far.

        Rows are dealt to batches of about ``size`` by a hash of their key. Small batches are dealt to runs of about RUN
        numbers; a run is one job, whose task works through its batches in order and hands the centroids on. Larger
        batches are spread over all tasks. Either reads only itself. After a batch, centroids that were given under ``ratio`` times the most rows
        are put on the batch's farthest vectors and count as the least of the others. It ends after
        ``epochs`` times all batches, or when ``patience`` batches on end didn't lower the smoothed inertia of a batch.
        """
        n = self.rows.count()
        slots = max(1, -(-n // size))
        per = max(1, RUN // (size * self.dim))
        slot = F.pmod(F.conv(F.substring(F.md5(F.concat(F.lit(f"slot|{seed}|"), F.coalesce("_key", F.lit("")))), 1, 15), 16, 10).cast("long"), F.lit(slots)).cast("int")
        dealt = self.rows.withColumn("_slot", slot).withColumn("_run", F.floor(F.col("_slot") / per).cast("int"))
        dealt = saved(dealt.select("_bucket", "_x", "_slot", "_run").repartition("_run"), "_run")
        state = Batches({b: c.copy() for b, c in books.items()}, min(1.0, 2.0 * size / (n + 1)), ratio, patience)
        for step in range(-(-slots // per) * epochs):
            rows = dealt.where(F.col("_run") == step % -(-slots // per))
            if per > 1:
                state = self._run(rows, state)
            else:
                self._batch(rows.select("_bucket", "_x"), state)
            if state.idle >= patience:
                break
        discard(dealt)
        return state.books

    def _batch(self, rows: DataFrame, state: Batches) -> None:
        """One batch over all tasks."""
        sums = totals(rows, state.books, self.dim, self.scale, self.buckets)
        if any(c.any() for c, _ in sums.values()):
            before = {b: c.copy() for b, c in state.books.items()}
            few = state.moved(sums, self.scale)
            state.reseeded(_reseed(rows, before, few, self.dim, self.buckets) if few else {}, few)
            cost = rows.mapInArrow(_inertia(before, self.dim, self.far, self.buckets), "_bucket int, total long").agg(F.sum("total")).first()[0]
            state.cost(cost / self.far, sum(int(c.sum()) for c, _ in sums.values()))

    def _run(self, rows: DataFrame, state: Batches) -> Batches:
        """The batches of a run one after the other, within a task that gets this run alone."""
        ready = rows.select("_slot", "_bucket", "_x").repartition(1).sortWithinPartitions("_slot", "_bucket")
        got = ready.mapInArrow(_batches(state, self.dim, self.scale, self.far), "_bucket int, label int, given double, x array<double>, smooth double, low double, idle int").toArrow()
        if got.num_rows:  # a row for each centroid
            bucket, label = got["_bucket"].to_numpy(), got["label"].to_numpy()
            x = got["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, self.dim)
            for b in state.books:
                at = np.flatnonzero(bucket == b)
                state.books[b][label[at]], state.given[b][label[at]] = x[at], got["given"].to_numpy()[at]
            state.smooth, state.low, state.idle = (got[c][0].as_py() for c in ("smooth", "low", "idle"))
        return state


def _label(books: dict[int, np.ndarray], dim: int, names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middles: dict[int, Middles] = {}
        for batch in batches:
            bucket, size = batch["_bucket"].fill_null(-1).to_numpy(), batch["_dim"].fill_null(-1).to_numpy()
            label = np.zeros(batch.num_rows, np.int32)
            whole = size == dim
            for b in np.unique(bucket[whole]).tolist():
                if b not in books:
                    whole &= bucket != b
                    continue
                if b not in middles:
                    middles[b] = Middles(books[b])
                at = np.flatnonzero(whole & (bucket == b))
                x = batch["_x"].take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
                label[at] = middles[b].nearest(x)[0]
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), pa.array(label, pa.int32(), mask=~whole)], [*names, "cluster_id"])

    return run


def fitted(df: DataFrame, bucket: str, sizes: dict[str, int], default: int = 1000, vector: str = "embedding", key: str | None = None, seeds: tuple[int, ...] = (1, 2, 3), max_iter: int = 100, tol: float = 1e-4, batch: int | None = None, epochs: int = 3, ratio: float = 0.01, patience: int = 10) -> DataFrame:
    """``df`` with cluster_id, each bucket clustered for itself; of several seeds the one with the least inertia counts.

    ``batch`` makes it mini-batches of about so many rows instead of whole rounds.
    """
    fit = Fit(df, bucket, vector, key)
    want = {n: sizes.get(name, default) for n, name in enumerate(fit.names)}
    best: dict[int, tuple[float, int, np.ndarray]] = {}
    starts = [fit.start(want, seed) for seed in seeds]
    together = not batch and sum(c.size for start in starts for c in start.values()) <= CENTROIDS
    if together:  # the seeds' books share the passes over the rows
        books = fit.lloyd({n * fit.buckets + b: c for n, start in enumerate(starts) for b, c in start.items()}, max_iter, tol)
        cost = fit.inertia(books) if len(seeds) > 1 else dict.fromkeys(books, 0.0)
    for order, (seed, start) in enumerate(zip(seeds, starts, strict=True)):
        if not together:
            own = fit.minibatch(start, batch, epochs, seed, ratio, patience) if batch else fit.lloyd(start, max_iter, tol)
            paid = fit.inertia(own) if len(seeds) > 1 else dict.fromkeys(own, 0.0)
        else:
            own, paid = ({b: made[order * fit.buckets + b] for b in start} for made in (books, cost))
        for b, c in own.items():
            if b not in best or paid[b] < best[b][0]:
                best[b] = (paid[b], order, c)
    discard(fit.rows, fit.blocks)
    books, names = {b: c for b, (_, _, c) in best.items()}, df.columns
    fine = F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    ready = df.select("*", fit.number(F.col(bucket).cast("string")).alias("_bucket"), F.transform(vector, lambda v: v.cast("double")).alias("_x"), F.when(fine, F.size(vector)).alias("_dim"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return ready.mapInArrow(_label(books, fit.dim, names), f"{kinds}, cluster_id int")
