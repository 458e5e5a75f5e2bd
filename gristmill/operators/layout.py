"""A plane layout of vectors that keeps neighbourhoods: nearest-neighbour graph, fuzzy weights, edge sampling.

It is made for a sample of ``POINTS`` rows, as a picture can't show more, or (``rows=None``) for all rows. Either has at most ``NUMBERS``
numbers, beyond which it is an error and never fewer rows; the vectors and its plane positions are what every task holds.

Graph: exact. Copies of a vector are one point with their ids in order. Points lie in cells around a root's number of
pivots; a cell whose pivot is farther than the k-th best distance so far and the cell's radius is skipped. What is
left is compared by matrix products, and what may count within their error is computed again from differences.

Weights: a point's nearest other vector has weight 1, and its bandwidth is bisected so that its k weights add up to log2(k). The
two directions of an edge are joined as a fuzzy union, v + w - vw.

Layout: starts on the two main axes. Edges are dealt by their head to PARTS parts. An edge fires as often as its weight
says; the head moves to the tail and away from some random points, one edge of a head after the other. A part moves its own
heads for ``sync`` epochs while the rest stands still, then all positions meet. Random numbers depend on the seed, the
epoch and the part alone, so the layout doesn't depend on how parts are dealt to tasks.

``graph_of_all``, ``fuzzy_of_all`` and ``layout_of_all`` are the same for tables of any size: neighbours come from ``nearest``, and nothing
but the plane positions (two numbers for each row, at most ``NUMBERS``) is held whole.

Defined cases: rows with a null key, or a vector that is null, empty, holds null, NaN or infinity, or has another length than the first
by order, take no part; of repeated keys the smallest vector stays; fewer than k + 1 points have as many neighbours as
there are; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.operators import nearest
from gristmill.operators.lloyd import BLOCK, ROWS, Middles
from gristmill.operators.sample import hashed_sample
from gristmill.sources.stores import saved

#: Rows of a sample at most, and numbers of all vectors.
POINTS, NUMBERS = 50_000, 1 << 24
NEIGHBOURS, EPOCHS, SYNC, NEGATIVES = 15, 200, 10, 5
#: Parts of a layout at most, and heads of a part at least.
PARTS, HEADS = 32, 250
#: Heads of a part of all rows, and numbers of a group whose moments are summed.
SHARE, GROUP = 16_384, 1 << 20
#: Halvings of a bandwidth's interval; a bandwidth is at least this share of the mean distance.
HALVINGS, LEAST = 64, 1e-3
#: 1 / (1 + a d^2b) fitted to a plateau up to 0.1 and a fall of scale 1 after it.
A, B = 1.577, 0.8951
#: A move's components at most, and half the width of the start.
MOST, WIDTH = 4.0, 10.0


class Points:
    """Distinct vectors with the rows that have them, in cells around pivots."""

    def __init__(self, x: np.ndarray):
        self.x, self.of = np.unique(x, axis=0, return_inverse=True)
        self.of = self.of.ravel()
        self.rows = np.argsort(self.of, kind="stable")  # rows of each point in order
        self.begin = np.searchsorted(self.of[self.rows], np.arange(len(self.x) + 1))
        self.square = (self.x * self.x).sum(1)
        pivots = self.x[np.linspace(0, len(self.x) - 1, max(1, math.isqrt(len(self.x))), dtype=np.int64)]
        self.pivots, (cell, far) = pivots, Middles(pivots).nearest(self.x)
        self.cells = [np.flatnonzero(cell == c) for c in range(len(pivots))]
        self.radius = np.array([math.sqrt(far[m].max()) if len(m) else -1.0 for m in self.cells])
        self.cell = cell

    def nearest(self, rows: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each row the k nearest other rows and their distances; ties to the smaller row, -1 where there are no more."""
        other, far = np.full((len(rows), k), -1), np.full((len(rows), k), np.inf)
        for c in np.unique(self.cell[self.of[rows]]).tolist():
            at = np.flatnonzero(self.cell[self.of[rows]] == c)
            for lo in range(0, len(at), ROWS):
                part = at[lo : lo + ROWS]
                other[part], far[part] = self._part(rows[part], c, k)
        return other, far

    def _part(self, rows: np.ndarray, home: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        points, back = np.unique(self.of[rows], return_inverse=True)
        x, own = self.x[points], self.square[points]
        slack = 8.0 * (x.shape[1] + 4) * np.finfo(float).eps * (own + self.square.max()) + 1e-300
        # best distinct vectors, the point itself among them: k + 1 are enough, as each has a row at least
        found, best = np.full((len(points), k + 1), len(self.x)), np.full((len(points), k + 1), np.inf)
        to = np.sqrt(np.maximum(own[:, None] - 2 * (x @ self.pivots.T) + (self.pivots**2).sum(1), 0))
        for c in [home, *(c for c in np.argsort(to.min(0)).tolist() if c != home)]:
            members = self.cells[c]
            least = np.maximum(to[:, c] - np.sqrt(slack) - self.radius[c], 0.0)
            asks = np.flatnonzero(least * least * (1 - 1e-9) <= best[:, -1] + slack)
            for lo in range(0, len(members) if len(asks) else 0, max(1, BLOCK // len(asks) if len(asks) else 1)):
                m = members[lo : lo + max(1, BLOCK // len(asks))]
                near = own[asks, None] - 2 * (x[asks] @ self.x[m].T) + self.square[m]
                limit = best[asks, -1]
                if len(m) > k:
                    limit = np.minimum(limit, np.partition(near, k, 1)[:, k])
                i, j = np.nonzero(near <= (limit + 2 * slack[asks])[:, None])
                d = ((x[asks[i]] - self.x[m[j]]) ** 2).sum(1)
                # of each asking point the k + 1 best of old and new
                who = np.concatenate((np.repeat(np.arange(len(asks)), k + 1), i))
                what, dist = np.concatenate((found[asks].ravel(), m[j])), np.concatenate((best[asks].ravel(), d))
                order = np.lexsort((what, dist, who))
                who, what, dist = who[order], what[order], dist[order]
                place = np.arange(len(who)) - np.searchsorted(who, who)
                keep = place <= k
                found[asks[who[keep]], place[keep]], best[asks[who[keep]], place[keep]] = what[keep], dist[keep]
        out, far = np.full((len(rows), k), -1), np.full((len(rows), k), np.inf)
        for r, row in enumerate(rows.tolist()):
            got: list[tuple[float, int]] = []
            for p, d in zip(found[back[r]].tolist(), best[back[r]].tolist(), strict=True):
                if p < len(self.x):  # the first k + 1 rows of a point are enough
                    got += [(d, o) for o in self.rows[self.begin[p] : min(self.begin[p] + k + 1, self.begin[p + 1])].tolist() if o != row]
            got.sort()
            for n, (d, o) in enumerate(got[:k]):
                out[r, n], far[r, n] = o, math.sqrt(d)
        return out, far


def bandwidths(far: np.ndarray, mean: float) -> tuple[np.ndarray, np.ndarray]:
    """(nearest positive distance, bandwidth) of each row of distances; infinite ones count as missing."""
    there = np.isfinite(far)
    positive = np.where(there & (far > 0), far, np.inf).min(1)
    nearest = np.where(np.isfinite(positive), positive, 0.0)
    want = np.log2(np.maximum(there.sum(1), 1))
    over = np.where(there, np.maximum(far - nearest[:, None], 0.0), np.inf)
    low, high, mid = np.zeros(len(far)), np.full(len(far), np.inf), np.ones(len(far))
    for _ in range(HALVINGS):
        more = np.exp(-over / mid[:, None]).sum(1) > want
        high, low = np.where(more, mid, high), np.where(more, low, mid)
        mid = np.where(np.isfinite(high), (low + high) / 2, mid * 2)
    own = np.where(there, far, 0.0).sum(1) / np.maximum(there.sum(1), 1)
    return nearest, np.maximum(mid, LEAST * np.where(nearest > 0, own, mean))


class Sample:
    """The rows of a layout: keys in order, and their vectors."""

    def __init__(self, df: DataFrame, key: str, vector: str, rows: int | None, seed: int | str):
        fine = F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
        own = df.where(fine).groupBy(F.col(key).alias("_key")).agg(F.min(F.transform(vector, lambda v: v.cast("double") + F.lit(0.0))).alias("_x"))
        self.kind = own.schema["_key"].dataType.simpleString()
        self.table = saved(own if rows is None else hashed_sample(own, min(rows, POINTS), "_key", seed))
        size = self.table.agg(F.sum(F.size("_x"))).first()[0] or 0
        if rows is None and size > NUMBERS:
            raise ValueError(f"{size} numbers of all vectors are over {NUMBERS}; take a sample")
        got = self.table.orderBy("_key").toArrow()  # at most POINTS rows, or NUMBERS numbers
        size = got["_x"].combine_chunks().value_lengths().to_numpy() if got.num_rows else np.zeros(0, np.int64)
        self.dim = int(size[0]) if len(size) else 1
        got = got.filter(pa.array(size == self.dim)) if len(size) else got
        if got.num_rows * self.dim > NUMBERS:
            raise ValueError(f"a sample of {got.num_rows} vectors of {self.dim} numbers is over {NUMBERS}; take fewer rows")
        self.keys = got["_key"].combine_chunks() if got.num_rows else pa.array([], got.schema.field("_key").type)
        self.x = got["_x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, self.dim) if got.num_rows else np.zeros((0, self.dim))
        self.spark = df.sparkSession

    def numbers(self) -> DataFrame:
        """(row) for each row number, dealt over the cluster."""
        return self.spark.range(len(self.keys)).withColumnRenamed("id", "row")

    def directed(self, k: int) -> DataFrame:
        """(row, other, rank, distance): the k nearest rows of each row, from 1."""
        shared = self.spark.sparkContext.broadcast(self.x)  # bounded by NUMBERS

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            points = None
            for batch in batches:
                rows = batch["row"].to_numpy()
                points = points or Points(shared.value)
                other, far = points.nearest(rows, k)
                r, n = np.nonzero(other >= 0)
                columns = [pa.array(rows[r]), pa.array(other[r, n]), pa.array((n + 1).astype(np.int32)), pa.array(far[r, n])]
                yield pa.RecordBatch.from_arrays(columns, ["row", "other", "rank", "distance"])

        return self.numbers().mapInArrow(run, "row long, other long, rank int, distance double")

    def named(self, df: DataFrame, *columns: str) -> DataFrame:
        """Row numbers in ``columns`` become keys."""
        names = self.spark.createDataFrame(pa.table({"_n": np.arange(len(self.keys)), "_key": self.keys}))
        for c in columns:
            df = df.join(F.broadcast(names), F.col(c) == F.col("_n")).drop(c, "_n").withColumnRenamed("_key", c)
        return df


def graph(df: DataFrame, key: str, vector: str = "embedding", k: int = NEIGHBOURS, rows: int | None = POINTS, seed: int | str = 42) -> DataFrame:
    """(id, other, rank, distance): the k nearest others of each row of a sample, ties to the smaller key."""
    own = Sample(df, key, vector, rows, seed)
    return own.named(own.directed(k).withColumnRenamed("row", "id"), "id", "other").select("id", "other", "rank", "distance")


def _weigh(mean: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["near"]
            size = lists.value_lengths().to_numpy()
            at = np.repeat(np.arange(len(size)), size)
            place = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
            far = np.full((len(size), int(size.max())), np.inf)
            flat = lists.flatten()
            far[at, place] = flat.field("distance").to_numpy()
            nearest, width = bandwidths(far, mean)
            weight = np.exp(-np.maximum(far[at, place] - nearest[at], 0.0) / width[at])
            yield pa.RecordBatch.from_arrays([batch["row"].take(pa.array(at)), flat.field("other"), pa.array(weight)], ["row", "other", "weight"])

    return run


def _union(directed: DataFrame) -> DataFrame:
    """(row, other, weight) with row < other from the distances of a directed graph."""
    mean = directed.agg(F.avg("distance")).first()[0] or 0.0
    near = directed.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", "other", "distance"))).alias("near"))  # k of each row
    one_way = near.mapInArrow(_weigh(mean), "row long, other long, weight double")
    both = one_way.groupBy(F.least("row", "other").alias("row"), F.greatest("row", "other").alias("other"))
    return both.agg((F.sum("weight") - F.when(F.count("weight") == 2, F.max("weight") * F.min("weight")).otherwise(0.0)).alias("weight"))


def fuzzy(df: DataFrame, key: str, vector: str = "embedding", k: int = NEIGHBOURS, rows: int | None = POINTS, seed: int | str = 42) -> DataFrame:
    """(id, other, weight): edges of the fuzzy union, each once, the smaller key first."""
    own = Sample(df, key, vector, rows, seed)
    return own.named(_union(saved(own.directed(k))).withColumnRenamed("row", "id"), "id", "other").select("id", "other", "weight")


def moved(heads: np.ndarray, tails: np.ndarray, rate: np.ndarray, at: np.ndarray, epochs: range, total: int, seed: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Rows that some edges' heads move, and where they are after some epochs; ``at`` has all positions.

    Edges are sorted by head. In a step every head takes its next firing edge, so no two moves of one head meet.
    """
    own, local = np.unique(heads, return_inverse=True)
    here = at.copy()
    for epoch in epochs:
        rng, alpha = np.random.default_rng([*seed, epoch]), 1.0 - epoch / total
        fires = np.flatnonzero(np.floor((epoch + 1) * rate) > np.floor(epoch * rate))
        place = np.arange(len(fires)) - np.searchsorted(local[fires], local[fires])
        for step in range(int(place.max()) + 1 if len(place) else 0):
            e = fires[place == step]
            head = heads[e]
            diff = here[head] - here[tails[e]]
            d = (diff * diff).sum(1)
            pull = np.where(d > 0, -2 * A * B * np.power(np.maximum(d, 1e-300), B - 1) / (1 + A * np.power(d, B)), 0.0)
            here[head] += np.clip(pull[:, None] * diff, -MOST, MOST) * alpha
            for _ in range(NEGATIVES):
                other = rng.integers(0, len(at), len(head))
                diff = here[head] - here[other]
                d = (diff * diff).sum(1)
                push = 2 * B / ((0.001 + d) * (1 + A * np.power(d, B)))
                move = np.where((d > 0)[:, None], np.clip(push[:, None] * diff, -MOST, MOST), rng.uniform(-MOST, MOST, diff.shape))
                here[head] += np.where((other == head)[:, None], 0.0, move) * alpha
    return own, here[own]


def _move(shared, epochs: range, total: int, seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have = [b for b in batches if b.num_rows]  # a few parts' edges, with all those of a head
        if not have:
            return
        table = pa.Table.from_batches(have)
        part, row, other, rate = (table[c].to_numpy() for c in ("part", "row", "other", "rate"))
        for p in np.unique(part).tolist():
            at = np.flatnonzero(part == p)
            at = at[np.lexsort((other[at], row[at]))]
            own, here = moved(row[at], other[at], rate[at], shared.value, epochs, total, [seed, p])
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(here[:, 0]), pa.array(here[:, 1])], ["row", "x", "y"])

    return run


def axes(x: np.ndarray) -> np.ndarray:
    """Coordinates on the two main axes, the largest load of each positive."""
    mid = x - x.mean(0)
    _, vectors = np.linalg.eigh(mid.T @ mid)
    top = vectors[:, ::-1][:, :2]
    top = top * np.where(top[np.abs(top).argmax(0), np.arange(top.shape[1])] < 0, -1.0, 1.0)
    out = np.zeros((len(x), 2))
    out[:, : top.shape[1]] = mid @ top
    return out


def laid_out(df: DataFrame, key: str, vector: str = "embedding", k: int = NEIGHBOURS, rows: int | None = POINTS, epochs: int = EPOCHS, sync: int = SYNC, seed: int = 42) -> DataFrame:
    """(key, x, y): plane positions of a reproducible sample of rows."""
    own = Sample(df, key, vector, rows, seed)
    n = len(own.keys)
    at = axes(own.x) if n else np.zeros((0, 2))
    at *= WIDTH / max(np.abs(at).max(), 1e-300) if n else 1.0
    at += np.random.default_rng(seed).normal(0, 1e-4, at.shape)
    edges = saved(_union(saved(own.directed(k))))
    most = edges.agg(F.max("weight")).first()[0]
    if most:
        both = edges.unionByName(edges.select(F.col("other").alias("row"), F.col("row").alias("other"), "weight"))
        fires, parts = both.where(F.col("weight") >= most / epochs), max(1, min(PARTS, n // HEADS))  # the others don't fire once
        dealt = saved(fires.select(F.pmod("row", F.lit(parts)).cast("int").alias("part"), "row", "other", (F.col("weight") / most).alias("rate")).repartition(parts, "part"))
        spark = own.spark
        for first in range(0, epochs, sync):
            shared = spark.sparkContext.broadcast(at)  # two numbers for each row
            got = dealt.mapInArrow(_move(shared, range(first, min(first + sync, epochs)), epochs, seed), "row long, x double, y double").toArrow()
            at = at.copy()
            at[got["row"].to_numpy()] = np.stack([got["x"].to_numpy(), got["y"].to_numpy()], 1)
            shared.unpersist()
    made = pa.table({key: own.keys, "x": at[:, 0], "y": at[:, 1]})
    return own.spark.createDataFrame(made) if n else own.table.where("false").select(F.col("_key").alias(key), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))


def graph_of_all(df: DataFrame, key: str, vector: str = "embedding", k: int = NEIGHBOURS) -> DataFrame:
    """``graph`` of all rows."""
    own = nearest.finite(df, key, vector)
    return nearest.by_key(nearest.neighbours(own, k).withColumnRenamed("row", "id"), own, "id", "other").select("id", "other", "rank", "distance")


def fuzzy_of_all(df: DataFrame, key: str, vector: str = "embedding", k: int = NEIGHBOURS) -> DataFrame:
    """``fuzzy`` of all rows."""
    own = nearest.finite(df, key, vector)
    return nearest.by_key(_union(nearest.neighbours(own, k)).withColumnRenamed("row", "id"), own, "id", "other").select("id", "other", "weight")


def _moments(table: DataFrame, groups: int, mid: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of differences from ``mid`` and of their products, always added in one order."""

    def run(part: pa.Table) -> pa.Table:
        x = nearest.flat(part.take(pa.array(np.argsort(part["row"].to_numpy()))), "x") - mid
        return pa.table({"_g": part["_g"][:1], "s": pa.array([np.concatenate((x.sum(0), (x.T @ x).ravel()))])})

    dealt = table.select(F.pmod(F.xxhash64("row"), F.lit(groups)).alias("_g"), "row", "x")
    got = dealt.groupBy("_g").applyInArrow(run, "_g long, s array<double>").orderBy("_g").toArrow()  # a row for each group
    total = nearest.flat(got, "s").sum(0)
    return total[: len(mid)], total[len(mid) :].reshape(len(mid), -1)


def _start(table: DataFrame, n: int, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows in order and their coordinates on the two main axes, the largest load of each positive."""
    groups = -(-n * dim // GROUP)
    mid = _moments(table, groups, np.zeros(dim))[0] / n
    _, vectors = np.linalg.eigh(_moments(table, groups, mid)[1])
    top = vectors[:, ::-1][:, :2]
    top = top * np.where(top[np.abs(top).argmax(0), np.arange(top.shape[1])] < 0, -1.0, 1.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = nearest.flat(batch, "x") - mid
            at = np.zeros((len(x), 2))
            for c in range(dim):  # a product's last digits would depend on the batch
                at[:, : top.shape[1]] += x[:, c : c + 1] * top[c]
            yield pa.RecordBatch.from_arrays([batch["row"], pa.array(at[:, 0]), pa.array(at[:, 1])], ["row", "x", "y"])

    got = table.select("row", "x").mapInArrow(run, "row long, x double, y double").orderBy("row").toArrow()  # two numbers for each row
    return got["row"].to_numpy(), np.stack([got["x"].to_numpy(), got["y"].to_numpy()], 1)


def layout_of_all(df: DataFrame, key: str, vector: str = "embedding", k: int = NEIGHBOURS, epochs: int = EPOCHS, sync: int = SYNC, seed: int = 42, directed: DataFrame | None = None) -> DataFrame:
    """``laid_out`` of all rows; ``directed`` is what ``graph_of_all`` has made of the same rows, if it is there and keys are integers."""
    table = nearest.finite(df, key, vector)
    n, dim = table.agg(F.count("*"), F.max(F.size("x"))).first()
    if 2 * n > NUMBERS:
        raise ValueError(f"positions of {n} rows are over {NUMBERS} numbers; take a sample")
    if not n:
        return table.select(F.col("_key").alias(key), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))
    spark = table.sparkSession
    rows, at = _start(table, n, dim)
    at *= WIDTH / max(np.abs(at).max(), 1e-300)
    at += np.random.default_rng(seed).normal(0, 1e-4, at.shape)
    directed = nearest.neighbours(table, k) if directed is None else directed.select(F.col("id").cast("long").alias("row"), F.col("other").cast("long").alias("other"), "rank", "distance")
    edges = saved(_union(directed))
    most = edges.agg(F.max("weight")).first()[0]
    if most:
        names = spark.sparkContext.broadcast(rows)

        def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                row, other = (np.searchsorted(names.value, batch[c].to_numpy()) for c in ("row", "other"))
                yield pa.RecordBatch.from_arrays([pa.array(row), pa.array(other), batch["rate"]], ["row", "other", "rate"])

        both = edges.unionByName(edges.select(F.col("other").alias("row"), F.col("row").alias("other"), "weight"))
        fires = both.where(F.col("weight") >= most / epochs).select("row", "other", (F.col("weight") / most).alias("rate"))  # the others don't fire once
        parts = max(1, min(max(PARTS, n // SHARE), n // HEADS))
        numbered = fires.mapInArrow(placed, "row long, other long, rate double")
        dealt = saved(numbered.select(F.pmod("row", F.lit(parts)).cast("int").alias("part"), "row", "other", "rate").repartition(parts, "part"))
        for first in range(0, epochs, sync):
            shared = spark.sparkContext.broadcast(at)  # two numbers for each row
            got = dealt.mapInArrow(_move(shared, range(first, min(first + sync, epochs)), epochs, seed), "row long, x double, y double").toArrow()
            at = at.copy()
            at[got["row"].to_numpy()] = np.stack([got["x"].to_numpy(), got["y"].to_numpy()], 1)
            shared.unpersist()
        names.unpersist()
    made = spark.createDataFrame(pa.table({"_row": rows, "x": at[:, 0], "y": at[:, 1]}))
    return made.join(table.select(F.col("row").alias("_row"), F.col("_key").alias(key)), "_row").select(key, "x", "y")


def kept_neighbours(high: DataFrame, low: DataFrame) -> DataFrame:
    """(n, share): of the pairs of one graph the share that another graph of the same rows has."""
    met = high.select("id", "other").join(low.select("id", "other", F.lit(1).alias("_in")), ["id", "other"], "left")
    return met.agg(F.count("*").alias("n"), F.avg(F.coalesce("_in", F.lit(0))).alias("share"))
