"""The k nearest other rows of every row, exact, for tables of any size: no task and no driver holds more than some parts of it.

Copies of a vector are one point, which keeps the first k + 1 of its rows. Points lie in cells around sampled pivots, and runs of
neighbouring cells make parts of at most ``NUMBERS`` numbers (a larger cell is several parts). Each part is compared with itself
first; its (k + 1)-th best distance then says which other parts a point still has to ask: those with a cell that may be nearer.
Points and the parts that they ask meet in cogroups, one for each pair of parts. Where nothing can be ruled out these are all
pairs, so work and shuffle grow with the square of the table; memory doesn't.

Within a group a matrix product, around the asking cell's pivot and mostly in single precision, leaves what may count within its
error; that is computed again from differences, one component after the other. Order: distance, then the smaller key.

Defined cases: as in ``layout``, but nothing is too large.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.sources.stores import discard, saved

#: Points of a cell on average, pivots at most, and numbers of all pivots.
CELL, PIVOTS, PIVOT_NUMBERS = 1024, 2048, 1 << 20
#: Numbers of a part at most; parts of a table, if a part then still has so many points.
NUMBERS, PARTS, LEAST = 1 << 21, 16, 2048
#: Rows and columns of a matrix product.
BLOCK = 1024
#: No row: greater than all numbers of rows.
NONE = np.iinfo(np.int64).max


def finite(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(row, _key, x), saved: rows with whole vectors, the smallest vector of a key, numbered in the order of keys.

    A number is the key itself if that is an integer. Single precision is kept, as it takes half the room.
    """
    kind = "float" if df.schema[vector].dataType.elementType.typeName() == "float" else "double"
    fine = F.col(key).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    x = F.transform(vector, lambda v: v.cast(kind) + F.lit(0.0).cast(kind))
    own = df.where(fine).groupBy(F.col(key).alias("_key")).agg(F.min(x).alias("x"))
    if own.schema["_key"].dataType.typeName() in ("byte", "short", "integer", "long"):
        table = saved(own.select(F.col("_key").cast("long").alias("row"), "_key", "x"))
    else:
        table = saved(own.orderBy("_key").select(F.monotonically_increasing_id().alias("row"), "_key", "x"))
    dim = table.agg(F.min_by(F.size("x"), "row")).first()[0]
    return table.where(F.size("x") == (dim or 0))


def flat(batch: pa.RecordBatch | pa.Table, name: str) -> np.ndarray:
    """A column of vectors as a matrix of doubles."""
    column = batch[name].combine_chunks() if isinstance(batch, pa.Table) else batch[name]
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, -1)


def to_pivots(x: np.ndarray, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Squared distances and how far from the truth each row's may be."""
    own, other = (x * x).sum(1), (pivots * pivots).sum(1)
    slack = 8.0 * (x.shape[1] + 4) * np.finfo(float).eps * (own + other.max()) + 1e-300
    return np.maximum(own[:, None] - 2 * (x @ pivots.T) + other, 0.0), slack


def in_order(pivots: np.ndarray) -> np.ndarray:
    """An order of pivots in which neighbours are near: halved along the widest component again and again."""
    out, todo = [], [np.arange(len(pivots))]
    while todo:
        at = todo.pop()
        if len(at) > 1:
            at = at[np.argsort(pivots[at, np.ptp(pivots[at], 0).argmax()], kind="stable")]
            todo += [at[len(at) // 2 :], at[: len(at) // 2]]
        else:
            out += at.tolist()
    return np.array(out)


def _celled(pivots) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for lo in range(0, whole.num_rows, BLOCK):
                batch = whole.slice(lo, BLOCK)
                x = flat(batch, "x")
                cell = to_pivots(x, pivots.value)[0].argmin(1)
                far = np.sqrt(((x - pivots.value[cell]) ** 2).sum(1))
                yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array(far), *batch.columns], ["cell", "far", *batch.schema.names])

    return run


def dealt(counts: list[tuple[int, int]], most: int) -> list[tuple[int, int, int]]:
    """(cell, first part, pieces) of cells with their sizes: runs of cells up to ``most`` points, larger cells in pieces."""
    out, part, held = [], 0, 0
    for cell, n in counts:
        if held and held + n > most:
            part, held = part + 1, 0
        pieces = -(-n // most)
        out.append((cell, part, pieces))
        held += n
        if pieces > 1:
            part, held = part + pieces, 0
    return out


class Part:
    """Some points by cells, of which others ask the nearest."""

    def __init__(self, table: pa.Table, pivots: np.ndarray, radius: np.ndarray):
        cell, point = table["cell"].to_numpy(), table["point"].to_numpy()
        order = np.lexsort((point, cell))
        self.cell, self.point, self.x = cell[order], point[order], flat(table, "x")[order]
        self.across = np.ascontiguousarray(self.x.T)
        self.cells, self.begin = np.unique(self.cell, return_index=True)
        self.end = np.append(self.begin[1:], len(self.cell))
        self.pivots, self.radius = pivots, radius
        lists = table["rows"].combine_chunks()
        size = lists.value_lengths().to_numpy()
        begin = np.cumsum(size) - size
        by_point = np.argsort(point)
        self.ids, self.rows, self.size, self.at = point[by_point], lists.flatten().to_numpy(), size[by_point], begin[by_point]

    def nearest(self, x: np.ndarray, cell: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Of each vector the k nearest points here, not farther than its bound, and their distances; NONE where there are no more."""
        found, best = np.full((len(x), k), NONE), np.repeat(bound[:, None], k, 1).astype(float)
        order = np.argsort(cell, kind="stable")
        for run in np.split(order, np.flatnonzero(np.diff(cell[order])) + 1):
            for lo in range(0, len(run), BLOCK):
                at = run[lo : lo + BLOCK]
                if len(at):
                    found[at], best[at] = self._chunk(x[at], int(cell[at[0]]), found[at], best[at])
        return found, best

    def _chunk(self, x: np.ndarray, home: int, found: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        square, slack = to_pivots(x, self.pivots[self.cells])
        least = np.maximum(np.sqrt(np.maximum(square - slack[:, None], 0.0)) - self.radius[self.cells] * (1 + 1e-9), 0.0)
        mid = self.pivots[home]
        own, across = x - mid, np.ascontiguousarray(x.T)
        for c in np.argsort(square.min(0)).tolist():
            asks = np.flatnonzero(least[:, c] <= best[:, -1] * (1 + 1e-9))
            for lo in range(int(self.begin[c]), int(self.end[c]) if len(asks) else 0, BLOCK):
                m = slice(lo, min(lo + BLOCK, int(self.end[c])))
                i, j = self._may(own[asks], self.x[m] - mid, best[asks, -1], found.shape[1])
                if not len(i):
                    continue
                diff = across[:, asks[i]] - self.across[:, m][:, j]
                far = np.zeros(len(i))
                for component in diff:  # a sum over an axis would add in another order for few pairs
                    far += component * component
                self._merge(found, best, asks[i], self.point[m][j], np.sqrt(far))
        return found, best

    @staticmethod
    def _may(a: np.ndarray, b: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs whose distance may be within the bound of the first, and among its k best here."""
        most = max(np.abs(a).max(), np.abs(b).max())
        kind = np.float32 if 1e-12 < most < 1e12 else np.float64
        one, other = (a * a).sum(1), (b * b).sum(1)
        slack = 4.0 * (a.shape[1] + 16) * float(np.finfo(kind).eps) * (one + other.max()) + (1e-36 if kind is np.float32 else 1e-300)
        left = np.hstack((-2 * a, np.ones((len(a), 1)))).astype(kind)
        near = left @ np.hstack((b, other[:, None])).astype(kind).T  # without the first's own square
        limit = (bound * bound * (1 + 1e-12) - one + slack).astype(kind)
        may = near <= limit[:, None]
        if len(b) > k and np.count_nonzero(may) > 2 * k * len(a):
            limit = np.minimum(limit, (np.partition(near, k - 1, 1)[:, k - 1].astype(np.float64) + 2 * slack).astype(kind))
            may = near <= limit[:, None]
        return np.divmod(np.flatnonzero(may), len(b))  # of one dimension, as that is faster

    @staticmethod
    def _merge(found: np.ndarray, best: np.ndarray, at: np.ndarray, what: np.ndarray, far: np.ndarray) -> None:
        k = found.shape[1]
        rows, local = np.unique(at, return_inverse=True)
        who = np.concatenate((np.repeat(np.arange(len(rows)), k), local))
        what, far = np.concatenate((found[rows].ravel(), what)), np.concatenate((best[rows].ravel(), far))
        order = np.lexsort((what, far, who))
        who, what, far = who[order], what[order], far[order]
        place = np.arange(len(who)) - np.searchsorted(who, who)
        keep = place < k
        found[rows[who[keep]], place[keep]], best[rows[who[keep]], place[keep]] = what[keep], far[keep]

    def lists(self, found: np.ndarray, best: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, row, distance) of found points' rows, the k best of each query in order."""
        k = found.shape[1]
        q, n = np.nonzero(found != NONE)
        at = np.searchsorted(self.ids, found[q, n])
        size = self.size[at]
        place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        q, far, row = np.repeat(q, size), np.repeat(best[q, n], size), self.rows[np.repeat(self.at[at], size) + place]
        order = np.lexsort((row, far, q))
        q, far, row = q[order], far[order], row[order]
        keep = np.arange(len(q)) - np.searchsorted(q, q) < k
        return q[keep], row[keep], far[keep]


def _near(n: int, q: np.ndarray, row: np.ndarray, far: np.ndarray) -> pa.Array:
    offsets = np.searchsorted(q, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(far), pa.array(row)], ["d", "row"]))


NEAR = "near array<struct<d: double, row: long>>"


def _within(pivots, radius, places: np.ndarray, k: int) -> Callable[[pa.Table], pa.Table]:
    """A part's own best, and the other parts that each point has to ask; ``places`` says which cells lie in which parts."""

    def run(table: pa.Table) -> pa.Table:
        part = Part(table, pivots.value, radius)
        x, cell = flat(table, "x"), table["cell"].to_numpy()
        q, row, far = part.lists(*part.nearest(x, cell, np.full(len(x), np.inf), k))
        bound = np.full(len(x), np.inf)
        last = np.arange(len(q)) - np.searchsorted(q, q) == k - 1
        bound[q[last]] = far[last]
        asked, sizes, me = [], [], table["part"][0].as_py()
        for lo in range(0, len(x), BLOCK):
            square, slack = to_pivots(x[lo : lo + BLOCK], pivots.value)
            least = np.sqrt(np.maximum(square - slack[:, None], 0.0)) - radius * (1 + 1e-9)
            needs = (least <= bound[lo : lo + BLOCK, None] * (1 + 1e-9)).astype(np.float32) @ places > 0
            needs[:, me] = False
            asked.append(np.nonzero(needs)[1].astype(np.int32))
            sizes.append(needs.sum(1))
        ends = np.concatenate(([0], np.cumsum(np.concatenate(sizes)))).astype(np.int32)
        asks = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(asked)))
        own = [table[c] for c in ("point", "part", "cell", "x")]
        return pa.table([*own, pa.array(bound), asks, _near(len(x), q, row, far)], ["point", "asker", "cell", "x", "bound", "asks", "near"])

    return run


def _across(pivots, radius, k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(asking: pa.Table, asked: pa.Table) -> pa.Table:
        if not asking.num_rows or not asked.num_rows:
            return pa.table({"point": pa.array([], pa.int64()), "near": _near(0, *(np.zeros(0, t) for t in (np.int64, np.int64, float)))})
        part = Part(asked, pivots.value, radius)
        found, best = part.nearest(flat(asking, "x"), asking["cell"].to_numpy(), asking["bound"].to_numpy(), k)
        made = pa.table({"point": asking["point"], "near": _near(len(found), *part.lists(found, best))})
        return made.filter(pa.array((found != NONE).any(1)))

    return run


def neighbours(table: DataFrame, k: int) -> DataFrame:
    """(row, other, rank, distance) of ``finite`` rows: the k nearest other rows of each, from 1, ties to the smaller."""
    spark, k1 = table.sparkSession, k + 1
    same = W.partitionBy("_hash", "x").orderBy("row")
    named = saved(table.select("row", "x", F.xxhash64("x").alias("_hash")).select("row", "x", F.first("row").over(same).alias("point"), F.row_number().over(same).alias("_place")))
    more = named.where(F.col("_place").between(2, k1)).groupBy("point").agg(F.array_sort(F.collect_list("row")).alias("_more"))  # k at most
    points = named.where("_place = 1").select("point", "x").join(more, "point", "left")
    points = points.select("point", "x", F.concat(F.array("point"), F.coalesce("_more", F.array().cast("array<long>"))).alias("rows"))
    n, dim = named.where("_place = 1").agg(F.count("*"), F.max(F.size("x"))).first()
    if not n:
        return table.select("row", F.col("row").alias("other"), F.lit(0).alias("rank"), F.lit(0.0).alias("distance")).where("false")
    m = max(1, min(n // CELL, PIVOTS, PIVOT_NUMBERS // dim))
    sample = flat(named.where("_place = 1").orderBy(F.xxhash64("point"), "point").limit(m).select("x").toArrow(), "x")  # bounded by PIVOT_NUMBERS
    pivots = spark.sparkContext.broadcast(sample[in_order(sample)])
    kind = table.schema["x"].dataType.simpleString()
    celled = saved(points.mapInArrow(_celled(pivots), f"cell int, far double, point long, x {kind}, rows array<long>"))
    cells = celled.groupBy("cell").agg(F.count("*"), F.max("far")).orderBy("cell").collect()  # as many as pivots
    radius = np.full(m, -np.inf)
    radius[[c for c, *_ in cells]] = [far for *_, far in cells]
    most = max(1, min(NUMBERS // dim, max(LEAST, -(-n // PARTS))))
    where = dealt([(c, size) for c, size, _ in cells], most)
    parts = where[-1][1] + where[-1][2]
    places = np.zeros((m, parts), np.float32)
    for c, first, pieces in where:
        places[c, first : first + pieces] = 1
    placed = celled.join(F.broadcast(spark.createDataFrame(where, "cell int, _first int, _pieces int")), "cell")
    placed = placed.select((F.col("_first") + F.pmod(F.xxhash64("point"), F.col("_pieces").cast("long"))).cast("int").alias("part"), "cell", "point", "x", "rows")
    shape = f"point long, asker int, cell int, x {kind}, bound double, asks array<int>, {NEAR}"
    own = saved(placed.repartition(parts, "part").groupBy("part").applyInArrow(_within(pivots, radius, places, k1), shape))
    asking = own.select("point", "asker", "cell", "x", "bound", F.explode("asks").alias("part"))
    pairs = asking.select("part", "asker").distinct().collect()  # parts squared at most
    near = own.select("point", "near")
    if pairs:
        asked = placed.join(F.broadcast(spark.createDataFrame(pairs, "part int, asker int")), "part")
        groups = [d.repartition(len(pairs), "part", "asker").groupBy("part", "asker") for d in (asking, asked)]
        others = groups[0].cogroup(groups[1]).applyInArrow(_across(pivots, radius, k1), f"point long, {NEAR}")
        near = near.unionByName(others).groupBy("point").agg(F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k1).alias("near"))  # k + 1 of each part
    found = named.select("row", "point").join(near, "point").select("row", F.slice(F.filter("near", lambda v: v["row"] != F.col("row")), 1, k).alias("near"))
    made = saved(found.select("row", F.posexplode("near").alias("rank", "n")).select("row", F.col("n.row").alias("other"), (F.col("rank") + 1).cast("int").alias("rank"), F.col("n.d").alias("distance")))
    discard(named, celled, own)
    return made


def by_key(df: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
    """Numbers of ``finite`` rows in ``columns`` become keys."""
    kind = table.schema["_key"].dataType
    if kind.typeName() in ("byte", "short", "integer", "long"):
        return df.withColumns({c: F.col(c).cast(kind) for c in columns})
    for c in columns:
        df = df.join(table.select(F.col("row").alias(c), "_key"), c).drop(c).withColumnRenamed("_key", c)
    return df
