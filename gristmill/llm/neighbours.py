"""Exact nearest neighbours by a block matrix join of int8 tiles with error bounds.

Vectors are packed in tiles once, each with an int8 form of its vectors scaled to length 1, the scales,
the length of what the rounding lost, and the original components in their own width. Each query tile
meets each candidate tile. The product of the int8 tiles gives all cosines of the pair with a bound on
the error: |xy - x'y'| <= |x - x'| |y| + |x'| |y - y'|. A pair whose upper bound is under the query's
k-th best lower bound so far can't be among its k nearest; the rest is recomputed from the original
vectors in double precision and pushed on the query's heap. Nothing is lost: the result is exact.

Query tiles are dealt to groups and candidate tiles to shards. A cell is a group with a shard: its rows
lie together, the queries first, and candidate tiles stream past the group's heaps. So each side is
shuffled only as often as the other has groups or shards, no side is broadcast or held whole, and a
cell gives at most k rows for each of its queries, however many vectors are alike.

Defined cases: vectors that are null, zero, or hold a null or a number that isn't finite take no
part, null ids likewise; only vectors of one length are compared; repeated candidate ids count
once, with their best score; a query never finds its own id; an empty table or no query gives an
empty result; extra columns don't matter.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.sources.stores import discard, saved

#: Most vectors in a tile of queries or candidates, and most bytes of its components.
QUERY_TILE, TILE, TILE_BYTES = 512, 2048, 1 << 20
#: Query tiles in a group, candidate tiles in a shard (fewer where there are fewer than tasks at a time).
GROUP = 16
#: Tasks at most for all cells.
TASKS = 10_000
#: The int8 product is summed in float32 over so many components at a time, which is exact.
EXACT = 1024
#: Pairs recomputed at a time, in components.
PAIRS = 1 << 22
PARTS = ("ids", "q", "scale", "lost", "x")
TILE_SCHEMA = "query boolean, dim int, " + ", ".join(f"{n} binary" for n in PARTS)


class Tile:
    """Vectors of one length: ids, original components, int8 form, scales and what the rounding lost."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        self.ids, self.x = ids, x
        unit = x.astype(np.float64)
        unit /= np.abs(unit).max(1, keepdims=True)
        unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
        self.scale = np.abs(unit).max(1) / 127
        self.q = np.rint(unit / self.scale[:, None]).astype(np.int8)
        lost = unit - self.q * self.scale[:, None]
        self.lost = np.sqrt((lost * lost).sum(1))

    def packed(self) -> list[bytes]:
        return [getattr(self, n).tobytes() for n in PARTS]

    @classmethod
    def unpacked(cls, parts: list[bytes], dim: int, kind: type) -> Tile:
        made = cls.__new__(cls)
        for name, data, t in zip(PARTS, parts, (np.int64, np.int8, np.float64, np.float64, kind), strict=True):
            got = np.frombuffer(data, t)
            setattr(made, name, got.reshape(-1, dim) if name in ("q", "x") else got)
        return made


def _tiles(kind: type) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Valid vectors of one partition in tiles of one length and role."""

    def tile(key: tuple[bool, int], ids: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        columns = [pa.array([data], pa.binary()) for data in Tile(ids, x).packed()]
        return pa.RecordBatch.from_arrays([pa.array([key[0]]), pa.array([key[1]], pa.int32()), *columns], ["query", "dim", *PARTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wait: dict[tuple[bool, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in batches:
            vectors, ids = batch["embedding"], batch["vec_id"]
            size = pc.list_value_length(vectors).fill_null(0).to_numpy()
            fine = (size > 0) & ids.is_valid().to_numpy(zero_copy_only=False)
            number, role = ids.fill_null(0).to_numpy(), batch["query"].to_numpy(zero_copy_only=False)
            for dim in np.unique(size[fine]).tolist():
                rows = np.flatnonzero(fine & (size == dim))
                part = vectors.take(pa.array(rows)).flatten()
                x = part.cast(pa.from_numpy_dtype(kind)).to_numpy(zero_copy_only=False).reshape(-1, dim)
                good = np.isfinite(x).all(1) & (np.abs(x).max(1) > 0)
                x, at = x[good], rows[good]
                for q in (False, True):
                    mine = role[at] if q else np.ones(len(at), bool)  # a query is a candidate for others
                    if mine.any():
                        wait.setdefault((q, dim), []).append((number[at[mine]], x[mine]))
            for key, parts in wait.items():
                most = min(QUERY_TILE if key[0] else TILE, max(1, TILE_BYTES // (key[1] * np.dtype(kind).itemsize)))
                if sum(len(i) for i, _ in parts) >= most:
                    i, x = np.concatenate([i for i, _ in parts]), np.concatenate([x for _, x in parts])
                    full = len(i) // most * most
                    for lo in range(0, full, most):
                        yield tile(key, i[lo : lo + most], x[lo : lo + most])
                    wait[key] = [(i[full:], x[full:])] if full < len(i) else []
        for key, parts in wait.items():
            if parts:
                yield tile(key, np.concatenate([i for i, _ in parts]), np.concatenate([x for _, x in parts]))

    return run


def bounds(a: Tile, b: Tile) -> tuple[np.ndarray, np.ndarray]:
    """Approximate cosines of all pairs and how far off they may be."""
    dot = np.zeros((len(a.ids), len(b.ids)))
    for lo in range(0, a.q.shape[1], EXACT):
        dot += a.q[:, lo : lo + EXACT].astype(np.float32) @ b.q[:, lo : lo + EXACT].astype(np.float32).T
    near = dot * a.scale[:, None] * b.scale
    return near, a.lost[:, None] + (1 + a.lost[:, None]) * b.lost + 1e-9


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Of rows, in double precision, components summed in order."""
    s = np.zeros((3, len(x)))
    for d in range(x.shape[1]):
        s[0] += x[:, d] * y[:, d]
        s[1] += x[:, d] * x[:, d]
        s[2] += y[:, d] * y[:, d]
    with np.errstate(all="ignore"):
        c = s[0] / np.sqrt(s[1] * s[2])
    bad = ~np.isfinite(c) | (s[1] * s[2] < 1e-290)  # squares out of range: scale first
    if bad.any():
        u, v = (z[bad] / np.abs(z[bad]).max(1, keepdims=True) for z in (x, y))
        c[bad] = (u * v).sum(1) / np.sqrt((u * u).sum(1) * (v * v).sum(1))
    return np.clip(c, -1.0, 1.0)


def meet(a: Tile, b: Tile, heaps: list[list], k: int) -> None:
    """Push the pairs of two tiles that may count on the heaps of a's rows: (score, -id)."""
    near, off = bounds(a, b)
    near[a.ids[:, None] == b.ids] = -9.0
    low = near - off
    have = np.array([h[0][0] if len(h) >= k else -2.0 for h in heaps])
    if low.shape[1] > k:
        # ids may repeat within a tile; then the k-th value isn't the k-th id
        kth = np.partition(low, -k, 1)[:, -k] if len(np.unique(b.ids)) == len(b.ids) else np.full(len(low), -2.0)
        have = np.maximum(have, kth)
    i, j = np.nonzero((near + off >= have[:, None]) & (near > -5))
    step = max(1, PAIRS // a.x.shape[1])
    for lo in range(0, len(i), step):
        row, other = i[lo : lo + step], j[lo : lo + step]
        score = cosine(a.x[row].astype(np.float64), b.x[other].astype(np.float64))
        for at, s, o in zip(*best(row, score, b.ids[other], k), strict=True):
            push(heaps[at], s, o, k)


def best(row: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> tuple[list, list, list]:
    """Of each row the k best distinct ids: larger score first, then smaller id."""
    order = np.lexsort((-score, ids, row))
    row, score, ids = row[order], score[order], ids[order]
    first = np.ones(len(row), bool)
    first[1:] = (row[1:] != row[:-1]) | (ids[1:] != ids[:-1])
    row, score, ids = row[first], score[first], ids[first]
    order = np.lexsort((ids, -score, row))
    row, score, ids = row[order], score[order], ids[order]
    rank = np.arange(len(row)) - np.searchsorted(row, row)
    keep = rank < k
    return row[keep].tolist(), score[keep].tolist(), ids[keep].tolist()


def push(heap: list, score: float, other: int, k: int) -> None:
    """Keep the k best distinct ids: larger score first, then smaller id."""
    item = (score, -other)
    if len(heap) >= k and item <= heap[0]:
        return
    for n, old in enumerate(heap):
        if old[1] == -other:
            if item > old:
                heap[n] = item
                heapq.heapify(heap)
            return
    (heapq.heapreplace if len(heap) >= k else heapq.heappush)(heap, item)


def _search(k: int, kind: type) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def found(queries: list[Tile], heaps: list[list[list]]) -> Iterator[pa.RecordBatch]:
        for tile, own in zip(queries, heaps, strict=True):
            rows = [(q, -o, s) for q, heap in zip(tile.ids.tolist(), own, strict=True) for s, o in heap]
            if rows:
                q, o, s = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(o, pa.int64()), pa.array(s, pa.float64())], ["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries: list[Tile] = []
        heaps: list[list[list]] = []
        last = None
        for batch in batches:
            for r in range(batch.num_rows):
                cell = tuple(batch[n][r].as_py() for n in ("dim", "group", "shard"))
                if cell != last:
                    yield from found(queries, heaps)
                    queries, heaps, last = [], [], cell
                asks = not batch["candidate"][r].as_py()
                if not asks and not queries:
                    continue
                tile = Tile.unpacked([batch[n][r].as_py() for n in PARTS], cell[0], kind)
                if asks:
                    queries.append(tile)
                    heaps.append([[] for _ in tile.ids])
                else:
                    for query, own in zip(queries, heaps, strict=True):
                        meet(query, tile, own, k)
        yield from found(queries, heaps)

    return run


def nearest(vectors: DataFrame, every: int = 50, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest rows of each row whose id ``every`` divides."""
    spark = vectors.sparkSession
    kind = np.float32 if vectors.schema["embedding"].dataType.elementType.typeName() == "float" else np.float64
    own = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").withColumn("query", F.coalesce(F.pmod("vec_id", F.lit(every)) == 0, F.lit(False)))
    tiles = saved(own.mapInArrow(_tiles(kind), TILE_SCHEMA).withColumn("part", F.xxhash64("ids", "q")))
    n = {r["query"]: r["n"] for r in tiles.groupBy("query").agg(F.count("*").alias("n")).collect()}  # two rows
    asks, others = n.get(True, 0), n.get(False, 0)
    groups = max(1, -(-asks // GROUP))
    shards = max(1, min(others, max(-(-others // GROUP), spark.sparkContext.defaultParallelism)))
    group, shard = F.pmod(F.hash("part"), F.lit(groups)), F.pmod(F.hash("part"), F.lit(shards))
    all_of = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    q = tiles.where("query").select("dim", group.alias("group"), all_of(shards).alias("shard"), F.lit(False).alias("candidate"), *PARTS)
    c = tiles.where("not query").select("dim", all_of(groups).alias("group"), shard.alias("shard"), F.lit(True).alias("candidate"), *PARTS)
    cells = q.unionByName(c).repartition(min(groups * shards, TASKS), "dim", "group", "shard").sortWithinPartitions("dim", "group", "shard", "candidate")
    found = saved(cells.mapInArrow(_search(k, kind), "query_id long, vec_id long, score double"))
    discard(tiles)
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return merged.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


NEAREST_SQL = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
             AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
p AS (SELECT q.vec_id AS query_id, c.vec_id, max(list_cosine_similarity(q.x, c.x)) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.x) = len(c.x) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
