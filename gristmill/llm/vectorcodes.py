"""Vector code compression: product codes of integer vectors, nearest entries by annular norm pruning.

Components become integers floor(1024 x), a vector is cut into PARTS equal parts, and each part position
has a codebook of ENTRIES entries. By the triangle inequality an entry at distance d from a part has a norm within d of
the part's. So entries are sorted by norm; a part first meets the few entries of nearest norm, the best
distance so far gives an interval of norms, found by bisection, and only entries in that annulus, its ends
included, are evaluated: exactly, in integers. Parts of like norms have like annuli, so a block of them is evaluated
over the union of theirs, by one product of matrices whose sums are whole numbers that doubles hold exactly (else 64-bit integers do).

A round is one pass: tasks assign their parts and send one partial sum for each entry that they used.
Codebooks are the only thing that goes to the driver and to all tasks: ENTRIES integers for each component.

Defined cases: rows whose vector is null or holds a null or a number that isn't finite are dropped, and so are
those whose length isn't the commonest one that PARTS divides (the smaller one of equally common lengths). Null ids come after all
others; rows of one id are rows for themselves, in order of their vectors. Fewer than ENTRIES rows make smaller
codebooks. Integers are held within +-sqrt(2^62 / length) / 2, so that all sums of squares fit 64 bits. An
empty table gives no rows; extra columns don't matter.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.sources.stores import discard, saved

PARTS, ENTRIES, ROUNDS, UNIT = 4, 256, 4, 1024
#: Entries of nearest norm that a part meets before its annulus is cut.
FIRST = 8
#: Parts whose annuli are evaluated together, and first distances evaluated at a time, in components.
ROWS, PAIRS = 128, 1 << 18
#: Labels whose sums may be broadcast; more are joined by a shuffle, each label's sum to so many salts.
LABELS, SALTS = 100_000, 16


def comparable(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both as doubles, if these hold every squared distance of the integers exactly."""
    most = int(np.abs(x).max(initial=0)) + int(np.abs(entries).max(initial=0))
    kind = np.float64 if most * most * x.shape[1] < 1 << 53 else np.int64
    return x.astype(kind), entries.astype(kind)  # products stay within 62 bits in any case, as integers are bounded


def distances(x: np.ndarray, entries: np.ndarray, row: np.ndarray, entry: np.ndarray) -> np.ndarray:
    """Exact squared distances of the given pairs."""
    out = np.zeros(len(row), x.dtype)
    step = max(1, PAIRS // x.shape[1])
    for lo in range(0, len(row), step):
        d = x[row[lo : lo + step]] - entries[entry[lo : lo + step]]
        out[lo : lo + step] = np.einsum("ij,ij->i", d, d)
    return out


def assigned(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's nearest entry, ties to the lower index, and its squared distance; all integers."""
    x, entries = comparable(x, entries)
    norms = np.sqrt((entries.astype(np.float64) ** 2).sum(1))
    order = np.argsort(norms, kind="stable")
    sorted_norms = norms[order]
    own = np.sqrt((x.astype(np.float64) ** 2).sum(1))
    # a few entries around the part's own norm give the first best distance
    k = min(FIRST, len(entries))
    begin = np.clip(np.searchsorted(sorted_norms, own) - k // 2, 0, len(entries) - k)
    at = order[begin[:, None] + np.arange(k)]
    near = distances(x, entries, np.repeat(np.arange(len(x)), k), at.ravel()).reshape(len(x), k)
    best = near.min(1)
    index = np.where(near == best[:, None], at, len(entries)).min(1)
    # entries within that distance by norm; the slack is far over the rounding of norms
    reach = np.sqrt(best.astype(np.float64))
    slack = (own + reach + 1.0) * 1e-9
    lo = np.searchsorted(sorted_norms, own - reach - slack, "left")
    hi = np.searchsorted(sorted_norms, own + reach + slack, "right")
    # parts of like norms have like annuli: a block of them meets the entries of all its annuli, by exact products
    like, square = np.argsort(own, kind="stable"), (entries * entries).sum(1)
    for a in range(0, len(x), ROWS):
        rows = like[a : a + ROWS]
        some = order[lo[rows].min() : hi[rows].max()]  # never empty, as the best entry so far is in it
        d = (x[rows] * x[rows]).sum(1)[:, None] + square[some] - 2 * (x[rows] @ entries[some].T)
        best[rows] = d.min(1)
        index[rows] = np.where(d == best[rows][:, None], some, len(entries)).min(1)
    return index, best.astype(np.int64)


def whole(vectors: pa.Array, dim: int) -> np.ndarray:
    """Rows of integers from a column of integer lists of one length."""
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _sum(books: list[np.ndarray], dim: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Partial sums and counts of the entries that a task's parts were assigned to."""
    size = dim // len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(books), len(books[0]), size), np.int64)
        count = np.zeros((len(books), len(books[0])), np.int64)
        for batch in batches:
            x = whole(batch["x"], dim)
            for p, entries in enumerate(books):
                part = x[:, p * size : (p + 1) * size]
                index, _ = assigned(part, entries)
                order = np.argsort(index, kind="stable")
                used, first = np.unique(index[order], return_index=True)
                if len(used):
                    sums[p][used] += np.add.reduceat(part[order], first)
                count[p] += np.bincount(index, minlength=len(entries))
        part, entry = np.nonzero(count)
        pos = np.tile(np.arange(size), len(part))
        columns = [np.repeat(part, size), np.repeat(entry, size), pos, np.repeat(count[part, entry], size), sums[part, entry].ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["part", "entry", "pos", "n", "total"])

    return run


def _codes(books: list[np.ndarray], dim: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    size = dim // len(books)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, error, codes = whole(batch["x"], dim), np.zeros(batch.num_rows, np.int64), np.zeros((batch.num_rows, len(books)), np.uint8)
            for p, entries in enumerate(books):
                codes[:, p], far = assigned(x[:, p * size : (p + 1) * size], entries)
                error += far
            names = codes.tobytes().hex()
            width = 2 * len(books)
            code = pa.array([names[i : i + width] for i in range(0, len(names), width)], pa.string())
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["label"], code, pa.array(error)], ["vec_id", "label", "code", "error"])

    return run


def integers(vectors: DataFrame, parts: int = PARTS) -> tuple[DataFrame, int]:
    """(vec_id, label, x) of the rows that take part, as a saved table, and their length."""
    fine = F.col("embedding").isNotNull() & F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf"))))
    own = vectors.where(fine).select("vec_id", "label", F.transform("embedding", lambda v: v.cast("double")).alias("x"))
    sizes = own.groupBy(F.size("x").alias("dim")).agg(F.count("*").alias("n")).where((F.col("dim") > 0) & (F.col("dim") % parts == 0))
    commonest = sizes.orderBy(F.desc("n"), "dim").first()
    dim = commonest["dim"] if commonest else 0
    limit = math.isqrt((1 << 62) // max(dim, 1)) // 2
    whole_number = lambda v: F.least(F.greatest(F.floor(v * UNIT).cast("double"), F.lit(float(-limit))), F.lit(float(limit))).cast("long")
    return saved(own.where(F.size("x") == dim).select("vec_id", "label", F.transform("x", whole_number).alias("x"))), dim


def codebooks(rows: DataFrame, dim: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks after all rounds, from a table of integer vectors."""
    first = rows.orderBy(F.asc_nulls_last("vec_id"), "x").select("x").limit(entries).collect()
    books = np.array([r["x"] for r in first], np.int64).reshape(len(first), parts, dim // parts).transpose(1, 0, 2).copy()
    for _ in range(rounds if len(first) else 0):
        partial = rows.select("x").mapInArrow(_sum(list(books), dim), "part long, entry long, pos long, n long, total long")
        sums = partial.groupBy("part", "entry", "pos").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
        for r in sums.collect():  # one number for each component of the codebooks
            books[r["part"], r["entry"], r["pos"]] = int(r["total"]) // r["n"]
    return list(books)


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(v) for b in books for v in b.ravel().tolist()).encode()).hexdigest()


def encoded(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) of the rows that take part."""
    rows, dim = integers(vectors, parts)
    books = codebooks(rows, dim, parts, entries, rounds)
    kinds = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in ("vec_id", "label"))
    coded = saved(rows.mapInArrow(_codes(books, dim or parts), f"{kinds}, code string, error long"))
    discard(rows)
    sums = saved(coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "_label"))
    same = F.col("label").eqNullSafe(F.col("_label"))
    if sums.count() <= LABELS:
        met = coded.join(F.broadcast(sums), same)
    else:
        dealt = sums.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        met = coded.withColumn("_own", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS))).join(dealt, same & (F.col("_own") == F.col("_salt")))
    return met.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _assign_sql(n: int) -> str:
    """Each part's nearest entry in codebook k<n>; sums of products of these integers are exact in doubles."""
    return f"""
a{n} AS (SELECT row, part, d.entry, d.far FROM (
  SELECT p.row, p.part, min({{'far': list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, k.x) + list_inner_product(k.x, k.x), 'entry': k.entry}}) AS d
  FROM p JOIN k{n} k USING (part) GROUP BY p.row, p.part))"""


def _move_sql(n: int) -> str:
    return f"""
s{n} AS (SELECT part, entry, pos, sum(x)::HUGEINT AS total, count(*) AS n
         FROM (SELECT a.part, a.entry, unnest(p.x)::BIGINT AS x, generate_subscripts(p.x, 1) AS pos FROM a{n} a JOIN p USING (row, part)) GROUP BY ALL),
m{n} AS (SELECT part, entry, list((CASE WHEN total % n < 0 THEN total // n - 1 ELSE total // n END)::DOUBLE ORDER BY pos) AS x FROM s{n} GROUP BY ALL),
k{n + 1} AS MATERIALIZED (SELECT k.part, k.entry, coalesce(m.x, k.x) AS x FROM k{n} k LEFT JOIN m{n} m USING (part, entry))"""


ENCODED_SQL = (
    """
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)) AS x FROM embeddings
           WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
r AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, x) AS row, * FROM v),
p AS MATERIALIZED (SELECT row, part, x[part * (len(x) // 4) + 1 : (part + 1) * (len(x) // 4)] AS x FROM r, (SELECT unnest(range(4)) AS part)),
k0 AS (SELECT part, row - 1 AS entry, x FROM p WHERE row <= 256),"""
    + ",".join(_assign_sql(n) + "," + _move_sql(n) for n in range(ROUNDS))
    + ","
    + _assign_sql(ROUNDS)
    + f""",
c AS (SELECT row, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(far)::BIGINT AS error FROM a{ROUNDS} GROUP BY row),
h AS (SELECT sha256(string_agg(v::BIGINT::VARCHAR, ',' ORDER BY part, entry, pos)) AS h
      FROM (SELECT part, entry, unnest(x) AS v, generate_subscripts(x, 1) AS pos FROM k{ROUNDS}))
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256
FROM c JOIN r USING (row), h
"""
)
