"""MinHash-LSH near-dedup with order-greedy semantics, in growing prefixes of the order.

A row is kept unless one of its band keys equals a key of an earlier kept row. That is the
lexicographically first maximal independent set by ``seq``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.operators.graph import connected_components
from gristmill.sources.stores import discard, saved, spread

PERMUTATIONS, WIDTH = 128, 5
#: The affine family is modulo this prime, so that products fit 62 bits.
PRIME = (1 << 31) - 1
#: Rows that one task settles in order (their band keys only).
FINISH = 200_000
#: Rows that one task settles whatever is asked for.
LEAST = 16
#: Keys after which a task settles the whole components that it has.
RUN = 100_000
#: Bytes of texts that are worked on at once; the more, the more of their shingles are the same.
BLOCK = 1 << 20
#: Hashes that are made at once, so that temporaries stay in cache.
RUN_OF_HASHES = 1 << 15
#: Hashes of a text that are expected below the bound of ``_least``.
EXPECTED = 16


@lru_cache
def family(n: int = PERMUTATIONS, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return rng.integers(1, PRIME, n, np.int64), rng.integers(0, PRIME, n, np.int64)


def byte_shingles(text: str, width: int = WIDTH) -> np.ndarray:
    """Distinct runs of ``width`` UTF-8 bytes as numbers; a shorter text is one shingle."""
    b = np.frombuffer(text.encode(), np.uint8).astype(np.int64)
    if len(b) < width:
        return np.array([sum(int(x) << (8 * (len(b) - 1 - i)) for i, x in enumerate(b))], np.int64)
    v = np.zeros(len(b) - width + 1, np.int64)
    for i in range(width):
        v = (v << 8) | b[i : len(b) - width + 1 + i]
    return np.unique(v)


def flat_signatures(texts: pa.Array, n: int = PERMUTATIONS) -> np.ndarray:
    """The signatures of a column of texts, in runs of about BLOCK bytes; null counts as empty."""
    texts = texts.fill_null("").cast(pa.large_binary())
    offs = np.concatenate(([0], np.cumsum(pc.binary_length(texts).to_numpy())))
    data = np.frombuffer(b"".join(texts.to_pylist()), np.uint8)
    a, b = (x.astype(np.uint64) for x in family(n))
    p = np.uint64(PRIME)
    out, lo = np.zeros((len(texts), n), np.int64), 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + BLOCK, "right")) - 1)
        size = np.diff(offs[lo : hi + 1])
        made = np.maximum(size - WIDTH + 1, 1)
        at = np.concatenate(([0], np.cumsum(made)))[:-1]
        x = data[offs[lo] : offs[hi]].astype(np.uint64)
        whole = max(len(x) - WIDTH + 1, 0)
        v = np.zeros(whole, np.uint64)
        for i in range(WIDTH):
            v = (v << np.uint64(8)) | x[i : whole + i]
        spot = np.repeat(offs[lo:hi] - offs[lo] - at, made) + np.arange(made.sum())
        h = v[np.minimum(spot, whole - 1)] if whole else np.zeros(len(spot), np.uint64)
        for r in np.flatnonzero(size < WIDTH):
            h[at[r]] = int.from_bytes(data[offs[lo + r] : offs[lo + r + 1]].tobytes(), "big")
        # a shingle of a block is hashed once, however many texts have it, unless most have no other
        own, number, row = _shared(h, np.repeat(np.arange(hi - lo), made))
        if 2 * len(own) <= len(h):
            least, all_, spare = _least(number, row, hi - lo, len(own)), np.empty_like(own), np.empty(RUN_OF_HASHES, np.uint64)
            own %= p
            for k in range(n):
                for i in range(0, len(own), RUN_OF_HASHES):
                    _hashed(own[i : i + RUN_OF_HASHES], a[k], b[k], all_[i : i + RUN_OF_HASHES], spare)
                out[lo:hi, k] = least(all_)
        else:
            h %= p
            ends = np.append(at, len(h))
            i = 0
            while i < hi - lo:
                j = max(i + 1, int(np.searchsorted(ends, ends[i] + RUN_OF_HASHES, "right")) - 1)
                part = h[ends[i] : ends[j]]
                y, z = np.empty_like(part), np.empty_like(part)
                for k in range(n):
                    out[lo + i : lo + j, k] = np.minimum.reduceat(_hashed(part, a[k], b[k], y, z), at[i:j] - at[i])
                i = j
        lo = hi
    return out


def _hashed(h: np.ndarray, a: np.uint64, b: np.uint64, y: np.ndarray, z: np.ndarray) -> np.ndarray:
    """(a * h + b) modulo PRIME in ``y``; ``z`` is room for as many."""
    p, z = np.uint64(PRIME), z[: len(h)]
    np.multiply(h, a, out=y)
    np.add(y, b, out=y)
    # modulo 2^31 - 1: the halves' sum is under twice the prime, and the smaller of it and it less the prime is right
    np.right_shift(y, np.uint64(31), out=z)
    np.bitwise_and(y, p, out=y)
    np.add(y, z, out=y)
    np.subtract(y, p, out=z)
    return np.minimum(y, z, out=y)


def _shared(h: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles (of 40 bits), and (number of the shingle, row) of each one that a row has, in this order; rows are in order."""
    if len(h) < 1 << 24:
        packed = np.sort((h << np.uint64(24)) | np.arange(len(h), dtype=np.uint64))
        row = row[(packed & np.uint64((1 << 24) - 1)).view(np.int64)]
        h = packed >> np.uint64(24)
    else:  # one long text
        order = np.argsort(h, kind="stable")
        h, row = h[order], row[order]
    other = np.ones(len(h), bool)
    np.not_equal(h[1:], h[:-1], out=other[1:])
    new = other.copy()
    new[1:] |= row[1:] != row[:-1]
    return h[other], (np.cumsum(other) - 1)[new], row[new]


def _least(number: np.ndarray, row: np.ndarray, rows: int, shingles: int) -> Callable[[np.ndarray], np.ndarray]:
    """A function that gives each row's smallest hash from those of the shingles.

    Of rows with many shingles only the hashes below a bound are looked at, under which EXPECTED of them at least are expected.
    Other rows, and those that have none below it, take all of theirs.
    """
    size = np.bincount(row, minlength=rows)
    starts = np.concatenate(([0], np.cumsum(np.bincount(number, minlength=shingles))))
    own = number[np.argsort(row.astype(np.uint16) if rows <= 1 << 16 else row, kind="stable")]
    begin = np.concatenate(([0], np.cumsum(size)))
    few = max(size.mean() / 2, 4 * EXPECTED)
    short = np.flatnonzero(size < few)
    bound = np.uint64(min(EXPECTED / few, 1) * PRIME)
    each = np.repeat(begin[short] - np.concatenate(([0], np.cumsum(size[short])))[:-1], size[short])
    all_short, at_short = own[each + np.arange(len(each))], np.concatenate(([0], np.cumsum(size[short])))[:-1]
    many = len(short) < rows

    def least(hashes: np.ndarray) -> np.ndarray:
        out = np.full(rows, PRIME, np.uint64)
        if many:
            low = np.flatnonzero(hashes < bound)
            n = starts[low + 1] - starts[low]
            there = row[np.repeat(starts[low] - (np.cumsum(n) - n), n) + np.arange(n.sum())]
            np.minimum.at(out, there, np.repeat(hashes[low], n))
        if len(short):
            out[short] = np.minimum.reduceat(hashes[all_short], at_short)
        for r in np.flatnonzero(out == PRIME):
            out[r] = hashes[own[begin[r] : begin[r + 1]]].min()
        return out

    return least


def signature(text: str, n: int = PERMUTATIONS) -> np.ndarray:
    return flat_signatures(pa.array([text]), n)[0]


@lru_cache
def bands(threshold: float, n: int = PERMUTATIONS, weight: float = 0.5) -> tuple[int, int]:
    """(bands, rows) with the least weighted false-positive and false-negative area."""
    x = np.linspace(0, 1, 1001)
    best = (np.inf, 1, 1)
    for b in range(1, n + 1):
        for r in range(1, n // b + 1):
            hit = 1 - (1 - x**r) ** b
            low, high = x <= threshold, x >= threshold
            error = weight * np.trapezoid(hit[low], x[low]) + (1 - weight) * np.trapezoid(1 - hit[high], x[high])
            best = min(best, (error, b, r))
    return best[1], best[2]


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = flat_signatures(batch["text"])
        ends = pa.array(np.arange(0, made.size + 1, made.shape[1]), pa.int32())
        yield pa.RecordBatch.from_arrays([batch["seq"], pa.ListArray.from_arrays(ends, pa.array(made.ravel()))], ["seq", "sig"])


def signatures(df: DataFrame, seq: str, text: str) -> DataFrame:
    return df.select(F.col(seq).alias("seq"), F.col(text).alias("text")).mapInArrow(_signatures, "seq long, sig array<long>")


def band_keys(df: DataFrame, seq: str, text: str, threshold: float) -> DataFrame:
    """(seq, band, key): a row for each band; signatures never meet as wholes."""
    b, r = bands(threshold)
    keys = [F.struct(F.lit(i).alias("band"), F.md5(F.array_join(F.slice("sig", i * r + 1, r).cast("array<string>"), ",")).alias("key")) for i in range(b)]
    return signatures(df, seq, text).select("seq", F.explode(F.array(*keys)).alias("x")).select("seq", "x.band", "x.key")


def _domain_keys(thresholds: dict[str, float], default: float):
    """(seq, band, a, b): 128-bit keys of the bands of each row's own threshold; the domain is part of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seq, sig = batch["seq"].to_numpy(), flat_signatures(batch["text"]).astype(np.uint64)
            domains = batch["domain"].to_pylist()
            own = np.array([thresholds.get(d, default) for d in domains])
            names = {d: np.frombuffer(hashlib.blake2b(repr((d, thresholds.get(d, default))).encode(), digest_size=16).digest(), np.uint64) for d in set(domains)}
            salt = np.array([names[d] for d in domains]).reshape(-1, 2)
            for t in np.unique(own).tolist():
                at = np.flatnonzero(own == t)
                number, rows = bands(t)
                for i in range(number):
                    keys = []
                    for half in (0, 1):
                        key = salt[at, half]
                        for c in range(i * rows, (i + 1) * rows):
                            key = (key ^ sig[at, c]) * np.uint64(0x9E3779B97F4A7C15 if half else 0xC2B2AE3D27D4EB4F)
                            key ^= key >> np.uint64(29)
                        keys.append(pa.array(key.view(np.int64)))
                    yield pa.RecordBatch.from_arrays([pa.array(seq[at]), pa.array(np.full(len(at), i, np.int32)), *keys], ["seq", "band", "a", "b"])

    return run


def _keys_of(keys: DataFrame) -> list[str]:
    return [c for c in keys.columns if c not in ("seq", "_component", "_block")]


def _in_order(by: list[str]):
    """The sequential rule over runs of whole components; (seq) of the kept rows.

    Rows of a run are few (see ``settled``): keys become numbers, and a flag for each says whether it is taken.
    """

    def solve(table: pa.Table) -> pa.RecordBatch:
        seq, key = table["seq"].to_numpy(), np.zeros(table.num_rows, np.int64)
        for c in by:
            code = pc.dictionary_encode(table[c].combine_chunks()).indices.to_numpy()
            key = np.unique(key * (int(code.max()) + 1) + code, return_inverse=True)[1]
        order = np.argsort(seq, kind="stable")
        seq, key = seq[order], key[order].tolist()
        starts = np.flatnonzero(np.concatenate(([True], seq[1:] != seq[:-1]))).tolist()
        taken, kept = bytearray(len(key)), []
        for lo, hi in zip(starts, [*starts[1:], len(key)], strict=True):
            own = key[lo:hi]
            if not any(taken[k] for k in own):
                kept.append(lo)
                for k in own:
                    taken[k] = 1
        return pa.RecordBatch.from_arrays([pa.array(seq[kept], table.schema.field("seq").type)], ["seq"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wait: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            if "_component" in batch.schema.names and sum(w.num_rows for w in wait) > RUN:
                # what lies before the last component that has begun is whole
                last = wait[-1]["_component"][-1].as_py()
                same = pc.equal(pa.concat_batches(wait)["_component"], last)
                whole = pa.concat_batches(wait)
                yield solve(pa.Table.from_batches([whole.filter(pc.invert(same))])) if pc.any(pc.invert(same)).as_py() else pa.RecordBatch.from_arrays([whole["seq"].slice(0, 0)], ["seq"])
                wait = [whole.filter(same)]
            wait.append(batch)
        if wait:
            yield solve(pa.Table.from_batches(wait))

    return run


def settled(part: DataFrame, finish: int = FINISH) -> DataFrame:
    """(seq) of the rows of a saved table that the sequential rule keeps, when nothing is taken before them.

    Only keys that several rows share matter. Where at most ``finish`` rows have one, a task goes through
    them in order. More are cut into connected components, each within one task; if a component has more rows than
    that, the first half of the order is settled before the other.
    """
    by = _keys_of(part)
    shared = part.groupBy(*by).agg(F.min("seq").alias("_lead"), F.max("seq").alias("_last")).where("_lead < _last").drop("_last")
    tied = saved(part.join(shared, by))
    n = tied.select("seq").distinct().count()
    free = part.select("seq").distinct()
    if not n:
        return free
    free = free.join(tied.select("seq").distinct(), "seq", "left_anti")
    kind = f"seq {part.schema['seq'].dataType.simpleString()}"
    own = tied.select("seq", *by)
    if n <= finish:
        return free.unionByName(own.repartition(1).mapInArrow(_in_order(by), kind))
    parts = saved(connected_components(tied.where("_lead < seq").select("seq", "_lead"), "_lead", "seq").select(F.col("node").alias("seq"), F.col("component").alias("_component")))
    if parts.groupBy("_component").count().agg(F.max("count")).first()[0] <= finish:
        dealt = own.join(parts, "seq").repartition("_component").sortWithinPartitions("_component")
        return free.unionByName(dealt.mapInArrow(_in_order(by), kind))
    middle = tied.select("seq").distinct().agg(F.percentile_approx("seq", 0.5, 1000)).first()[0]
    early = saved(own.where(F.col("seq") <= middle))
    kept = saved(settled(early, finish))
    late = saved(untaken(own.where(F.col("seq") > middle), early.join(kept, "seq", "left_semi").select(*by)))
    return free.unionByName(kept).unionByName(settled(late, finish))


def untaken(part: DataFrame, taken: DataFrame) -> DataFrame:
    """Rows of ``part`` (all their keys) of which no key is taken."""
    gone = part.join(taken, _keys_of(part), "left_semi").select("seq").distinct()
    return part.join(gone, "seq", "left_anti")


def blocks(keys: DataFrame, finish: int = FINISH) -> list:
    """Ends of blocks in order: about ``finish`` rows, then as many as all before, and so on."""
    n = keys.select("seq").distinct().count()
    shares, size = [], finish
    while size < n:
        shares.append(size / n)
        size *= 2
    if not shares:
        return []
    return sorted(set(keys.agg(F.percentile_approx("seq", F.array(*map(F.lit, shares)), 10_000)).first()[0]))


def greedy(keys: DataFrame, finish: int = FINISH) -> DataFrame:
    """(seq) of the kept rows, from (seq, ...): rows with equal values in all other columns share a band.

    The order is worked on in blocks that double. A block first drops the rows that share a key with a row kept
    before it, which are no more than the block's own, and what is left is settled within the block. So a key is read a
    constant number of times, and there are as many blocks as the logarithm of the rows.
    """
    all_keys, by, finish = saved(keys), _keys_of(keys), max(finish, LEAST)
    ends = blocks(all_keys, finish)
    if not ends:
        return settled(all_keys, finish)
    number = F.lit(len(ends))
    for n, end in reversed(list(enumerate(ends))):
        number = F.when(F.col("seq") <= F.lit(end), F.lit(n)).otherwise(number)
    dealt = saved(all_keys.withColumn("_block", number), "_block")
    discard(all_keys)
    kept = taken = None
    for n in range(len(ends) + 1):
        part = dealt.where(F.col("_block") == n).drop("_block")
        part = saved(untaken(part, taken)) if taken is not None else saved(part)
        now = saved(settled(part, finish))
        claims = saved(part.join(now, "seq", "left_semi").select(*by))
        kept, taken = (now, claims) if kept is None else (kept.unionByName(now), taken.unionByName(claims))
    discard(dealt)
    return kept


def domain_keys(df: DataFrame, seq: str, text: str, domain: str, thresholds: dict[str, float], default: float = 0.8) -> DataFrame:
    """(seq, band, a, b) of all domains in one pass over the texts; null texts count as empty ones."""
    own = df.select(F.col(seq).alias("seq"), F.col(text).alias("text"), F.col(domain).alias("domain"))
    return spread(own).mapInArrow(_domain_keys(thresholds, default), f"seq {own.schema['seq'].dataType.simpleString()}, band int, a long, b long")


def near_dedup(df: DataFrame, seq: str, text: str, domain: str, thresholds: dict[str, float], default: float = 0.8, finish: int = FINISH) -> DataFrame:
    """Rows of ``df`` that survive, each domain for itself; domains that aren't named get the default."""
    keys = domain_keys(df, seq, text, domain, thresholds, default)
    return df.join(greedy(keys, finish).withColumnRenamed("seq", seq), seq, "left_semi")
