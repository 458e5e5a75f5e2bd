"""Words of Arrow string columns as flat numpy arrays.

A column is worked on in runs of whole rows of about ``RUN`` bytes, so temporaries stay in cache
and memory doesn't grow with the batch; a longer text makes a run of its own.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import wraps

import numpy as np
import pyarrow as pa

RUN = 1 << 19


def quoted(name: str) -> str:
    """A column's name for an expression, whatever characters it has."""
    return "`" + name.replace("`", "``") + "`"


_ODD = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: [^\x20\x09-\x0D]
WORD_BYTES = np.ones(256, bool)
WORD_BYTES[[0x20, *range(0x09, 0x0E)]] = False
#: Letters, digits and all bytes of non-ASCII characters.
ALNUM_BYTES = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


_powers = {}


def powers(n: int, base: np.uint64) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = max(n, RUN + 1)
        steps = np.full(size, base, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if size <= 8 * RUN:  # a very long text's powers aren't kept
            _powers[int(base)] = have
    return have[:n]


@dataclass
class Words:
    """Words of rows lo..hi-1: their hashes, and where each row's words begin (hi-lo+1 numbers)."""

    lo: int
    hi: int
    hashes: np.ndarray
    rows: np.ndarray


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n+1 offsets; null counts as empty."""
    texts = texts.fill_null("")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offs = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), offs


def runs(offs: np.ndarray, size: int = RUN) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes."""
    lo, n = 0, len(offs) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offs, offs[lo] + size, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def words(texts: pa.Array, kind: np.ndarray = WORD_BYTES) -> Iterator[Words]:
    """Hashes of the lower-cased (A-Z) words of each text; ``kind`` says which bytes make a word."""
    data, offs = buffers(texts)
    for lo, hi in runs(offs):
        b = data[offs[lo] : offs[hi]]
        cuts = offs[lo : hi + 1] - offs[lo]
        if not len(b):
            yield Words(lo, hi, np.zeros(0, np.uint64), np.zeros(hi - lo + 1, np.int64))
            continue
        inside = kind[b]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        at = cuts[:-1][cuts[:-1] < len(b)]
        first[at] |= inside[at]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        ends = cuts[1:][cuts[1:] > 0] - 1
        last[ends] |= inside[ends]
        starts, stops = np.flatnonzero(first), np.flatnonzero(last)
        sums = np.cumsum((LOWER[b].astype(np.uint64) + np.uint64(1)) * powers(len(b), _ODD))
        h = sums[stops] - np.where(starts > 0, sums[starts - 1], np.uint64(0))
        h *= powers(len(b), _BACK)[starts]
        yield Words(lo, hi, mix(h + (stops - starts + 1).astype(np.uint64)), np.searchsorted(starts, cuts))


_A, _B = np.uint64(0xA0761D6478BD642F), np.uint64(0xE7037ED1A0B428DB)


def shingles(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each row's runs of k words (of all its words, if fewer), and where rows begin."""
    n = np.diff(w.rows)
    made = np.where(n == 0, 0, np.maximum(n - k + 1, 1))
    rows = np.concatenate(([0], np.cumsum(made)))
    first = np.repeat(w.rows[:-1] - rows[:-1], made) + np.arange(rows[-1])
    width = np.repeat(np.minimum(n, k), made)
    h = width.astype(np.uint64)
    for j in range(k):
        part = w.hashes[np.minimum(first + j, max(len(w.hashes) - 1, 0))] if len(w.hashes) else np.zeros(0, np.uint64)
        h = np.where(j < width, (h ^ part) * _A + _B, h)
        h ^= h >> np.uint64(29)
    return mix(h), rows


def distinct(values: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row's values sorted without repeats, and where rows begin."""
    n = len(rows) - 1
    row = np.repeat(np.arange(n), np.diff(rows))
    order = np.lexsort((values, row))
    v = values[order]
    new = np.ones(len(v), bool)
    new[1:] = (v[1:] != v[:-1]) | (row[1:] != row[:-1])  # rows are in order, so row[order] is row
    return v[new], np.concatenate(([0], np.cumsum(np.bincount(row[new], minlength=n)))).astype(np.int64)


def trim() -> None:
    """Give freed memory back; only some C libraries need it and have the call."""
    give = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give:
        give(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A batch function that leaves no freed memory behind in a worker that goes on living."""

    @wraps(run)
    def tidied(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            trim()

    return tidied
