"""Document fingerprints by locally consistent parsing.

A text is parsed level by level. Runs of one symbol become one symbol; deterministic coin tossing
(Cole and Vishkin) then shortens each symbol to one of six labels that depend on a few symbols to
the left, so that neighbours differ; phrases begin at local maxima of the labels, and a phrase's
name is a hash of its symbols, which are the next level's text. A substring's inner phrases
depend on the substring and a bounded context alone, so equal substrings have equal names inside
wherever they stand. The fingerprint is the name of the whole text and the ``SIZE`` smallest
hashes of the names from level ``FROM`` up; likeness estimates the Jaccard index of the names.

The next document: rows are range-partitioned and sorted by id; each partition looks one row
ahead, and only the first and the last row of each are matched afterwards.

Defined cases: null is the empty text, whose fingerprint is its (zero) root alone and which is
like other empty texts only; rows with one id are ordered by text; null ids come first; a lone row
is its own next; an empty table gives an empty result; extra columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.llm.text import buffers, mix, powers, runs, tidy
from gristmill.sources.stores import saved

SIZE, FROM = 48, 1
#: Of a text's names only those under a bound are sorted at first, so chosen that about so many times SIZE are.
SPARE = 4
_P = np.uint64(0xBF58476D1CE4E5B9)
_BACK = np.uint64(pow(0xBF58476D1CE4E5B9, -1, 1 << 64))
_LOWEST = np.array([0] + [(x & -x).bit_length() - 1 for x in range(1, 256)], np.uint8)


def _toss(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels under 6 of symbols that differ from their left neighbours; first: where rows begin."""
    x = names.copy()
    x[1:] ^= names[:-1]
    x[first] = 1
    low = ((x & (~x + np.uint64(1))).astype(np.float64).view(np.int64) >> 52) - 1023
    label = (2 * low).astype(np.uint8) + ((names >> low.astype(np.uint64)) & np.uint64(1)).astype(np.uint8)
    for _ in range(3):  # under 128, 14, 8, 6
        x = label.copy()
        x[1:] ^= label[:-1]
        x[first] = 1
        low = _LOWEST[x]
        label = 2 * low + (label >> low & 1)
    return label


def _level(names: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of each row, and where rows begin; a phrase of one symbol keeps its name."""
    new = np.ones(len(names), bool)
    new[1:] = names[1:] != names[:-1]
    begin = rows[:-1][rows[:-1] < rows[1:]]
    new[begin] = True
    at = np.flatnonzero(new)
    if len(at) < len(names):
        length = np.diff(np.append(at, len(names))).astype(np.uint64)
        names = np.where(length > 1, mix(names[at] ^ (length * _P)), names[at])
        rows = np.searchsorted(at, rows)
        begin = rows[:-1][rows[:-1] < rows[1:]]
    label = _toss(names, begin)
    start = np.zeros(len(names), bool)
    start[1:-1] = (label[1:-1] > label[:-2]) & (label[1:-1] > label[2:])
    ends = rows[1:][rows[:-1] < rows[1:]] - 1
    start[ends] = False
    start[begin] = True
    at = np.flatnonzero(start)
    stop = np.append(at[1:], len(names))
    sums = np.cumsum(names * powers(len(names), _P))
    h = sums[stop - 1] - np.where(at > 0, sums[at - 1], np.uint64(0))
    h = mix(h * powers(len(names), _BACK)[at] + (stop - at).astype(np.uint64))
    return np.where(stop - at > 1, h, names[at]), np.searchsorted(at, rows)


def _smallest(row: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """The SIZE smallest distinct values of each of n rows, sorted, filled up with the largest value."""
    out = np.full((n, SIZE), 0xFFFFFFFF, np.uint32)
    many = np.bincount(row, minlength=n)
    bound = np.minimum(SPARE * SIZE * 2.0**32 / np.maximum(many, 1), 2.0**32)
    todo = values < bound[row]
    while True:
        keys = np.unique((row[todo].astype(np.uint64) << np.uint64(32)) | values[todo])
        own = (keys >> np.uint64(32)).astype(np.int64)
        place = np.arange(len(keys)) - np.searchsorted(own, np.arange(n))[own]
        keep = place < SIZE
        out[own[keep], place[keep]] = keys[keep].astype(np.uint32)
        # rows with many repeats may have too few under the bound: those are taken whole
        short = (np.bincount(own, minlength=n) < SIZE) & (bound < 2.0**32)
        if not short.any():
            return out
        bound[short] = 2.0**32
        todo = short[row]


def sketches(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Root names, sketches (n x SIZE, sorted, filled up with the largest value) and their sizes."""
    data, offs = buffers(texts)
    n = len(offs) - 1
    roots, out = np.zeros(n, np.uint64), np.full((n, SIZE), 0xFFFFFFFF, np.uint32)
    for lo, hi in runs(offs):
        names = data[offs[lo] : offs[hi]].astype(np.uint64) + np.uint64(1)
        rows = offs[lo : hi + 1] - offs[lo]
        found, owner, level = [], [], 0
        while len(names):
            size = np.diff(rows)
            if level >= FROM:
                row = np.repeat(np.arange(hi - lo), size)
                open_ = size[row] > 1  # a row's last name is its root, added below
                found.append((mix(names[open_] + np.uint64(level)) >> np.uint64(32)).astype(np.uint32))
                owner.append(row[open_])
            if size.max() <= 1:
                break
            names, rows = _level(names, rows)
            level += 1
        full = rows[:-1] < rows[1:]
        roots[lo:hi][full] = mix(names[rows[:-1][full]])
        if len(names):
            found.append((mix(names) >> np.uint64(32)).astype(np.uint32))
            owner.append(np.flatnonzero(full))
            out[lo:hi] = _smallest(np.concatenate(owner), np.concatenate(found), hi - lo)
    return roots, out, (out != 0xFFFFFFFF).sum(1)


def likeness(a: np.ndarray, b: np.ndarray, same: np.ndarray) -> np.ndarray:
    """Estimated Jaccard index of rows: of the SIZE smallest of both, the share that is in both."""
    both = np.sort(np.concatenate((a, b), 1), 1)
    real = both != 0xFFFFFFFF
    new = np.ones(both.shape, bool)
    new[:, 1:] = both[:, 1:] != both[:, :-1]
    new &= real
    place = np.cumsum(new, 1)
    within = real & (place <= SIZE)
    union, shared = (new & within).sum(1), (~new & within).sum(1)
    return np.where(same, 1.0, shared / np.maximum(union, 1))


def _printed(roots: np.ndarray, sketch: np.ndarray, sizes: np.ndarray) -> list[bytes]:
    """Root and sketch in bytes; hex digits are made only for the result, as the working table counts as disk."""
    return [r + s[: 4 * n] for r, s, n in zip((x.tobytes() for x in roots.byteswap()), (x.tobytes() for x in sketch.byteswap()), sizes.tolist(), strict=True)]


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
EDGE = ", part int, first boolean, text string"


def _rows(ids: list, texts: list[str], nexts: list[str]) -> list[pa.Array]:
    """The columns of NAMES of documents and the documents after them."""
    edited = []
    for text, after in zip(texts, nexts, strict=True):
        q = len(text) // 4
        edited.append(text[: len(text) - q] + after[:q])
    n = len(texts)
    # in a batch, the next document's text is mostly the next row's
    roots, sketch, sizes = sketches(pa.array([*texts, *nexts[-1:]], pa.large_string()))
    eroots, esketch, esizes = sketches(pa.array(edited, pa.large_string()))
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in edited]
    near = likeness(sketch[:n], esketch, roots[:n] == eroots), likeness(sketch[:n], sketch[1:], roots[:n] == roots[1:])
    prints = _printed(roots[:n], sketch[:n], sizes[:n]), _printed(eroots, esketch, esizes)
    return [pa.array(ids, pa.int64()), pa.array([len(t) for t in texts], pa.int64()), pa.array(sha), *(pa.array(x, pa.binary()) for x in prints), *(pa.array(x, pa.float64()) for x in near)]


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted partition but the last; its first and last row come with their texts."""
    wait = None
    part = None

    def edge(doc: tuple, first: bool) -> pa.RecordBatch:
        blank = [pa.array([doc[0]], pa.int64()), *(pa.array([None], t) for t in (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()))]
        return pa.RecordBatch.from_arrays([*blank, pa.array([part], pa.int32()), pa.array([first]), pa.array([doc[1]])], [*NAMES, "part", "first", "text"])

    for batch in batches:
        for lo in range(0, batch.num_rows, 256):
            piece = batch.slice(lo, 256)
            docs = list(zip(piece["doc_id"].to_pylist(), piece["text"].to_pylist(), strict=True))
            if wait is None:
                part = piece["part"][0].as_py()
                yield edge(docs[0], True)
            else:
                docs.insert(0, wait)
            wait = docs[-1]
            if len(docs) > 1:
                texts = [d[1] for d in docs]
                made = _rows([d[0] for d in docs[:-1]], texts[:-1], texts[1:])
                n = len(docs) - 1
                yield pa.RecordBatch.from_arrays([*made, *(pa.nulls(n, t) for t in (pa.int32(), pa.bool_(), pa.string()))], [*NAMES, "part", "first", "text"])
    if wait is not None:
        yield edge(wait, False)


def _across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            yield pa.RecordBatch.from_arrays(_rows([b["doc_id"][i].as_py()], [b["text"][i].as_py()], [b["after"][i].as_py()]), NAMES)


def fingerprints(docs: DataFrame) -> DataFrame:
    """The columns of NAMES for each row of ``docs``."""
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranged = texts.repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text").withColumn("part", F.spark_partition_id())
    made = saved(ranged.mapInArrow(tidy(_within), SCHEMA + EDGE))
    edges = made.where("part is not null").select("part", "first", "doc_id", "text")  # two rows of a partition
    order = W.orderBy("part")
    after = edges.where("first").select("part", F.lead("text").over(order).alias("next"), F.first("text").over(order).alias("very_first"))
    last = edges.where("not first").select("part", "doc_id", "text").join(after, "part").select("doc_id", "text", F.coalesce("next", "very_first").alias("after"))
    out = made.where("part is null").select(*NAMES).unionByName(last.mapInArrow(_across, SCHEMA))
    digits = lambda c: F.regexp_replace(F.lower(F.hex(c)), "^(.{16})", "$1:")
    return out.withColumns({c: digits(c) for c in ("fingerprint", "edited_fingerprint")}).select(*NAMES)
