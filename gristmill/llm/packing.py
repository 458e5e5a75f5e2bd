"""Packing into fixed windows by minimum bin slack.

Only lengths decide: a table of at most ``WINDOW`` counts goes to the driver, however many
documents there are. For the longest remaining length a subset-sum over the other remaining
lengths (a bitset, binary-split counts) finds the multiset that comes closest to the rest of the
window; backtracking gives its counts, and the pattern is used as often as the counts allow.
Lengths for which nothing fills the window exactly are laid end to end afterwards and cut at
window ends; the last partial window is cut into powers of two. So no sequence has padding.

Each piece then finds its place by its rank within its length. Ranks come from counts of
(length, salt) cells, so a group of copies isn't ranked in one task. The placing table has a few
rows per pattern, and there are at most a few dozen patterns per length: its size doesn't follow
the data.

Defined cases: null text is empty and has the end token alone; repeated rows are packed each;
null ids are allowed; an empty table gives an empty result; extra columns don't matter.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.llm.bpe import Merges, gather
from gristmill.llm.text import RUN, WORD_BYTES, buffers, runs, tidy
from gristmill.sources.stores import saved

WINDOW, END = 4096, 2
#: Cells at least that the pieces of one length are ranked in, and pieces in a cell where there are more.
SALTS, CELL = 256, 1_000_000
#: Symbols of words that are merged together; a longer word is a part of its own.
SYMBOLS = 1 << 16
#: Chunks of these characters alone are cut into words here, as the vocabulary's own rule does; all
#: others, and those with what may be a special token, go through the tokenizer as they are.
PLAIN = re.compile(r"[\x00-\x09\x0b-\x1b\x20-\x84\x86-\x9f\xa1-\xff]*")
#: Fixed value: the vocabulary's rule for words, and the line feed that we put between chunks.
WORD = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+|\n")
#: Bytes of cut pieces that may be broadcast; more are joined by a shuffle.
SMALL = 8 << 20


class Encoder:
    """Token ids of white-space separated chunks, each distinct chunk and word of a run of texts encoded once.

    The vocabulary drops white space and never joins text across it, so a text's ids are those of
    its chunks in order, and a chunk's those of its words. Distinct words of a run are merged together in flat
    arrays (``bpe``); nothing is kept from run to run.
    """

    def __init__(self, vocabulary: str):
        self.path, self.tokenizer = vocabulary, None
        with open(vocabulary, encoding="utf-8") as f:
            self.merges = Merges(json.load(f)["model"])

    def by_library(self, text: str) -> np.ndarray:
        if self.tokenizer is None:  # few texts need it
            from tokenizers import Tokenizer

            self.tokenizer = Tokenizer.from_file(self.path)
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def words(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain chunks one after the other, and the number of each."""
        names = pa.array(WORD.findall("\n".join(chunks).lower()), pa.string()).dictionary_encode()
        at = names.indices.to_numpy()
        data, offs = buffers(names.dictionary)
        parts = [self.merges.merged(data[offs[lo] : offs[hi]], np.diff(offs[lo : hi + 1])) for lo, hi in runs(offs, SYMBOLS)]
        flat, n = (np.concatenate(p) for p in zip(*parts, strict=True)) if parts else (np.zeros(0, np.int32), np.zeros(0, np.int64))
        line, begin = names.dictionary.index("\n").as_py(), np.cumsum(n) - n
        if line >= 0:  # between chunks
            n[line] = 0
        n = n[at]
        total = np.concatenate(([0], np.cumsum(n)))
        ends = np.append(np.flatnonzero(at == line), len(at))
        return gather(flat, begin[at], n).astype(np.uint32), np.diff(total[ends], prepend=0)

    def chunks(self, names: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct chunks in some order, the number of each, and where each begins."""
        texts = [c.decode() for c in names]
        whole = "\r".join(texts)
        plain = np.ones(len(texts), bool) if "<|" not in whole and PLAIN.fullmatch(whole) else np.array(["<|" not in t and bool(PLAIN.fullmatch(t)) for t in texts], bool)
        n, parts = np.zeros(len(texts), np.int64), []
        if plain.any():
            ids, n[plain] = self.words([t for t, p in zip(texts, plain.tolist(), strict=True) if p])
            parts.append(ids)
        for r in np.flatnonzero(~plain).tolist():
            parts.append(self.by_library(texts[r]))
            n[r] = len(parts[-1])
        begin = np.zeros(len(texts), np.int64)
        order = np.concatenate((np.flatnonzero(plain), np.flatnonzero(~plain)))
        begin[order] = np.cumsum(n[order]) - n[order]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32), n, begin

    def encode(self, b: np.ndarray, cuts: np.ndarray) -> list[np.ndarray]:
        """Ids of each text, b[cuts[i] : cuts[i + 1]] in UTF-8, with the end token."""
        inside = WORD_BYTES[b]
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        begin = cuts[:-1][cuts[:-1] < len(b)]
        first[begin] |= inside[begin]
        starts = np.flatnonzero(first)
        offsets = np.append(np.cumsum(inside)[starts] - 1, np.count_nonzero(inside)).astype(np.int32)
        # equal chunks of these texts are found by Arrow
        chunks = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(b[inside])]).dictionary_encode()
        ids, n, begin = self.chunks(chunks.dictionary.to_pylist())
        at = chunks.indices.to_numpy()
        ends = np.concatenate(([0], np.cumsum(n[at])))[np.searchsorted(starts, cuts)]
        ids = gather(ids, begin[at], n[at])
        return [np.append(ids[s:e], np.uint32(END)) for s, e in zip(ends[:-1], ends[1:], strict=True)]


_encoders: dict[str, Encoder] = {}


def encoded(vocabulary: str, texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, ids) of each text."""
    if vocabulary not in _encoders:
        _encoders[vocabulary] = Encoder(vocabulary)  # merges alone, a few MB
    encoder = _encoders[vocabulary]
    data, offs = buffers(texts)
    for lo, hi in runs(offs, 16 * RUN):
        yield from enumerate(encoder.encode(data[offs[lo] : offs[hi]], offs[lo : hi + 1] - offs[lo]), lo)


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(np.ascontiguousarray(ids, "<u4").tobytes())


PIECE = "doc_id long, text_hash long, start long, length long, ids_crc32 long, doc_tokens long"


def _pieces(vocabulary: str, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, start, length, crc, total = [], [], [], [], []
            for r, ids in encoded(vocabulary, batch["text"]):
                for s in range(0, len(ids), window):
                    part = ids[s : s + window]
                    row.append(r)
                    start.append(s)
                    length.append(len(part))
                    crc.append(checksum(part))
                    total.append(len(ids))
            at = pa.array(row, pa.int64())
            numbers = [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(pa.int64()).take(at), batch["text_hash"].take(at), *numbers], ["doc_id", "text_hash", "start", "length", "ids_crc32", "doc_tokens"])

    return tidy(run)


def fill(counts: dict[int, int], room: int) -> tuple[int, dict[int, int]]:
    """The sum closest to ``room`` from below that a sub-multiset of ``counts`` has, and its counts.

    Bits of ``sums`` are the sums reached; counts are split in powers of two. Lengths of which
    there are most come first, so that the pattern found can be used often.
    """
    mask, sums, steps = (1 << (room + 1)) - 1, 1, []
    for length, n in counts.items():
        left, part = min(n, room // length), 1
        while left > 0 and not sums >> room & 1:
            part = min(part, left)
            more = (sums | sums << part * length) & mask
            if more != sums:
                steps.append((length, part, sums))
                sums = more
            left -= part
            part *= 2
        if sums >> room & 1:
            break
    best = at = sums.bit_length() - 1
    used: dict[int, int] = {}
    for length, part, before in reversed(steps):
        if not before >> at & 1:
            used[length] = used.get(length, 0) + part
            at -= part * length
    return best, used


def plan(histogram: dict[int, int], window: int = WINDOW) -> tuple[np.ndarray, dict[int, tuple[int, int]], int, int]:
    """Where pieces go by length and rank.

    Rows (length, first rank, uses in a sequence, first sequence, offset) for whole windows;
    {length: (first rank, position)} for what is laid end to end after them; the number of whole
    windows; the number of tokens laid end to end.
    """
    left = dict(sorted(((n, c) for n, c in histogram.items() if c > 0), key=lambda x: -x[1]))
    done = dict.fromkeys(left, 0)
    rows, rest, sequence = [], {}, 0
    for longest in sorted(left, reverse=True):
        while left.get(longest, 0):
            left[longest] -= 1
            best, used = fill({n: c for n, c in left.items() if c}, window - longest)
            left[longest] += 1
            if longest + best < window:
                rest[longest] = left.pop(longest)
                break
            used[longest] = used.get(longest, 0) + 1
            times = min(left[n] // u for n, u in used.items())
            offset = 0
            for n, u in used.items():
                rows.append((n, done[n], u, sequence, offset))
                offset += n * u
                done[n] += u * times
                left[n] -= u * times
                if not left[n]:
                    del left[n]
            sequence += times
    position, tail = 0, {}
    for n, c in rest.items():
        tail[n] = (done[n], position)
        position += n * c
    return np.array(sorted(rows), np.int64).reshape(-1, 5), tail, sequence, position


def _ends(start: int, stop: int, total: int, window: int) -> list[tuple[int, int, int]]:
    """(sequence, begin of sequence, end of sequence) of the sequences that [start, stop) meets."""
    out, whole = [], total // window
    for k in range(start // window, min((stop - 1) // window + 1, whole)):
        out.append((k, k * window, (k + 1) * window))
    at, k, left = whole * window, whole, total % window
    while left and at < stop:
        size = 1 << (left.bit_length() - 1)
        if at + size > start:
            out.append((k, at, at + size))
        at, k, left = at + size, k + 1, left - size
    return out


def _place(rows: np.ndarray, tail: dict, sequence: int, total: int, window: int):
    names = ["doc_id", "text_hash", "piece", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = (rows[:, 0] << 44) + rows[:, 1]
        for b in batches:
            if not b.num_rows:
                continue
            length, rank = b["length"].to_numpy(), b["rank"].to_numpy()
            first = np.array([tail.get(n, (1 << 44, 0))[0] for n in length.tolist()], np.int64)
            late = rank >= first
            out = []
            fit = np.flatnonzero(~late)
            if len(fit):
                at = np.searchsorted(keys, (length[fit] << 44) + rank[fit], "right") - 1
                q = rank[fit] - rows[at, 1]
                part = b.take(pa.array(fit))
                own = [part[n] for n in names[:7]]
                out.append(pa.RecordBatch.from_arrays([*own, pa.array(rows[at, 3] + q // rows[at, 2]), pa.array(rows[at, 4] + q % rows[at, 2] * length[fit])], names))
            cut = []
            for r in np.flatnonzero(late).tolist():
                n = int(length[r])
                begin = tail[n][1] + (int(rank[r]) - tail[n][0]) * n
                meets = _ends(begin, begin + n, total, window)
                for k, lo, hi in meets:
                    s, e = max(begin, lo), min(begin + n, hi)
                    cut.append((r, s - begin, e - s, len(meets) == 1, sequence + k, s - lo))
            if cut:
                at, skip, size, whole, seq, off = (np.array(x) for x in zip(*cut, strict=True))
                part = b.take(pa.array(at))
                crc = pc.if_else(pa.array(whole), part["ids_crc32"], pa.scalar(None, pa.int64()))
                out.append(pa.RecordBatch.from_arrays([part["doc_id"], part["text_hash"], part["piece"], pa.array(part["start"].to_numpy() + skip), pa.array(size), crc, part["doc_tokens"], pa.array(seq), pa.array(off)], names))
            yield from out

    return run


def _again(vocabulary: str):
    """Checksums of a text's cut pieces: cuts are (start, length) lists."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cuts = b["cuts"]
            for r, ids in encoded(vocabulary, b["text"]):
                start, length = (cuts[r].values.field(c).to_numpy() for c in ("start", "length"))
                crc = [checksum(ids[s : s + n]) for s, n in zip(start.tolist(), length.tolist(), strict=True)]
                own = [b[c].take(pa.array(np.full(len(crc), r))) for c in ("doc_id", "text_hash")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(start), pa.array(length), pa.array(crc, pa.int64())], ["doc_id", "text_hash", "start", "length", "crc"])

    return tidy(run)


def packed(docs: DataFrame, vocabulary: str, window: int = WINDOW) -> DataFrame:
    """A row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    pieces = saved(texts.mapInArrow(_pieces(vocabulary, window), PIECE).withColumn("piece", F.monotonically_increasing_id()))
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most ``window`` rows
    rows, tail, sequence, total = plan(histogram, window)
    salts = max(SALTS, max(histogram.values(), default=0) // CELL)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("piece"), F.lit(salts)))
    cells = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = cells.select("length", "salt", F.coalesce(F.sum("n").over(W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    within = F.row_number().over(W.partitionBy("length", "salt").orderBy("piece"))
    ranked = salted.withColumn("place", within).join(before, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("place") - 1)
    placed = ranked.select("doc_id", "text_hash", "piece", "start", "length", "ids_crc32", "doc_tokens", "rank").mapInArrow(
        _place(rows, tail, sequence, total, window), "doc_id long, text_hash long, piece long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
    placed = saved(placed)
    # repeated rows have the same pieces: each text is encoded once more, for all its cut pieces
    key = ["doc_id", "text_hash"]
    where = ["start", "length"]
    late = placed.where("ids_crc32 is null")
    cuts = saved(late.groupBy(*key).agg(F.collect_set(F.struct(*where)).alias("cuts")))
    few = (cuts.agg(F.sum(32 + 16 * F.size("cuts"))).first()[0] or 0) <= SMALL
    cuts = cuts.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "cuts")
    meet = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    found = texts.join(F.broadcast(cuts) if few else cuts, meet).select(*key, "text", "cuts").dropDuplicates(key)
    crcs = found.mapInArrow(_again(vocabulary), "doc_id long, text_hash long, start long, length long, crc long")
    crcs = crcs.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.col("start").alias("_start"), F.col("length").alias("_length"), "crc")
    out = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    mended = late.drop("ids_crc32").join(crcs, meet & (F.col("start") == F.col("_start")) & (F.col("length") == F.col("_length"))).withColumnRenamed("crc", "ids_crc32")
    return placed.where("ids_crc32 is not null").select(*out).unionByName(mended.select(*out))
