"""Toxicity scores from an FTRL-proximal logistic regression over hashed n-grams.

Features of a text are the distinct hashed word unigrams, bigrams and skip-grams (a word and the
next but one). Words here are runs of letters and digits, lower-cased, so marks around a word
don't hide it. Training takes each labelled text in turn and updates only the coordinates it has,
at per-coordinate rates; L1 keeps most weights at exactly zero, and what is left is sent out as a
short table of (bucket, weight).

Only training is bounded: it takes at most ``TRAIN_ROWS`` labelled rows (in order of a hash of the
id) whose buckets are ``TRAIN_TOTAL`` in all, each row with all of its own. Rows of one id with the same
features are learned once.
Scores are of whole texts.

Defined cases: a null or empty text is scored by the bias alone; labels that are null are not
learned from, ids labelled twice count as the larger label; without any labelled row every score
is 0; null ids are not held out; repeated rows are scored each; an empty table gives an empty
result; extra columns don't matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.text import ALNUM_BYTES, mix, tidy, trim, words
from gristmill.sources.stores import discard, saved

BITS = 20
TRAIN_ROWS, TRAIN_TOTAL, EPOCHS = 8000, 24_000_000, 5
#: Chosen by log loss on a quarter of the rows that may be learned from, of eight settings.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 5.0, 0.0
CUT = 0.3
_SALTS = (np.uint64(0x9E6C63D0876A9A47), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9))


def features(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, buckets, local row of each bucket); repeats are not removed."""
    for w in words(texts, ALNUM_BYTES):
        n = np.diff(w.rows)
        row = np.repeat(np.arange(w.hi - w.lo), n)
        h = w.hashes
        made, rows = [mix(h ^ _SALTS[0])], [row]
        for gap in (1, 2):
            same = row[gap:] == row[:-gap]
            made.append(mix(h[:-gap] * _SALTS[gap] + h[gap:])[same])
            rows.append(row[gap:][same])
        yield w.lo, w.hi, (np.concatenate(made) >> np.uint64(64 - BITS)).astype(np.int32), np.concatenate(rows)


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bags = []
        for lo, hi, buckets, row in features(batch["text"]):
            order = np.argsort(row, kind="stable")
            cut = np.searchsorted(row[order], np.arange(hi - lo + 1))
            bags += [np.unique(buckets[order[a:b]]).tobytes() for a, b in zip(cut[:-1], cut[1:], strict=True)]
        yield pa.RecordBatch.from_arrays([batch["toxic"], batch["place"], pa.array(bags, pa.binary())], ["toxic", "place", "bag"])


class Ftrl:
    """FTRL-proximal (McMahan et al. 2013) on presence features with a bias."""

    def __init__(self, size: int):
        self.z, self.n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.z[at]
        w = -(z - np.sign(z) * L1) / ((BETA + np.sqrt(self.n[at])) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, at: np.ndarray, label: float) -> None:
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
        g = p - label
        step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        self.z[at] += g - step * w
        self.n[at] += g * g


def train(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2) -> tuple[np.ndarray, np.ndarray, float] | None:
    """Buckets and weights that aren't zero, and the bias; None without a labelled row."""
    known = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) != held)
    known = known.withColumn("place", F.md5(F.concat_ws("|", F.lit("ftrl"), F.col("doc_id").cast("string"))))
    known = saved(known.orderBy("place").limit(TRAIN_ROWS))
    joined = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")
    rows = joined.select("text", F.col("toxic").cast("int").alias("toxic"), "place").mapInArrow(tidy(_bags), "toxic int, place string, bag binary")
    rows = written = saved(rows.withColumn("tie", F.xxhash64("bag")).dropDuplicates(["place", "tie"]))
    order = ["place", "tie"]
    sizes = rows.select(*order, (F.length("bag") / 4).alias("n")).orderBy(*order).limit(TRAIN_ROWS).collect()
    taken = int(np.searchsorted(np.cumsum([r["n"] for r in sizes]), TRAIN_TOTAL, "right"))
    if sizes:
        last = sizes[min(max(taken, 1), len(sizes)) - 1]
        rows = rows.where(F.struct(*order) <= F.struct(F.lit(last["place"]), F.lit(last["tie"])))
    # at most TRAIN_ROWS rows and TRAIN_TOTAL buckets, or one row; a part at once, and then held only once
    rows = sorted(rows.coalesce(4).toLocalIterator(), key=lambda r: (r["place"], r["tie"]))
    discard(known, written)
    if not rows:
        return None
    truth, ends = [float(r["toxic"]) for r in rows], np.cumsum([0, *(len(r["bag"]) // 4 for r in rows)])
    flat = np.frombuffer(b"".join(r["bag"] for r in rows), np.int32)
    del rows
    trim()
    model, bias = Ftrl(1 << BITS), np.array([1 << BITS])
    rng = np.random.default_rng(5)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(truth)):
            model.learn(np.concatenate((flat[ends[i] : ends[i + 1]], bias)), truth[i])
    w = model.weights(np.arange((1 << BITS) + 1))
    del flat
    trim()
    kept = np.flatnonzero(w[:-1])
    return kept.astype(np.int32), w[kept], float(w[-1])


def _scores(model: tuple[np.ndarray, np.ndarray, float], name: str = "score"):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buckets, weights, bias = model
        dense = np.zeros(1 << BITS)
        dense[buckets] = weights
        for batch in batches:
            out = np.full(batch.num_rows, bias)
            for lo, hi, found, row in features(batch["text"]):
                hit = np.flatnonzero(dense[found])
                once = np.unique(row[hit] * (1 << BITS) + found[hit])
                out[lo:hi] += np.bincount(once >> BITS, dense[once & ((1 << BITS) - 1)], hi - lo)
            score = 1 / (1 + np.exp(-np.clip(out, -35, 35)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(score)], [*batch.schema.names, name])

    return run


def scored(docs: DataFrame, labels: DataFrame, folds: int = 4, held: int = 2) -> DataFrame:
    """doc_id, text, score of each row."""
    own = docs.select("doc_id", "text")
    model = train(docs, labels, folds, held)
    if model is None:
        return own.withColumn("score", F.lit(0.0))
    return own.mapInArrow(tidy(_scores(model)), f"doc_id {own.schema['doc_id'].dataType.simpleString()}, text string, score double")


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    held = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    return scored(docs, labels).select("doc_id", held.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))


def cleaned(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that score under ``CUT``.

    Null and empty texts have the bias's score; without any labelled row all rows stay; repeated rows stay
    or go together; columns may have any names.
    """
    model = train(docs, labels)
    if model is None:
        return docs
    plain = docs.toDF(*("text" if n == "text" else f"_k{i}" for i, n in enumerate(docs.columns)))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in plain.schema.fields)
    made = plain.mapInArrow(tidy(_scores(model, "_toxicity")), f"{schema}, _toxicity double")
    return made.where(F.col("_toxicity") < CUT).drop("_toxicity").toDF(*docs.columns)
