"""Language identification by a byte convolutional network, trained here in numpy.

Bytes (lower-cased A-Z) are embedded; filters of several widths run over a window of ``WINDOW``
bytes; the largest response of each filter in the window goes through a softmax layer. Whole texts
are cut into windows, and a text's prediction is the mean of its windows' log-probabilities, each
weighted by its bytes.

An embedding followed by a filter is a table of one number for each byte, filter and place, so a
window costs one matrix product of its one-hot bytes' embeddings.

Only training is bounded: ``TRAIN_ROWS`` labelled documents in order of a hash of the id, dealt
evenly over the languages as far as there are that many (one of each at least), and of these as
many as have ``TRAIN_BYTES`` in all, each with its whole text. Rows of one id and text are learned once.

Defined cases: a null text or one without a letter is ``und`` with score 1; without any learnable
row all are ``und`` with score 0; null languages aren't learned; null ids are not held out;
repeated rows are predicted each; an empty table gives an empty result; extra columns don't
matter.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.llm.text import LOWER, buffers, runs, tidy
from gristmill.sources.stores import saved

WINDOW, WIDTHS, FILTERS, DIM = 256, (2, 3, 4), 8, 4
TRAIN_ROWS, TRAIN_BYTES, EPOCHS, RATE = 1200, 6_000_000, 1, 0.01
LONGEST = max(WIDTHS)


class Net:
    """Embedding, filters of each width (as filters of the largest, with zeros), max, softmax."""

    def __init__(self, classes: int, seed: int = 3):
        rng = np.random.default_rng(seed)
        k = FILTERS * len(WIDTHS)
        self.mask = np.concatenate([np.repeat((np.arange(LONGEST) < w)[:, None], FILTERS, 1) for w in WIDTHS], 1)  # place x filter
        self.mask = np.repeat(self.mask[:, None], DIM, 1).reshape(LONGEST * DIM, k).astype(np.float32)
        self.p = {
            "e": rng.normal(0, 0.5, (256, DIM)).astype(np.float32), "f": rng.normal(0, 0.3, (LONGEST * DIM, k)).astype(np.float32) * self.mask,
            "b": np.zeros(k, np.float32), "w": rng.normal(0, 0.1, (k, classes)).astype(np.float32), "c": np.zeros(classes, np.float32),
        }

    def hidden(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Responses of each filter at each place of windows x (n x WINDOW bytes)."""
        e = self.p["e"][x].reshape(len(x), -1)
        at = np.lib.stride_tricks.as_strided(e, (len(x), WINDOW - LONGEST + 1, LONGEST * DIM), (e.strides[0], DIM * e.itemsize, e.itemsize))
        return at, at.reshape(-1, LONGEST * DIM) @ self.p["f"]

    def logits(self, x: np.ndarray) -> np.ndarray:
        _, h = self.hidden(x)
        top = h.reshape(len(x), -1, h.shape[1]).max(1) + self.p["b"]
        return np.maximum(top, 0) @ self.p["w"] + self.p["c"]

    def gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        at, h = self.hidden(x)
        h = h.reshape(len(x), -1, h.shape[1])
        best = h.argmax(1)
        n, k = best.shape
        top = np.take_along_axis(h, best[:, None], 1)[:, 0] + self.p["b"]
        act = np.maximum(top, 0)
        z = act @ self.p["w"] + self.p["c"]
        z = np.exp(z - z.max(1, keepdims=True))
        z /= z.sum(1, keepdims=True)
        z[np.arange(n), y] -= 1
        z /= n
        d = (z @ self.p["w"].T) * (top > 0)
        seen = at[np.arange(n)[:, None], best]  # n x k x LONGEST*DIM
        back = d[:, :, None] * self.p["f"].T[None]  # to the embeddings
        e = np.zeros_like(self.p["e"])
        bytes_ = x[np.arange(n)[:, None, None], best[:, :, None] + np.arange(LONGEST)]
        np.add.at(e, bytes_.ravel(), back.reshape(-1, DIM))
        return {"e": e, "f": np.einsum("nk,nkj->jk", d, seen) * self.mask, "b": d.sum(0), "w": act.T @ z, "c": z.sum(0)}


def windows(b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A text's bytes as rows of WINDOW (the last filled with spaces) and the bytes in each."""
    n = max(1, -(-len(b) // WINDOW))
    out = np.full(n * WINDOW, 32, np.uint8)
    out[: len(b)] = b
    return out.reshape(n, WINDOW), np.diff(np.minimum(np.arange(n + 1) * WINDOW, max(len(b), 1)))


def train(docs: DataFrame, folds: int = 3, held: int = 1) -> tuple[list[str], dict[str, np.ndarray]] | None:
    """The languages and the network's parameters; None where there is nothing to learn from."""
    crc = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds))
    known = docs.select("doc_id", "lang").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.coalesce(crc != held, F.lit(True)))
    counts = known.groupBy("lang").agg(F.count("*").alias("n")).collect()  # a row for each language
    if not counts:
        return None
    langs = sorted(r["lang"] for r in counts)
    # about so many of each language, by a hash that any size of input can thin by
    share = {r["lang"]: min(1.0, 1.5 * TRAIN_ROWS / len(langs) / r["n"] + 20 / r["n"]) for r in counts}
    key = F.concat_ws("|", F.lit("lang"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    thin = F.pmod(F.xxhash64(key), F.lit(1 << 30)) / F.lit(float(1 << 30)) < F.create_map(*(F.lit(v) for kv in share.items() for v in kv))[F.col("lang")]
    picked = docs.select("doc_id", "lang", "text").where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.coalesce(crc != held, F.lit(True)) & thin)
    rows = picked.select("lang", "text", F.md5(key).alias("place"), F.xxhash64("text").alias("tie")).dropDuplicates(["lang", "place", "tie"])
    each = max(1, TRAIN_ROWS // len(langs))
    ranked = rows.withColumn("rn", F.row_number().over(W.partitionBy("lang").orderBy("place", "tie"))).where(F.col("rn") <= each)
    ranked = saved(ranked.withColumn("size", F.octet_length("text")))
    order = ["rn", "place", "tie"]
    sizes = ranked.select(*order, "size").orderBy(*order).collect()  # at most TRAIN_ROWS, or one of each language
    fit = max(int(np.searchsorted(np.cumsum([r["size"] for r in sizes]), TRAIN_BYTES, "right")), len(langs))
    last = sizes[min(fit, len(sizes)) - 1]
    taken = ranked.where(F.struct(*order) <= F.struct(*(F.lit(last[c]) for c in order)))
    rows = sorted(taken.select("lang", "text", *order).collect(), key=lambda r: (r["place"], r["tie"], r["lang"]))
    x = [windows(LOWER[np.frombuffer(r["text"].encode(), np.uint8)])[0] for r in rows]
    y = np.repeat([langs.index(r["lang"]) for r in rows], [len(v) for v in x])
    x = np.concatenate(x)
    net, rng = Net(len(langs)), np.random.default_rng(11)
    m, v, step = {k: np.zeros_like(p) for k, p in net.p.items()}, {k: np.zeros_like(p) for k, p in net.p.items()}, 0
    for _ in range(max(EPOCHS, -(-400 * 64 // max(len(x), 1)))):  # 400 steps at least
        order = rng.permutation(len(x))
        for lo in range(0, len(x), 64):
            at = order[lo : lo + 64]
            step += 1
            for k, g in net.gradients(x[at], y[at]).items():  # Adam
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.999 * v[k] + 0.001 * g * g
                net.p[k] -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
    return langs, net.p


def _letters(texts: pa.Array, data: np.ndarray, offs: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Which rows have a letter; only texts without an ASCII one are looked at in Python."""
    b = data[offs[lo] : offs[hi]] | 0x20
    sums = np.concatenate(([0], np.cumsum((b >= 97) & (b <= 122) & (data[offs[lo] : offs[hi]] < 128))))
    cuts = offs[lo : hi + 1] - offs[lo]
    has = sums[cuts[1:]] > sums[cuts[:-1]]
    for r in np.flatnonzero(~has):
        has[r] = any(c.isalpha() for c in (texts[lo + int(r)].as_py() or ""))
    return has


def _predict(langs: list[str], params: dict[str, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Net(len(langs))
        net.p = params
        for batch in batches:
            texts = batch["text"]
            data, offs = buffers(texts)
            names, scores = [], []
            for lo, hi in runs(offs):
                parts = [windows(LOWER[data[offs[r] : offs[r + 1]]]) for r in range(lo, hi)]
                owner = np.repeat(np.arange(hi - lo), [len(x) for x, _ in parts])
                total = np.zeros((hi - lo, len(langs)))
                size = np.zeros(hi - lo)
                x, n = np.concatenate([x for x, _ in parts]), np.concatenate([n for _, n in parts])
                for a in range(0, len(x), 256):
                    z = net.logits(x[a : a + 256]).astype(np.float64)
                    z -= z.max(1, keepdims=True)
                    z -= np.log(np.exp(z).sum(1, keepdims=True))
                    np.add.at(total, owner[a : a + 256], z * n[a : a + 256, None])
                    np.add.at(size, owner[a : a + 256], n[a : a + 256])
                p = np.exp(total / np.maximum(size, 1)[:, None])
                p /= p.sum(1, keepdims=True)
                has = _letters(texts, data, offs, lo, hi)
                best = p.argmax(1)
                names += [langs[k] if h else "und" for k, h in zip(best.tolist(), has.tolist(), strict=True)]
                scores += np.where(has, p[np.arange(hi - lo), best], 1.0).tolist()
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return run


def predicted(docs: DataFrame, folds: int = 3, held: int = 1) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for each row of ``docs``."""
    model = train(docs, folds, held)
    out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(folds)) == held, F.lit(False)).alias("held_out")
    if model is None:
        return docs.select("doc_id", out, F.lit("und").alias("lang_pred"), F.lit(0.0).alias("score"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    made = docs.select("doc_id", "text").mapInArrow(tidy(_predict(*model)), f"doc_id {kind}, lang_pred string, score double")
    return made.select("doc_id", out, "lang_pred", "score")
