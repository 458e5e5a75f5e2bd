"""Importance resampling towards a target distribution by hashed word n-grams.

One scan of a text keeps a ring of running zlib states, one for each of the last n starts. A new word
extends every state by a space and the word and begins one of its own, so each state is then the CRC of
an n-gram that ends here, and no n-gram is ever built as a string. States modulo the number of buckets
are the features.

The corpus is scanned twice: once for the counts of all buckets, summed within tasks before they are
shuffled, and once for the weights, when the gains of all buckets are known. Counts and gains are one
number for each bucket. Scores get Gumbel noise from a hash of the id, so the highest scores are a draw
without replacement in proportion to the importance weights.

Ranks need no single task: rows that can be drawn are dealt by ranges of (score, id, row number), ranges
are numbered by the counts of those before, and the row number cuts groups of equal rows.

Defined cases: a null text has no words; a null id hashes as an empty one and comes last among equal
scores; repeated rows are drawn each for itself, in any order of theirs, which are alike; an empty corpus gives no rows;
an empty target has the same counts for all buckets; extra columns don't matter.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Callable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.llm.text import buffers, tidy
from gristmill.sources.stores import saved

BUCKETS, LONGEST = 10_000, 3
#: Words at least of a document that may be drawn, and the share drawn in hundredths.
WORDS, SHARE = 20, 5
SEED = "42"
#: Bytes of lower-cased words, [^\x00-\x2F\x3A-\x60\x7B-\x7F] in UTF-8, stay; A-Z are lowered and all others become spaces.
KEPT = bytes(b if b >= 128 or 48 <= b < 58 or 97 <= b < 123 else b + 32 if 65 <= b < 91 else 32 for b in range(256))
#: Bytes of a text whose words are held at once.
HELD = 1 << 18


def words(text: bytes) -> Iterator[list[bytes]]:
    """The words of a text in order, in blocks of about HELD bytes."""
    flat, lo = text.translate(KEPT), 0
    while lo < len(flat):
        hi = flat.find(b" ", lo + HELD)
        hi = hi if hi >= 0 else len(flat)
        yield flat[lo:hi].split()
        lo = hi


def emitted(text: bytes, buckets: int = BUCKETS, longest: int = LONGEST) -> Iterator[np.ndarray]:
    """Buckets of all runs of 1 to ``longest`` words, joined by one space.

    ring[k] is the zlib state of the run of k + 1 words that ends at the last word of the block before. Within a
    block each state is extended by the space and the word after it, all starts of one length in one pass.
    """
    ring: list[list[int]] = [[] for _ in range(longest)]
    for block in words(text):
        if not block:
            continue
        spaced = [b" " + w for w in block]
        states = list(map(crc32, block))
        for k in range(longest):
            yield np.frombuffer(array("I", states), np.uint32) % np.uint32(buckets)
            before, ring[k] = ring[k] + states[:-1], states[-1:] or ring[k]
            states = list(map(crc32, spaced[len(spaced) - len(before) :], before))


def _texts(batch: pa.RecordBatch) -> Iterator[bytes]:
    data, offs = buffers(batch["text"])
    for lo, hi in zip(offs[:-1].tolist(), offs[1:].tolist(), strict=True):
        yield data[lo:hi].tobytes()


def _count(buckets: int, longest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row for each bucket that a task has met."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, wait, size = np.zeros(buckets, np.int64), [np.zeros(0, np.uint32)], 0
        for batch in batches:
            for text in _texts(batch):
                for at in emitted(text, buckets, longest):
                    wait.append(at)
                    size += len(at)
                if size > HELD:
                    total += np.bincount(np.concatenate(wait), minlength=buckets)
                    wait, size = [wait[0]], 0
        total += np.bincount(np.concatenate(wait), minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met, pa.int64()), pa.array(total[met], pa.int64())], ["bucket", "n"])

    return run


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(bucket, n) of all texts: at most ``buckets`` rows leave each task."""
    return texts.select("text").mapInArrow(tidy(_count(buckets, longest)), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) of each bucket, in doubles."""
    size = len(source)
    more, less = float(source.sum() + size), float(target.sum() + size)
    return np.array([math.floor(1000 * math.log((t + 1) * more / ((s + 1) * less))) for s, t in zip(source.tolist(), target.tolist(), strict=True)], np.int64)


def _weigh(gain: np.ndarray, longest: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, weight = [], []
            for text in _texts(batch):
                n.append(0)
                weight.append(0)
                for at in emitted(text, len(gain), longest):
                    n[-1] += len(at)
                    weight[-1] += int(gain[at].sum())
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(n, pa.int64()), pa.array(weight, pa.int64())], ["doc_id", "n_features", "weight"])

    return run


def noise(key: Column, seed: str = SEED) -> Column:
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of sha256('<seed>:<key>')."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(key.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def least_features(words: int, longest: int = LONGEST) -> int:
    """Features of a text with so many words."""
    return sum(max(words - k, 0) for k in range(longest))


def ranked(rows: DataFrame, score: str, key: str, take: int) -> DataFrame:
    """``rows`` with rank (1, 2, ...) of the ``take`` highest scores, ties to the smaller key; the rest null.

    ``rows`` must be a saved table: its row numbers have to be the same in every reading.
    """
    order = [F.desc(score), F.asc_nulls_last(key), F.asc("_row")]
    dealt = saved(rows.withColumn("_row", F.monotonically_increasing_id()).repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)  # one row for each range
    start = dealt.groupBy("_part").agg(F.count("*").alias("n")).select("_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    place = (F.col("_before") + F.row_number().over(W.partitionBy("_part").orderBy(*order))).cast("long")
    return dealt.join(F.broadcast(start), "_part").withColumn("rank", F.when(place <= take, place)).drop("_row", "_part", "_before")


def resampled(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, longest: int = LONGEST, words: int = WORDS, share: int = SHARE, seed: str = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every document; rank is null where it isn't drawn."""
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    counts = []
    for texts in (own, target.select("text")):
        n = np.zeros(buckets, np.int64)
        for r in bucket_counts(texts, buckets, longest).collect():  # at most ``buckets`` rows
            n[r["bucket"]] = r["n"]
        counts.append(n)
    kind = own.schema["doc_id"].dataType.simpleString()
    weighed = own.mapInArrow(tidy(_weigh(gains(*counts), longest)), f"doc_id {kind}, n_features long, weight long")
    scored = saved(weighed.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)))
    enough = F.col("n_features") >= least_features(words, longest)
    take = share * scored.where(enough).count() // 100
    rest = scored.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    return ranked(scored.where(enough), "score", "doc_id", take).unionByName(rest)


def drawn(docs: DataFrame, target: DataFrame, **settings) -> DataFrame:
    """The draw itself: rows of ``docs`` whose id is drawn, with their rank.

    Ids are taken to name rows; where several rows share one, all of them come, with the best rank.
    """
    ranks = resampled(docs, target, **settings).where("rank is not null").groupBy("doc_id").agg(F.min("rank").alias("_rank"))
    ranks = ranks.withColumnRenamed("doc_id", "_drawn")
    return docs.join(ranks, F.col("doc_id").eqNullSafe(F.col("_drawn"))).drop("_drawn")


#: A CRC is affine: that of as many zero bytes, and for each byte a number that depends on its distance from the end.
RESAMPLED_SQL = r"""
WITH RECURSIVE t AS (SELECT b, list_reduce(list_concat([b], range(8)), lambda c, _: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(b)),
d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, text FROM documents),
u AS (SELECT 'd' AS side, row, text FROM d UNION ALL SELECT 'b', 0, text FROM benchmark),
w AS (SELECT side, row, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM u),
f AS MATERIALIZED (SELECT side, row, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i : i + k - 1], ' '))) AS f FROM w, range(1, 4) r(k)),
g AS MATERIALIZED (SELECT f, hex(encode(f)) AS h, octet_length(encode(f)) AS n FROM (SELECT DISTINCT f FROM f)),
l AS (SELECT 0 AS far, b, c FROM t UNION ALL SELECT far + 1, l.b, xor(l.c >> 8, t.c) FROM l JOIN t ON t.b = l.c & 255 WHERE far < (SELECT max(n) FROM g)),
z AS (SELECT 0 AS n, 4294967295 AS c UNION ALL SELECT n + 1, xor(z.c >> 8, t.c) FROM z JOIN t ON t.b = z.c & 255 WHERE n < (SELECT max(n) FROM g)),
x AS (SELECT f, n, unnest(range(n)) AS i, h FROM g),
y AS (SELECT f, n, bit_xor(l.c) AS c FROM x JOIN l ON l.far = n - 1 - i AND l.b = ('0x' || substr(h, (2 * i + 1)::BIGINT, 2))::INTEGER GROUP BY f, n),
h AS MATERIALIZED (SELECT f, xor(xor(y.c, z.c), 4294967295) % 10000 AS bucket FROM y JOIN z USING (n)),
c AS (SELECT bucket, count(*) FILTER (side = 'd') AS s, count(*) FILTER (side = 'b') AS t FROM f JOIN h USING (f) GROUP BY bucket),
k AS (SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM c),
e AS (SELECT row, count(*) AS n, sum(gain) AS weight FROM f JOIN h USING (f) JOIN k USING (bucket) WHERE side = 'd' GROUP BY row),
s AS (SELECT d.row, doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT::DOUBLE + 0.5::DOUBLE) / 4294967296.0::DOUBLE)))::BIGINT AS score
      FROM d LEFT JOIN e USING (row)),
r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 57 ORDER BY score DESC, doc_id) AS place, 5 * count(*) FILTER (n_features >= 57) OVER () // 100 AS take FROM s)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 57 AND place <= take THEN place END AS rank FROM r
"""
