"""MinHash near-dedup by a signature-coordinate inverted join.

1. A text's set of word shingles gives a key (equal sets, equal keys) and a signature of
   ``COORDS`` MinHash coordinates. Each class of equal sets goes on as its smallest document.
2. Each (coordinate, value) is a posting. Classes that reach the match threshold must share at
   least that many postings with someone; others drop out. Of the m shared postings in order of
   rarity only the first m - t + 1 are kept (prefix filter): two signatures that agree in t
   coordinates have one of them in common.
3. Posting lists are merged by groups: collisions are counted over blocks of coordinates, and a
   pair is skipped as soon as it can't reach t any more. What leaves a group is each member's
   smallest matched partner chain, never its pairs, so rows stay linear in the members. Groups
   beyond ``GROUP`` members first meet one member (a star); only those that don't match it are
   compared with the others, in blocks.
4. Candidate families are components of these links. Within a family the full sets confirm each
   link (exact counts over an inverted index), again in blocks and one member first, and components of
   confirmed links are the result.

t is the largest count that a pair at the least similarity misses with a chance of at most MISS.

Defined cases: null or blank texts have an empty set, are linked with nothing and kept; null ids
likewise, with component_id null; repeated rows fall in one class; an empty table gives an empty
result; extra columns don't matter. Ids are taken as unique; rows that share one stay separate.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.text import distinct, mix, powers, quoted, shingles, tidy, words
from gristmill.operators.graph import connected_components
from gristmill.sources.stores import discard, saved

COORDS, MISS, GROUP = 48, 1e-5, 512
#: Shingles in a block of a family, about 16 MB.
BLOCK = 2_000_000
#: Rows of families that may be broadcast (16 bytes each); more are joined by a shuffle.
SMALL = 500_000


def threshold(similarity: float, coords: int = COORDS, miss: float = MISS) -> int:
    below, t = 0.0, 0
    while t < coords:
        below += math.comb(coords, t) * similarity**t * (1 - similarity) ** (coords - t)
        if below > miss:
            break
        t += 1
    return max(t, 1)


def _signatures(k: int, coords: int):
    rng = np.random.default_rng(7)
    a, b = (rng.integers(1, 2**63, coords, np.uint64) | np.uint64(1)), rng.integers(0, 2**63, coords, np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, keys, sigs = [], [], []
            for w in words(batch["text"]):
                values, rows = distinct(*shingles(w, k))
                n = np.diff(rows)
                counts.append(n)
                full = n > 0
                at = rows[:-1][full]
                key, sig = np.zeros((w.hi - w.lo, 2), np.uint64), np.zeros((w.hi - w.lo, coords), np.uint32)
                if len(values):
                    key[full, 0] = np.add.reduceat(mix(values), at)
                    key[full, 1] = np.add.reduceat(mix(values ^ np.uint64(0x5851F42D4C957F2D)), at)
                    for c in range(coords):
                        sig[full, c] = (np.minimum.reduceat(values * a[c] + b[c], at) >> np.uint64(32)).astype(np.uint32)
                keys.append(key)
                sigs.append(sig)
            n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
            empty = pa.array(n == 0)
            packed = [_packed(np.concatenate(x), empty) if x else pa.array([], pa.binary()) for x in (keys, sigs)]
            yield pa.RecordBatch.from_arrays([batch["doc_id"].cast(pa.int64()), pa.array(n, pa.int64()), *packed], ["doc_id", "n_shingles", "key", "sig"])

    return run


def _packed(rows: np.ndarray, null: pa.Array) -> pa.Array:
    """One binary value for each row of a matrix; null where said."""
    width = rows.shape[1] * rows.itemsize
    made = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(np.arange(0, (len(rows) + 1) * width, width, dtype=np.int32)), pa.py_buffer(np.ascontiguousarray(rows))])
    return pc.if_else(null, pa.scalar(None, pa.binary()), made)


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    """The reverse of _packed for a column without nulls."""
    if not len(column):
        return np.zeros((0, 1), kind)
    _, offsets, data = column.buffers()
    offs = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[offs[0] : offs[-1]].view(kind).reshape(len(column), -1)


def _postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, 4096):
            part = batch.slice(lo, 4096)
            sig = _matrix(part["sig"], np.uint32)
            p = (np.arange(sig.shape[1], dtype=np.int64) << 32) + sig
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(part["rep"].to_numpy(), sig.shape[1])), pa.array(p.ravel())], ["rep", "p"])


def _labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index that each of n nodes reaches over edges (i, j)."""
    low = np.arange(n)
    while len(i):
        a, b = low[i], low[j]
        m = np.minimum(a, b)
        was = low.copy()
        for x in (a, b):
            np.minimum.at(low, x, m)
        low = low[low]
        if (low == was).all():
            if (low[i] == low[j]).all():
                break
    return low


def _agree(sa: np.ndarray, sb: np.ndarray, i: np.ndarray, j: np.ndarray, t: int) -> np.ndarray:
    """Which of the pairs (i, j) agree in t coordinates; a pair is skipped once it can't."""
    coords = sa.shape[1]
    alive, count = np.arange(len(i)), np.zeros(len(i), np.int16)
    for lo in range(0, coords, 8):
        hi = min(lo + 8, coords)
        count[alive] += (sa[i[alive], lo:hi] == sb[j[alive], lo:hi]).sum(1).astype(np.int16)
        alive = alive[count[alive] + (coords - hi) >= t]
    return alive


def _whole(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """Tables of whole groups from batches that are sorted by ``key``; the last group waits."""
    wait: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        ks = np.stack([batch[k].to_numpy() for k in key], 1)
        cut = np.flatnonzero((ks[1:] != ks[:-1]).any(1)) + 1
        if wait:
            last = [wait[-1][k][-1].as_py() for k in key]
            if list(ks[0]) != last:
                yield pa.Table.from_batches(wait)
                wait = []
        if len(cut):
            yield pa.Table.from_batches([*wait, batch.slice(0, cut[-1])])
            wait = [batch.slice(cut[-1])]
        else:
            wait.append(batch)
    if wait:
        yield pa.Table.from_batches(wait)


def _pairs(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All i < j within each of the row ranges."""
    i = np.repeat(np.arange(starts[0], ends[-1]), np.concatenate([e - 1 - np.arange(s, e) for s, e in zip(starts, ends, strict=True)]))
    first = np.concatenate(([True], i[1:] != i[:-1])) if len(i) else np.zeros(0, bool)
    at = np.flatnonzero(first)
    return i, i + 1 + np.arange(len(i)) - np.repeat(at, np.diff(np.concatenate((at, [len(i)]))))


def _merge(t: int):
    """Links of one group or pair of blocks: rows of side 0 meet rows of side 1, 2 is both."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _whole(batches, ["g", "i", "j"]):
            whole = whole.combine_chunks()
            col = lambda name: whole[name].chunk(0)  # noqa: B023, E731
            ks = np.stack([col(k).to_numpy() for k in ("g", "i", "j")], 1)
            sig, rep, side = _matrix(col("sig"), np.uint32), col("rep").to_numpy(), col("side").to_numpy()
            cut = np.concatenate(([0], np.flatnonzero((ks[1:] != ks[:-1]).any(1)) + 1, [len(ks)]))
            lo = 0
            while lo < len(cut) - 1:  # as many groups at once as give a million pairs
                hi, todo = lo, 0
                while hi < len(cut) - 1 and (hi == lo or todo + (cut[hi + 1] - cut[hi]) ** 2 / 2 < 500_000):
                    todo += (cut[hi + 1] - cut[hi]) ** 2 / 2
                    hi += 1
                a, b = _pairs(cut[lo:hi], cut[lo + 1 : hi + 1])
                meet = (side[a] == 2) | (side[a] != side[b])
                a, b = a[meet], b[meet]
                got = _agree(sig, sig, a, b, t)
                a, b = a[got], b[got]
                at, base = np.unique(np.concatenate((a, b)), return_inverse=True)
                low = _labels(len(at), base[: len(a)], base[len(a) :])
                yield pa.RecordBatch.from_arrays([pa.array(rep[at]), pa.array(rep[at[low]])], ["src", "dst"])
                lo = hi

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for w in words(batch["text"]):
                values, rows = distinct(*shingles(w, k))
                part = batch.slice(w.lo, w.hi - w.lo)
                made = pa.Array.from_buffers(pa.large_binary(), w.hi - w.lo, [None, pa.py_buffer((rows * 8).astype(np.int64)), pa.py_buffer(values)]).cast(pa.binary())
                yield pa.RecordBatch.from_arrays([part["node"], part["family"], part["blocks"], made], ["node", "family", "blocks", "items"])

    return run


def _overlaps(sets: list[np.ndarray], similarity: tuple[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of sets with num * union <= den * intersection, by counts over an inverted index.

    All sets meet the first one; only those that aren't linked with it meet the others too. The sets linked with
    the first are linked through it, so the components are those of all pairs.
    """
    num, den = similarity
    size = np.array([len(s) for s in sets])
    items, ids = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), size)
    order = np.argsort(ids, kind="stable")
    lists, starts = owner[order], np.concatenate(([0], np.cumsum(np.bincount(ids, minlength=len(items)))))
    at = np.concatenate(([0], np.cumsum(size)))

    def linked(i: int) -> np.ndarray:
        own = ids[at[i] : at[i + 1]]
        s, e = starts[own], starts[own + 1]
        n = e - s
        pick = np.repeat(s - np.concatenate(([0], np.cumsum(n[:-1]))), n) + np.arange(n.sum())
        both = np.bincount(lists[pick], minlength=len(sets))
        return den * both >= num * (size[i] + size - both)

    near = linked(0)
    right = [np.flatnonzero(near)]
    left = [np.zeros(len(right[0]), int)]
    for i in np.flatnonzero(~near):
        right.append(np.flatnonzero(linked(i)))
        left.append(np.full(len(right[-1]), i))
    return np.concatenate(left), np.concatenate(right)


def _confirm(similarity: tuple[int, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _whole(batches, ["family", "i", "j"]):
            whole = whole.combine_chunks()
            ks = np.stack([whole[k].to_numpy() for k in ("family", "i", "j")], 1)
            node = whole["node"].to_numpy()
            cut = np.concatenate(([0], np.flatnonzero((ks[1:] != ks[:-1]).any(1)) + 1, [len(ks)]))
            src, dst = [], []
            for lo, hi in zip(cut[:-1], cut[1:], strict=True):
                sets = [np.frombuffer(x.as_py(), np.uint64) for x in whole["items"].slice(lo, hi - lo)]
                i, j = _overlaps(sets, similarity)
                if len(i):
                    low = _labels(hi - lo, i, j)
                    moved = np.flatnonzero(low != np.arange(hi - lo))
                    src.append(node[lo + moved])
                    dst.append(node[lo + low[moved]])
            if src:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(src)), pa.array(np.concatenate(dst))], ["src", "dst"])

    return run


EDGES = "src long, dst long"


def _families(reps: DataFrame, t: int) -> DataFrame:
    """(node, component), written: classes joined by chains of signatures that agree in t coordinates."""
    posted = reps.select("rep", "sig").mapInArrow(tidy(_postings), "rep long, p long")
    shared = posted.groupBy("p").agg(F.count("*").alias("n")).where("n > 1")
    mine = posted.join(shared, "p").groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("n", "p"))).alias("all")).where(F.size("all") >= t)
    prefix = saved(mine.select("rep", F.explode(F.slice("all", F.lit(1), F.size("all") - t + 1)).alias("x")).select("rep", F.col("x.p").alias("p")))
    lists = prefix.groupBy("p").agg(F.count("*").alias("n"), F.min("rep").alias("g")).where("n > 1").select("p", "g")
    member = saved(prefix.join(lists, "p").select("g", "rep").distinct())
    discard(prefix)
    sized = saved(member.groupBy("g").agg(F.count("*").alias("m")).where("m > 1"))
    spent = [member, sized]
    sig = reps.select("rep", "sig")
    small = member.join(sized.where(F.col("m") <= GROUP), "g").select("g", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(2).alias("side"), "rep").join(sig, "rep")
    rows = [small]
    edges = []
    if sized.where(F.col("m") > GROUP).limit(1).count():
        large = member.join(sized.where(F.col("m") > GROUP), "g").join(sig, "rep")
        head = sig.select(F.col("rep").alias("g"), F.col("sig").alias("head"))
        met = saved(large.join(head, "g").mapInArrow(_star(t), "g long, m long, rep long, sig binary, near boolean"))
        spent.append(met)
        edges.append(met.where("near").select(F.col("rep").alias("src"), F.col("g").alias("dst")))
        far = met.where("not near").groupBy("g").agg(F.count("*").alias("far"))
        blocks = lambda n: F.ceil(F.col(n) / GROUP).cast("int")
        both = met.join(far, "g").withColumns({"nr": blocks("far"), "na": blocks("m")})
        own = F.pmod(F.xxhash64("rep"), F.lit(1 << 30)).cast("int")
        one = both.where("not near").select("g", F.pmod(own, F.col("nr")).alias("i"), F.explode(F.sequence(F.lit(0), F.col("na") - 1)).alias("j"), F.lit(0).alias("side"), "rep", "sig")
        other = both.select("g", F.explode(F.sequence(F.lit(0), F.col("nr") - 1)).alias("i"), F.pmod(own, F.col("na")).alias("j"), F.lit(1).alias("side"), "rep", "sig")
        rows += [one, other]
    cols = ["g", "i", "j", "side", "rep", "sig"]
    for r in rows:
        ordered = r.select(*cols).repartition("g", "i", "j").sortWithinPartitions("g", "i", "j")
        edges.append(ordered.mapInArrow(tidy(_merge(t)), EDGES))
    every = edges[0]
    for e in edges[1:]:
        every = every.union(e)
    made = saved(connected_components(every))
    discard(*spent)
    return made


def _star(t: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                near = (_matrix(b["sig"], np.uint32) == _matrix(b["head"], np.uint32)).sum(1) >= t
                yield pa.RecordBatch.from_arrays([b["g"], b["m"], b["rep"], b["sig"], pa.array(near)], ["g", "m", "rep", "sig", "near"])

    return run


def components(docs: DataFrame, k: int = 5, similarity: float = 0.8, coords: int = COORDS, spent: list | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``.

    ``spent`` gets the working tables that the result reads.
    """
    powers(1, np.uint64(3))
    made = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(_signatures(k, coords)), "doc_id long, n_shingles long, key binary, sig binary")
    rows = saved(made)
    reps = saved(rows.where("key is not null and doc_id is not null").groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n")))
    families = _families(reps, threshold(similarity, coords))
    sizes = families.join(reps.select(F.col("rep").alias("node"), "n"), "node").groupBy("component").agg(F.sum("n").alias("items"), F.count("*").alias("m"))
    blocks = sizes.where("m > 1").select("component", F.ceil(F.col("items") / BLOCK).cast("int").alias("blocks"))
    inside = saved(families.join(blocks, "component").select("node", F.col("component").alias("family"), "blocks"))
    few = inside.count() <= SMALL
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(F.broadcast(inside) if few else inside, "node")
    sets = texts.mapInArrow(tidy(_sets(k)), "node long, family long, blocks int, items binary")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    every = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least(x, own).alias("i"), F.greatest(x, own).alias("j")))
    placed = sets.withColumn("x", F.explode(every)).select("family", "x.i", "x.j", "node", "items")
    num = round(similarity * 100)
    links = placed.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j").mapInArrow(tidy(_confirm((num, 100))), EDGES)
    linked = saved(connected_components(links))
    discard(families, inside)
    if spent is not None:
        spent += [rows, reps, linked]
    named = reps.select("key", "rep").join(linked, F.col("rep") == F.col("node"), "left").select("key", F.coalesce("component", "rep").alias("component"))
    out = rows.select("doc_id", "n_shingles", "key").join(named, "key", "left")
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def deduped(docs: DataFrame, k: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` with one row of each component: the smallest id (null last), then the text's hash.

    Rows are told apart by a key of their own, so repeated and null ids are rows like others. Null and
    blank texts are in no group and stay; columns may have any names.
    """
    name = "_dedup_row"
    while name in map(str.lower, docs.columns):
        name += "_"
    rows = saved(docs.withColumn(name, F.monotonically_increasing_id()))
    spent: list = []
    found = components(rows.select(F.col(name).alias("doc_id"), "text"), k, similarity, spent=spent).select(F.col("doc_id").alias(name), F.col("component_id").alias("_component"))
    found = saved(found)
    discard(*spent)
    several = found.where(F.col(name) != F.col("_component")).select("_component").distinct()
    met = found.join(several, "_component").join(rows.select(name, F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("text"), F.col(name).alias("at")).alias("_rank")), name)
    met = saved(met.select(name, "_component", "_rank"))
    first = met.groupBy("_component").agg(F.min("_rank").alias("_rank")).select(F.col("_rank.at").alias(name))
    gone = saved(met.select(name).join(first, name, "left_anti"))
    discard(found, met)
    few = gone.count() <= SMALL
    return rows.join(F.broadcast(gone) if few else gone, name, "left_anti").select(*map(quoted, docs.columns))


#: The whole operator in SQL: exact sets, exact links, components by smallest id.
COMPONENTS_SQL = r"""
WITH RECURSIVE w AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) END) AS x
  FROM w WHERE ws IS NOT NULL),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS nboth FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS MATERIALIZED (SELECT a, b FROM common JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * nboth >= 85 * (na.n + nb.n - nboth)),
r AS (SELECT a AS doc_id, a AS root FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id),
c AS (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.root, d.doc_id) AS component_id, coalesce(c.root, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""
