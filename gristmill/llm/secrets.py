r"""Secret scan with corpus-wide ownership frequency, in DataFrame functions only.

Three base patterns are searched in each whole text. A fourth, wider pattern takes long opaque
tokens that no keyword announces; whether such a token counts is for the corpus to say: candidate
values are hashed and aggregated by distinct repositories and owners (here: documents and
sources). A value seen with several owners, or in very many repositories of one or two, is a widely
copied example; one that one or two owners keep in a few places is live-looking. Base spans always stay and are told apart by ``n_live`` and ``n_example``;
an opaque token is reported only if it is live-looking. In ``digest`` opaque tokens have six digits
and six letters at least, as its SQL says; ``masked`` takes all with a digit and a letter.

Spans: the text is marked at each match, split at the marks, and lengths are summed, so positions
are in code points. The marks are two control characters; where a text holds them itself they
count as a third one, which no pattern matches either.

Defined cases: null text is empty; null owners or ids count as one value each; repeated rows stay
separate rows; an empty table gives an empty result; extra columns don't matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill.llm.text import quoted
from gristmill.sources.stores import saved

ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Runs are maximal, so a least length gives the same matches as dropping short runs afterwards.
PATTERNS = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}", "opaque": r"[A-Za-z0-9+/_-]{32,}"}
KINDS = list(PATTERNS)
BASE = KINDS[:3]
#: A value with at least so many owners, or in so many repositories, is an example that people copy.
EXAMPLE_OWNERS, EXAMPLE_REPOS = 3, 20
MASK = "[secret]"
#: Matches that are folded one after the other, and code points in a block of a text.
CHUNK, BLOCK = 256, 1024
SPAN = "array<struct<start:bigint,rank:int,kind:string,end:bigint,hash:bigint>>"


def _spans(text: Column, kind: str, least: int = 6) -> Column:
    """array<struct<start, rank, kind, end, hash>> of one kind's matches in ``text``.

    An opaque token has ``least`` digits and letters or more.
    """
    pattern = PATTERNS[kind]
    plain = F.when(text.rlike("[\u0001\u0002]"), F.translate(text, "\u0001\u0002", "\u0003\u0003")).otherwise(text)
    parts = F.split(F.regexp_replace(plain, pattern, "\u0001$0\u0002"), "\u0001")

    def step(acc: Column, part: Column) -> Column:
        found = F.substring_index(part, "\u0002", 1)
        value = F.regexp_extract(found, ASSIGN, 2) if kind == "assign" else found
        good = part.contains("\u0002")
        if kind == "assign":
            good = good & (F.length(value) >= 6)
        if kind == "opaque":
            good = good & (F.regexp_count(found, F.lit("[0-9]")) >= least) & (F.regexp_count(found, F.lit("[A-Za-z]")) >= least) & ~found.rlike("^[0-9a-f]+$")
        span = F.struct(
            acc["at"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), F.lit(kind).alias("kind"), (acc["at"] + F.length(found)).alias("end"), F.xxhash64(value).alias("hash")
        )
        width = F.length(part) - F.when(part.contains("\u0002"), 1).otherwise(0)
        return F.struct((acc["at"] + width).alias("at"), F.when(good, F.concat(acc["got"], F.array(span).cast(SPAN))).otherwise(acc["got"]).alias("got"))

    none = F.array().cast(SPAN)
    begin = F.struct(F.lit(0).cast("long").alias("at"), none.alias("got"))
    # CHUNK parts at once, each chunk from 0, then moved to its place: the work doesn't grow with the square of the matches
    chunks = F.transform(_chunks(parts), lambda k: F.aggregate(F.slice(parts, k * CHUNK + 1, F.lit(CHUNK)), begin, step))

    def move(acc: Column, part: Column) -> Column:
        moved = F.transform(part["got"], lambda s: s.withField("start", s["start"] + acc["at"]).withField("end", s["end"] + acc["at"]))
        return F.struct((acc["at"] + part["at"]).alias("at"), F.concat(acc["got"], F.array(moved.cast(SPAN))).alias("got"))

    nested = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{SPAN}>").alias("got"))
    got = F.flatten(F.aggregate(chunks, nested, move, lambda acc: acc["got"]))
    return F.when(text.rlike(pattern), got).otherwise(none)


def _chunks(items: Column) -> Column:
    """Numbers of the chunks of CHUNK items of an array that isn't empty."""
    return F.sequence(F.lit(0), F.floor((F.size(items) - 1) / CHUNK).cast("int"))


def _joined(spans: Column) -> Column:
    return F.concat_ws(",", F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))


def _live(owners: Column, repos: Column) -> Column:
    return (owners < EXAMPLE_OWNERS) & (repos < EXAMPLE_REPOS)


def ownership(found: DataFrame) -> DataFrame:
    """(hash, repos, owners) from (hash, repo, owner): distinct pairs first, so no group is gathered."""
    by_owner = found.groupBy("hash", "owner", "repo").agg(F.lit(1).alias("one")).groupBy("hash", "owner").agg(F.count("*").alias("repos"))
    return by_owner.groupBy("hash").agg(F.sum("repos").alias("repos"), F.count("*").alias("owners"))


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), repo: str = "doc_id", owner: str = "source", least: int = 6) -> DataFrame:
    """Columns ``keep`` as _k0, _k1, ... with base and all: arrays of spans, those in all with their owners."""
    text = F.coalesce(F.col("text"), F.lit(""))
    every = F.concat(*(_spans(text, k, least) for k in KINDS))
    rows = saved(docs.select(*(F.col(quoted(k)).alias(f"_k{i}") for i, k in enumerate(keep)), F.col(repo).alias("_repo"), F.col(owner).alias("_owner"), every.alias("_every")).withColumn("_row", F.monotonically_increasing_id()))
    found = rows.where(F.size("_every") > 0).select("_row", F.col("_repo").alias("repo"), F.col("_owner").alias("owner"), F.explode("_every").alias("s"))
    stats = ownership(found.select(F.col("s.hash").alias("hash"), "repo", "owner"))
    known = found.select("_row", "s").join(stats, F.col("s.hash") == F.col("hash")).where(F.col("s.kind").isin(BASE) | _live(F.col("owners"), F.col("repos")))
    span = F.struct("s.start", "s.rank", "s.kind", "s.end", "s.hash", "repos", "owners")
    per = known.groupBy("_row").agg(F.collect_list(span).alias("all"))
    base = F.filter("_every", lambda s: s["kind"].isin(BASE)).alias("base")
    empty = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint,hash:bigint,repos:bigint,owners:bigint>>")
    return rows.join(per, "_row", "left").select(*(f"_k{i}" for i in range(len(keep))), base, F.coalesce("all", empty).alias("all"))


def digest(docs: DataFrame) -> DataFrame:
    found = scan(docs)
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    live = lambda s: _live(s["owners"], s["repos"])
    return found.select(
        F.col("_k0").alias("doc_id"), *map(count, BASE), F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.col("all")).alias("spans"),
        F.size(F.filter("all", live)).cast("long").alias("n_live"), F.size(F.filter("all", lambda s: ~live(s))).cast("long").alias("n_example"),
    )


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with live-looking values masked in the text; every document stays.

    Opaque tokens with a digit and a letter are candidates here, and the owners decide; ``digest`` keeps
    the six of either that its SQL asks for. Overlapping spans are masked as one. Examples that several owners share are left as they are.
    Null texts stay null; repeated rows stay; columns may have any names.
    """
    names = docs.columns
    rows = scan(docs, tuple(names), least=1)
    whole = F.col(f"_k{names.index('text')}")
    live = F.array_sort(F.transform(F.filter("all", lambda s: _live(s["owners"], s["repos"])), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))))

    blocks = F.regexp_extract_all(whole, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))

    def piece(start: Column, end: Column) -> Column:
        """Code points start to end, found by their blocks and not from the text's begin."""
        first = F.floor(start / BLOCK).cast("int")
        some = F.array_join(F.slice(blocks, first + 1, F.floor(end / BLOCK).cast("int") - first + 1), "")
        return F.substring(some, (start - first * BLOCK + 1).cast("int"), (end - start).cast("int"))

    def step(acc: Column, s: Column) -> Column:
        made = F.when(s["start"] >= acc["at"], F.concat(piece(acc["at"], s["start"]), F.lit(MASK))).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], made).alias("out"))

    def upto(n: Column) -> Column:
        """Where the first n spans end, all of them."""
        return F.coalesce(F.array_max(F.transform(F.slice(live, 1, n), lambda s: s["end"])), F.lit(0).cast("long"))

    def chunk(k: Column) -> Column:
        begin = F.struct(upto(k * CHUNK).alias("at"), F.lit("").alias("out"))
        return F.aggregate(F.slice(live, k * CHUNK + 1, F.lit(CHUNK)), begin, step, lambda acc: acc["out"])

    text = F.concat(F.array_join(F.transform(_chunks(live), chunk), ""), piece(upto(F.size(live)), F.length(whole).cast("long")))
    clean = F.when(F.size(live) > 0, text).otherwise(whole)
    return rows.select(*((clean if n == "text" else F.col(f"_k{i}")).alias(n) for i, n in enumerate(names)))


_SQL_SPANS = r"""
  SELECT r, list_filter(list_transform(range(1, len(p) + 1), lambda i: {{'start': coalesce(list_sum(list_transform(p[1:i - 1], lambda x: len(x) - CASE WHEN contains(x, chr(2)) THEN 1 ELSE 0 END)), 0)::BIGINT,
           'kind': '{kind}', 'rank': {rank}, 'txt': split_part(p[i], chr(2), 1), 'hit': contains(p[i], chr(2))}}), lambda s: s.hit) AS got
  FROM (SELECT r, string_split(regexp_replace(translate(t, chr(1) || chr(2), chr(3) || chr(3)), '{pattern}', chr(1) || '\0' || chr(2), 'g'), chr(1)) AS p FROM d WHERE regexp_matches(t, '{pattern}'))"""


def _digest_sql() -> str:
    def quoted(pattern: str) -> str:
        return pattern.replace("'", "''")

    parts = " UNION ALL ".join(_SQL_SPANS.format(kind=k, rank=i, pattern=quoted(p)) for i, (k, p) in enumerate(PATTERNS.items()))
    return rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
m AS MATERIALIZED (SELECT r, s.start AS st, s.start + len(s.txt) AS en, s.kind AS kind, s.rank AS rk,
  CASE WHEN s.kind = 'assign' THEN regexp_extract(s.txt, '{quoted(ASSIGN)}', 2) ELSE s.txt END AS val
  FROM (SELECT r, unnest(got) AS s FROM ({parts}))),
c AS MATERIALIZED (SELECT m.*, d.doc_id, d.source FROM m JOIN d USING (r) WHERE CASE kind WHEN 'assign' THEN len(val) >= 6
  WHEN 'opaque' THEN len(regexp_extract_all(val, '[0-9]')) >= 6 AND len(regexp_extract_all(val, '[A-Za-z]')) >= 6 AND NOT regexp_matches(val, '^[0-9a-f]+$') ELSE true END),
o AS (SELECT val, count(DISTINCT coalesce(source, chr(1))) AS owners, count(DISTINCT {{'source': source, 'doc_id': doc_id}}) AS repos FROM c GROUP BY val),
k AS (SELECT c.*, owners < {EXAMPLE_OWNERS} AND repos < {EXAMPLE_REPOS} AS live FROM c JOIN o USING (val) WHERE rk < 3 OR (owners < {EXAMPLE_OWNERS} AND repos < {EXAMPLE_REPOS})),
g AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
  sha256(coalesce(string_agg(kind || ':' || st || ':' || en, ',' ORDER BY st, rk) FILTER (rk < 3), '')) AS base_sha256,
  string_agg(kind || ':' || st || ':' || en, ',' ORDER BY st, rk) AS spans, count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example
  FROM k GROUP BY r)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, coalesce(base_sha256, sha256('')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example
FROM d LEFT JOIN g USING (r)
"""


DIGEST_SQL = _digest_sql()
