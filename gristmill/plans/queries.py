"""One query for each operator, on the driver's tables.

Stand-ins: ``documents`` for instruction records (id and order doc_id, bucket lang, priority from
the source's number, length n_chars), ``embeddings`` for vectors with a given clustering,
``conversations`` for chat records, ``pages`` for texts with markup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gristmill.functions import tables
from gristmill.functions import text as T
from gristmill.functions import vectors as V
from gristmill.operators import cluster, convert, curate, enrich, lsh, report, sample
from gristmill.sources import jsonl
from gristmill.sources.stores import saved, shared_folder, table
from gristmill.streaming.incremental import first_seen, windowed_counts

FILTERED = ["en", "fr"]
POOL, HIGH, SEED = 200, 40, 42
QUOTAS = {"b0": 50}


def priority():
    return F.coalesce(F.expr("cast(substring(source, 4) as int)") % 2, F.lit(2))


def docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


def vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings")


def deduped(spark: SparkSession, d: str) -> DataFrame:
    return curate.exact_dedup(curate.clean(docs(spark, d)), "text", priority(), "doc_id")  # written once within


def curate_flagship(spark: SparkSession, d: str) -> DataFrame:
    kept = curate.complexity_filter(deduped(spark, d), "lang", "n_chars", 0.1, ["en"])
    return kept.groupBy("lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


CLEAN = r"regexp_replace(nfc_normalize(coalesce(text, '')), '^[\s\p{Z}\x{85}\x{1c}-\x{1f}\x{0b}]+|[\s\p{Z}\x{85}\x{1c}-\x{1f}\x{0b}]+$', '', 'g')"
CLEANED = f"c AS (SELECT * REPLACE ({CLEAN} AS text) FROM documents), k AS (SELECT * FROM c WHERE length(text) >= 3)"
DEDUPED = f"{CLEANED}, p AS (SELECT *, coalesce(try_cast(substr(source, 4) AS INT) % 2, 2) AS pr FROM k), e AS (SELECT text, arg_min(struct_pack(doc_id, lang, source, n_chars), struct_pack(pr, doc_id)) AS r, min(doc_id) AS position, count(*) AS copies FROM p GROUP BY text)"


def clean_documents(spark, d):
    return curate.clean(docs(spark, d)).select("doc_id", "lang", F.md5("text").alias("text_md5"), F.length("text").alias("length"))


def exact_dedup(spark, d):
    return deduped(spark, d).select("doc_id", "source", "position", "copies")


def clean_stats(spark, d):
    return curate.clean_stats(docs(spark, d))


def exact_dedup_stats(spark, d):
    return curate.exact_dedup_stats(curate.clean(docs(spark, d)), "text", priority(), "doc_id")


def complexity_cutoffs(spark, d):
    return curate.cutoffs(docs(spark, d), "lang", "n_chars", 0.1, FILTERED)


def complexity_filter(spark, d):
    return curate.complexity_filter(docs(spark, d), "lang", "n_chars", 0.1, FILTERED).select("doc_id", "lang", "n_chars")


def chats(spark, d) -> DataFrame:
    """Chat records from conversations: turns in order, without system turns."""
    c = table(spark, d, "conversations").where("role <> 'system'")
    turns = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))  # one conversation's turns
    item = lambda x: F.array(convert.text_item(x["text"]))
    return turns.select("conv_id", F.array(F.lit("")).alias("meta_prompt"), F.transform("t", lambda x: F.struct(x["role"].alias("role"), item(x).alias("content"))).alias("data"))


def extract_turns(spark, d):
    return convert.extracted(chats(spark, d)).select("conv_id", "instruction", "svg_len", "skip_reason")


def raw_rows(spark, d) -> DataFrame:
    n = F.col("doc_id")
    mark = F.when(n % 11 == 0, "").otherwise("Instruction: ")
    tag = F.when(n % 3 == 0, "<image>\n").otherwise("")
    images = F.when(n % 3 != 0, F.array().cast("array<string>")).when(n % 5 == 0, F.array(F.lit("a.png"), F.lit("b.png"))).when(n % 5 == 1, F.array(F.lit("/abs/a.png"))).when(n % 5 == 2, F.array(F.lit("x/a.gif"))).otherwise(F.array(F.lit("x/A.PNG")))
    return docs(spark, d).select("doc_id", F.concat(tag, mark, F.lit('"'), "text", F.lit('"')).alias("instruction"), F.lit("").alias("input"), F.when(n % 7 == 0, "").otherwise("<svg/>").alias("output"), images.alias("images"))


def convert_rows(spark, d):
    out = convert.converted(raw_rows(spark, d))
    return out.select("doc_id", "skip_reason", F.size("data").alias("turns"), F.when(F.col("skip_reason").isNull(), F.size(F.col("data")[0]["content"])).alias("items"))


def convert_skip_reasons(spark, d):
    return convert.skip_counts(convert.converted(raw_rows(spark, d)))


#: White space at the ends of a text, as in CLEAN; what stands around an instruction; and the rules of ``convert.converted`` on ``raw_rows``.
STRIP = r"regexp_replace({t}, '^[\s\p{{Z}}\x{{85}}\x{{1c}}-\x{{1f}}\x{{0b}}]+|[\s\p{{Z}}\x{{85}}\x{{1c}}-\x{{1f}}\x{{0b}}]+$', '', 'g')"
TAIL = r"""regexp_extract(prompt, '(?s)Instruction:[\s\x0b]*"?(.*?)"?[\s\x0b]*$', 1)"""
BARE = STRIP.format(t="regexp_replace(" + STRIP.format(t=TAIL) + """, '^"+|"+$', '', 'g')""")
REASONS = rf"""w AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '<image>' || chr(10) ELSE '' END || CASE WHEN doc_id % 11 = 0 THEN '' ELSE 'Instruction: ' END || '"' || text || '"' AS prompt FROM documents),
u AS (SELECT doc_id, coalesce(contains(prompt, '<image>'), false) AS tagged, CASE WHEN contains(prompt, 'Instruction:') THEN {BARE} ELSE '' END AS bare FROM w),
r AS (SELECT doc_id, tagged, CASE WHEN doc_id % 7 = 0 THEN 'missing_assistant_text' WHEN bare = '' THEN 'missing_user_content'
  WHEN tagged AND (doc_id % 3 <> 0 OR doc_id % 5 = 0) THEN 'invalid_image_format' WHEN tagged AND doc_id % 5 = 1 THEN 'invalid_relative_path' WHEN tagged AND doc_id % 5 = 2 THEN 'invalid_image_format' END AS skip_reason FROM u)"""


def byte_shingles(spark, d):
    return docs(spark, d).select("doc_id", "text").mapInArrow(T.shingle_counts, "doc_id long, n_bytes long, n_shingles long")


def minhash_signatures(spark, d):
    return lsh.signatures(docs(spark, d), "doc_id", "text").select(F.col("seq").alias("doc_id"), F.array_join(F.col("sig").cast("array<string>"), ",").alias("sig"))


def band_keys(spark, d):
    return lsh.band_keys(docs(spark, d), "doc_id", "text", 0.8).select(F.col("seq").alias("doc_id"), "band", "key")


def _minhash_sql(tail: str) -> str:
    a, b = lsh.family()
    pairs = ", ".join(f"({k}, {x}, {y})" for k, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)))
    return f"""
WITH h AS MATERIALIZED (SELECT doc_id, hex(encode(text)) AS x FROM documents),
s AS MATERIALIZED (SELECT doc_id, list_distinct(list_transform(CASE WHEN length(x) <= 10 THEN [x] ELSE list_transform(range(0, length(x) // 2 - 4), lambda i: substr(x, 2 * i + 1, 10)) END, lambda v: ('0x' || v)::BIGINT % {lsh.PRIME})) AS hs FROM h),
f(k, a, b) AS (VALUES {pairs}),
m AS MATERIALIZED (SELECT doc_id, k, list_min(list_transform(hs, lambda v: (a * v + b) % {lsh.PRIME})) AS v FROM s, f),
g AS MATERIALIZED (SELECT doc_id, list(v ORDER BY k) AS sig FROM m GROUP BY doc_id)
{tail}"""


def near_dedup_survivors(spark, d):
    return survivors(saved(curate.clean(docs(spark, d)).select("doc_id", "lang", "text")))


def survivors(rows: DataFrame) -> DataFrame:
    return lsh.near_dedup(rows, "doc_id", "text", "lang", {"en": 0.8, "fr": 0.7}).select("doc_id", "lang")


def _survivors_sql() -> str:
    """The sequential rule itself: one row after the other, with the keys of those kept so far."""
    each = {t: lsh.bands(t) for t in (0.7, 0.8)}
    cut = lambda t: f"list_transform(range(0, {each[t][0]}), lambda i: '{t}|' || coalesce(lang, '-') || '|' || i || '|' || array_to_string(sig[i * {each[t][1]} + 1:(i + 1) * {each[t][1]}], ','))"
    tail = f"""k AS MATERIALIZED (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) AS at, CASE WHEN lang = 'fr' THEN {cut(0.7)} ELSE {cut(0.8)} END AS keys FROM g JOIN documents_clean USING (doc_id)),
r AS (SELECT 0::BIGINT AS at, NULL::BIGINT AS doc_id, NULL::VARCHAR AS lang, false AS kept, []::VARCHAR[] AS seen
  UNION ALL SELECT k.at, k.doc_id, k.lang, NOT list_has_any(r.seen, k.keys), CASE WHEN list_has_any(r.seen, k.keys) THEN r.seen ELSE list_concat(r.seen, k.keys) END FROM r JOIN k ON k.at = r.at + 1)
SELECT doc_id, lang FROM r WHERE kept"""
    sql = _minhash_sql("").rstrip().removesuffix(")") + ")"
    source = f"WITH RECURSIVE documents_clean AS MATERIALIZED (SELECT doc_id, lang, text FROM (SELECT * REPLACE ({CLEAN} AS text) FROM documents) WHERE length(text) >= 3),"
    return sql.replace("WITH h AS", source + " h AS", 1).replace("AS x FROM documents)", "AS x FROM documents_clean)", 1) + ", " + tail


def vector_normalise(spark, d):
    v = vectors(spark, d).select("vec_id", V.normalised(F.col("embedding")).alias("v"))
    return v.select("vec_id", F.round(F.col("v")[0], 6).alias("first"), F.round(V.norm(F.col("v")), 6).alias("norm"))


def vector_truncate(spark, d):
    v = vectors(spark, d).select("vec_id", V.truncated(F.col("embedding"), 32).alias("v"))
    return v.select("vec_id", F.size("v").alias("dim"), F.round(F.col("v")[0], 6).alias("first"), F.round(F.col("v")[31], 6).alias("last"))


def embed_stub(spark, d):
    v = cluster.embedded(docs(spark, d), "doc_id", "text", None, 16)
    return v.select("id", F.size("embedding").alias("dim"), F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x).alias("total"))


def records_with_vectors(spark, d):
    rows, missing = cluster.with_vectors(docs(spark, d).select("doc_id", "lang"), vectors(spark, d).select(F.col("vec_id").alias("doc_id"), "label"), "doc_id")
    return rows.groupBy("lang", "label").agg(F.count("*").alias("n")).crossJoin(F.broadcast(missing))  # missing is one row


def cluster_centroids(spark, d):
    c = cluster.centroids(vectors(spark, d), ["label"])
    return c.select("label", F.posexplode("centroid").alias("pos", "x")).select("label", "pos", F.round("x", 6).alias("x"))


def centroid_distance(spark, d):
    out = cluster.described(vectors(spark, d), ["label"])
    return out.select("vec_id", "label", "cluster_size", V.rounded(F.col("distance_to_centroid"), 4).alias("distance"))


def cluster_sizes(spark, d):
    return vectors(spark, d).groupBy("label").agg(F.count("*").alias("size")).withColumn("actual_k", F.max("label").over(W.partitionBy()) + 1)  # a row for each label


def inertia(spark, d):
    return cluster.inertia(vectors(spark, d), ["label"]).select(F.round("inertia", 4).alias("inertia"))


def nearest_centroid(spark, d):
    v = vectors(spark, d)
    return cluster.nearest(v.select("vec_id", "embedding"), cluster.centroids(v, ["label"])).select("vec_id", "nearest", F.round("distance", 5).alias("distance"))


def kmeans_assign(spark, d):
    v = vectors(spark, d).withColumn("bucket", F.concat(F.lit("b"), F.pmod("vec_id", F.lit(2))))
    return cluster.clustered(v, "bucket", {"b0": 4}, 6, key="vec_id").select("vec_id", "bucket", "cluster_id", "cluster_size", "distance_to_centroid")


#: All rounds of all seeds in one recursion; empty clusters get the farthest distinct vectors; means are of fixed-point numbers.
KMEANS_SQL = """
WITH RECURSIVE p0 AS (SELECT vec_id, 'b' || (vec_id % 2) AS bucket, embedding::DOUBLE[] AS x FROM embeddings),
u AS (SELECT pow(2, 30 - floor(log2(max(m))) - 1) AS scale FROM (SELECT list_max(list_transform(x, lambda v: abs(v))) AS m FROM p0)),
p AS MATERIALIZED (SELECT vec_id, bucket, x, list_transform(x, lambda v: floor(v * scale + 0.5)) AS w FROM p0, u),
s AS (SELECT seed, bucket, x, min(md5(seed || '|' || vec_id)) AS place FROM p, (SELECT unnest([1, 2, 3]) AS seed) GROUP BY ALL),
s1 AS (SELECT seed, bucket, x, row_number() OVER (PARTITION BY seed, bucket ORDER BY place) - 1 AS label FROM s),
k AS (
  SELECT 0 AS it, seed, bucket, label, x AS c, 1e9 AS shift FROM s1 WHERE label < CASE bucket WHEN 'b0' THEN 4 ELSE 6 END
  UNION ALL
  (WITH o AS (SELECT * FROM k WHERE shift >= 0.0001 AND it < 100),
   a AS (SELECT o.seed, o.bucket, p.vec_id, min({'d': list_sum(list_transform(list_zip(p.x, o.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'l': o.label}) AS b
         FROM o JOIN p USING (bucket) GROUP BY ALL),
   t AS (SELECT seed, bucket, l, pos, sum(v)::DOUBLE AS v, count(*) AS n
         FROM (SELECT a.seed, a.bucket, a.b.l AS l, unnest(p.w)::BIGINT AS v, generate_subscripts(p.w, 1) AS pos FROM a JOIN p USING (vec_id)) GROUP BY ALL),
   m AS (SELECT seed, bucket, l, list(v / (n * scale) ORDER BY pos) AS c FROM t, u GROUP BY ALL),
   e AS (SELECT seed, bucket, label, row_number() OVER (PARTITION BY seed, bucket ORDER BY label) AS nth FROM o WHERE NOT EXISTS (FROM m WHERE m.seed = o.seed AND m.bucket = o.bucket AND m.l = o.label)),
   f AS (SELECT seed, bucket, x, row_number() OVER (PARTITION BY seed, bucket ORDER BY d DESC, x) AS nth
         FROM (SELECT a.seed, a.bucket, p.x, max(a.b.d) AS d FROM a JOIN p USING (vec_id) GROUP BY ALL)),
   n AS (SELECT o.it + 1 AS it, o.seed, o.bucket, o.label, coalesce(m.c, f.x, o.c) AS c, o.c AS old
         FROM o LEFT JOIN m ON m.seed = o.seed AND m.bucket = o.bucket AND m.l = o.label
         LEFT JOIN e ON e.seed = o.seed AND e.bucket = o.bucket AND e.label = o.label
         LEFT JOIN f ON f.seed = o.seed AND f.bucket = o.bucket AND f.nth = e.nth)
   SELECT it, seed, bucket, label, c, avg(list_distance(c, old)) OVER (PARTITION BY seed, bucket) AS shift FROM n)),
z AS (SELECT * FROM k WHERE it = (SELECT max(it) FROM k j WHERE j.seed = k.seed AND j.bucket = k.bucket)),
g AS (SELECT z.seed, z.bucket, p.vec_id, min({'d': list_sum(list_transform(list_zip(p.x, z.c), lambda y: (y[1] - y[2]) * (y[1] - y[2]))), 'l': z.label}) AS b
      FROM z JOIN p USING (bucket) GROUP BY ALL),
i AS (SELECT bucket, arg_min(seed, {'c': cost, 's': seed}) AS seed FROM (SELECT bucket, seed, sum(b.d) AS cost FROM g GROUP BY ALL) GROUP BY bucket),
l AS MATERIALIZED (SELECT vec_id, bucket, g.b.l AS cluster_id FROM g JOIN i USING (bucket, seed)),
q AS (SELECT bucket, cluster_id, list(v ORDER BY pos) AS c FROM (
        SELECT bucket, cluster_id, pos, avg(v) AS v FROM (SELECT l.bucket, cluster_id, unnest(x) AS v, generate_subscripts(x, 1) AS pos FROM l JOIN p USING (vec_id)) GROUP BY ALL) GROUP BY ALL)
SELECT vec_id, bucket, cluster_id, count(*) OVER (PARTITION BY bucket, cluster_id) AS cluster_size, round(list_distance(p.x, q.c), 6) AS distance_to_centroid
FROM l JOIN p USING (vec_id, bucket) JOIN q USING (bucket, cluster_id)
"""


def sampled_rows(spark, d) -> DataFrame:
    v = cluster.described(vectors(spark, d), ["label"])
    return v.select(F.col("vec_id").alias("seq"), F.concat(F.lit("b"), F.col("label") % 3).alias("bucket"), F.col("label").alias("cluster"), V.rounded(F.col("distance_to_centroid"), 4).alias("dist"))


def sizes(spark, d) -> DataFrame:
    return sampled_rows(spark, d).groupBy("bucket").agg(F.count("*").alias("size"), F.min("seq").alias("first_seq"))


def bucket_quota(spark, d):
    return sample.quotas(sizes(spark, d), POOL, QUOTAS)


def budgets(spark, d) -> DataFrame:
    per = sampled_rows(spark, d).groupBy("bucket", "cluster").agg(F.count("*").alias("size"), F.min("seq").alias("first_seq"))
    return sample.budgets(per.join(bucket_quota(spark, d), "bucket"))


def pooled(spark, d) -> DataFrame:
    return saved(sample.pool(sampled_rows(spark, d), saved(budgets(spark, d))))


def pool(spark, d):
    return pooled(spark, d).select("seq", "bucket", "cluster")


def high_priority(spark, d):
    return sample.high_priority(pooled(spark, d), HIGH, SEED, "seq").select("seq", "bucket", "cluster")


def anneal(spark, d):
    p = pooled(spark, d)
    return sample.remainder(p, sample.high_priority(p, HIGH, SEED, "seq"), "seq").select("seq", "bucket", "cluster")


QUOTA_SQL = """
cent AS (SELECT label, pos, avg(x) AS m FROM (SELECT label, unnest(range(0, len(embedding))) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY ALL),
dist AS (SELECT vec_id AS seq, 'b' || (e.label % 3) AS bucket, e.label AS cluster, round(round(sqrt(sum(power(x - m, 2))), 6), 4) AS dist
  FROM (SELECT vec_id, label, unnest(range(0, len(embedding))) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings) e JOIN cent c ON c.label = e.label AND c.pos = e.pos GROUP BY ALL),
z AS (SELECT bucket, count(*) AS size, min(seq) AS first_seq FROM dist GROUP BY bucket),
z1 AS (SELECT *, CASE WHEN bucket = 'b0' THEN least(50, size) END AS fixed FROM z),
z2 AS (SELECT *, greatest(200 - coalesce(sum(fixed) OVER (), 0), 0) AS lft, sum(CASE WHEN fixed IS NULL THEN size END) OVER () AS free FROM z1),
z3 AS (SELECT *, CASE WHEN fixed IS NULL AND free > 0 THEN lft::DOUBLE * size / free ELSE 0 END AS raw FROM z2),
z4 AS (SELECT *, floor(raw) AS fl, row_number() OVER (ORDER BY fixed IS NOT NULL, round(raw - floor(raw), 9) DESC, first_seq) AS rk FROM z3),
quota AS (SELECT bucket, coalesce(fixed, fl + CASE WHEN rk <= lft - (SELECT sum(fl) FROM z4) THEN 1 ELSE 0 END)::BIGINT AS quota FROM z4)"""

BUDGET_SQL = (
    QUOTA_SQL
    + """,
b0 AS (SELECT bucket, cluster, count(*) AS size, min(seq) AS first_seq FROM dist GROUP BY ALL),
b1 AS (SELECT b0.*, quota, count(*) OVER w AS n, row_number() OVER (PARTITION BY bucket ORDER BY size DESC, first_seq) AS by_size, quota * sqrt(size) / sum(sqrt(size)) OVER w AS raw FROM b0 JOIN quota USING (bucket) WINDOW w AS (PARTITION BY bucket)),
b2 AS (SELECT *, greatest(floor(raw), 1) AS f FROM b1),
b3 AS (SELECT *, quota - sum(f) OVER (PARTITION BY bucket) AS diff, row_number() OVER (PARTITION BY bucket ORDER BY round(raw - f, 9) DESC, first_seq) AS by_part, row_number() OVER (PARTITION BY bucket ORDER BY f DESC, first_seq) AS by_share FROM b2),
budget AS (SELECT bucket, cluster, size, (CASE WHEN quota <= 0 THEN 0 WHEN n >= quota THEN CASE WHEN by_size <= quota THEN 1 ELSE 0 END
  WHEN diff > 0 THEN f + CASE WHEN by_part <= diff THEN 1 ELSE 0 END WHEN diff < 0 THEN f - CASE WHEN f > 1 AND by_share <= -diff THEN 1 ELSE 0 END ELSE f END)::BIGINT AS budget FROM b3)"""
)
POOL_SQL = (
    BUDGET_SQL
    + """,
pool AS (SELECT seq, bucket, cluster, dist FROM (SELECT *, row_number() OVER (PARTITION BY bucket, cluster ORDER BY dist, seq) AS rn FROM dist) r JOIN budget USING (bucket, cluster) WHERE rn <= budget),
ranked AS (SELECT *, md5('42' || seq) AS pos, row_number() OVER (PARTITION BY bucket, cluster ORDER BY dist, md5('42' || seq)) AS rn, min(md5('42' || seq)) OVER (PARTITION BY bucket, cluster) AS cpos FROM pool),
high AS (SELECT seq, bucket, cluster FROM ranked ORDER BY rn, cpos LIMIT 40)"""
)


def staged(spark, d) -> list[tuple[str, DataFrame]]:
    raw, clean = docs(spark, d), saved(curate.clean(docs(spark, d)))
    exact = curate.exact_dedup(clean, "text", priority(), "doc_id")
    return [("extract", raw), ("clean", clean), ("dedup_exact", exact), ("svg_filter", curate.complexity_filter(exact, "lang", "n_chars", 0.1, FILTERED))]


def funnel(spark, d):
    return report.funnel(staged(spark, d))


def pool_metrics(spark, d):
    n = report.numbers(deduped(spark, d), "n_chars")
    return n.select(F.round("mean", 4).alias("mean"), "median", F.round("stdev", 4).alias("stdev"), "min", "max")


def source_mix(spark, d):
    return report.mix(docs(spark, d), "source")


def cluster_coverage(spark, d):
    rows = sampled_rows(spark, d)
    return report.coverage(rows.where("seq % 7 = 0"), rows)


def bucket_compare(spark, d):
    rows = docs(spark, d)
    return report.compared(rows.select("lang"), rows.where("n_chars > 3000").select("lang"), "lang")


def length_histogram(spark, d):
    return report.histogram(docs(spark, d), "n_chars", 30).select("bin", F.round("low", 4).alias("low"), F.round("high", 4).alias("high"), "n")


def distance_histogram(spark, d):
    h = report.histogram(sampled_rows(spark, d), "dist", 50, density=True)
    return h.select("bin", "n", V.rounded(F.col("density"), 4).alias("density"))


def schema_profile(spark, d):
    p = report.profile(chats(spark, d))
    return p.select(*(F.array_join(c, ",").alias(c) for c in ("roles", "types", "formats", "prompts")), "has_images")


def sample_first_n(spark, d):
    return sample.first_n(docs(spark, d), 100, "doc_id").select("doc_id", "lang")


def sample_hashed(spark, d):
    return sample.hashed_sample(docs(spark, d), 100, "doc_id").select("doc_id", "lang")


def fenced(spark, d) -> DataFrame:
    n = F.col("page_id")
    body = F.when(n % 3 == 0, F.concat(F.lit("see\n```SVG\n<svg>"), n.cast("string"), F.lit("</svg>\n```\nend"))).when(n % 3 == 1, F.concat(F.lit("raw <svg w='1'>"), n.cast("string"), F.lit("</svg> tail"))).otherwise("none")
    return table(spark, d, "pages").select("page_id", F.concat(F.coalesce("html", F.lit("")), F.lit(" "), body).alias("text"))


FENCED_SQL = "f AS (SELECT page_id, coalesce(html, '') || ' ' || CASE page_id % 3 WHEN 0 THEN 'see' || chr(10) || '```SVG' || chr(10) || '<svg>' || page_id || '</svg>' || chr(10) || '```' || chr(10) || 'end' WHEN 1 THEN 'raw <svg w=''1''>' || page_id || '</svg> tail' ELSE 'none' END AS text FROM pages)"


def code_block_extract(spark, d):
    return fenced(spark, d).select("page_id", T.code_block(F.col("text"), "svg").alias("block"))


def raw_svg_extract(spark, d):
    return fenced(spark, d).select("page_id", T.raw_element(F.col("text")).alias("raw"), T.best_element(F.col("text")).alias("best"))


def text_segments(spark, d):
    s = fenced(spark, d).select("page_id", F.posexplode(T.segments(F.col("text"))).alias("place", "s"))
    return s.select("page_id", "place", "s.kind", "s.language", T.strip(F.col("s.body")).alias("body"))


def segments_by_sql(spark, d):
    """As text_segments, by a table function in SQL text."""
    tables.register(spark)
    return spark.sql("SELECT page_id, s.place, s.kind, s.language, trim(BOTH '\\n ' FROM s.body) AS body FROM {pages}, LATERAL text_segments(text) s", pages=fenced(spark, d))


def shingles_by_sql(spark, d):
    tables.register(spark)
    return spark.sql("SELECT id AS doc_id, count(*) AS n_shingles, sum(n) AS n_places FROM table_shingles(TABLE({docs}), 5) GROUP BY id", docs=docs(spark, d).select("doc_id", "text"))


def html_escape(spark, d):
    return table(spark, d, "pages").select("page_id", F.md5(T.escape_html(F.col("html"))).alias("escaped_md5"))


def page_titles(spark, d):
    return table(spark, d, "pages").select("page_id", F.regexp_extract("html", "(?is)<title>(.*?)</title>", 1).alias("title"))


def image_types(spark, d):
    path = F.concat(F.lit("img/"), F.col("doc_id").cast("string"), F.element_at(F.array(*map(F.lit, (".PNG", ".jpg", ".gif", "", ".webp"))), (F.col("doc_id") % 5 + 1).cast("int")))
    return docs(spark, d).select("doc_id", T.extension_type(path).alias("type"))


def record_search(spark, d):
    return docs(spark, d).where(report.search(docs(spark, d), "17", "doc_id", "text")).select("doc_id")


def ids_from_paths(spark, d):
    n = F.col("doc_id")
    path = F.concat(F.when(n % 2 == 0, "x/stage2/illustration").otherwise("x/stage1/icon"), F.when(n % 3 == 0, "/text2svg/").otherwise("/img2svg/"), F.lit("data_000000.jsonl"))
    return docs(spark, d).select("doc_id", jsonl.record_id(jsonl.domain_of(path), jsonl.source_of(path), path, n).alias("id"))


def jsonl_round_trip(spark, d):
    """Documents written as JSON lines with some spoiled and blank ones, and read with counted rejects."""
    rows = docs(spark, d).select("doc_id", "lang", "n_chars")
    path = f"{shared_folder(spark)}/lines-{spark.sparkContext.applicationId}-{id(rows)}"
    n = F.col("doc_id")
    line = F.when(n % 50 == 7, "{\"doc_id\": ").otherwise(F.to_json(F.struct(*rows.columns)))
    rows.select(F.when(n % 50 == 8, "   ").otherwise(line).alias("value")).write.mode("overwrite").text(path)
    kind = rows.schema
    back = jsonl.scan(spark, path, kind, "counted")
    return back.groupBy(F.coalesce("skip_reason", F.lit("ok")).alias("skip_reason")).agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))


def resume_pending(spark, d):
    done = table(spark, d, "labels").select(F.col("doc_id").cast("string").alias("id"), F.when(F.col("toxic") == 1, "error").otherwise("ok").alias("status"))
    rows = docs(spark, d).select(F.col("doc_id").cast("string").alias("key"), "lang")
    return enrich.pending(rows, done, "key").groupBy("lang").agg(F.count("*").alias("n"))


def enrich_stub(spark, d):
    def make():
        def call(prompt: str) -> str:
            if len(prompt) % 10 == 3:
                raise enrich.CallError(400)
            return prompt[:3].upper()

        return call

    out = enrich.enriched(docs(spark, d), "doc_id", "text", make, pause=False)
    return out.groupBy("status").agg(F.count("*").alias("n"), F.countDistinct("response").alias("responses"))


def retry_classes(spark, d):
    code = F.element_at(F.array(*map(F.lit, (200, 429, 500, 503, 400, 404, 418, 409))), (F.col("event_id") % 8 + 1).cast("int"))
    return table(spark, d, "events").groupBy(enrich.retry_class(code).alias("class")).agg(F.count("*").alias("n"))


def call_usage(spark, d):
    r = docs(spark, d).select(F.col("doc_id").cast("string").alias("id"), F.col("text").alias("instruction"), F.when(F.col("doc_id") % 9 == 0, "error").otherwise("ok").alias("status"), F.lit("a b c").alias("response"), F.lit(None).cast("string").alias("error"))
    return enrich.usage(enrich.call_log(r, "local", "stub")).select("model", "status", "calls", "completion_tokens")


def embedding_buckets(spark, d):
    lang = docs(spark, d).where("doc_id % 3 <> 0").select(F.col("doc_id").alias("vec_id"), F.col("lang").alias("bucket"))
    return vectors(spark, d).select("vec_id").join(lang, "vec_id", "left").groupBy(F.coalesce("bucket", F.lit("unknown")).alias("bucket")).agg(F.count("*").alias("n"))


def event_windows(spark, d):
    """Not of the reference: event-time windows, the same code as on a stream."""
    return windowed_counts(table(spark, d, "events"), "ts", "event_type", "1 day")


def events_first_seen(spark, d):
    """The first event of each type, the same code as on a stream."""
    return first_seen(table(spark, d, "events").select("event_type", "ts", "event_id"), "event_type", "ts")


D32 = "list_transform(embedding[:32], lambda x: x::DOUBLE)"
NORM = "greatest(sqrt(list_sum(list_transform({v}, lambda x: x::DOUBLE * x::DOUBLE))), 1e-8)"
CENT = "cent AS (SELECT label, pos, avg(x) AS m FROM (SELECT label, unnest(range(0, len(embedding)))::INT AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY ALL), comp AS (SELECT vec_id, label, unnest(range(0, len(embedding)))::INT AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings)"

QUERIES = {
    f.__name__: f
    for f in (
        curate_flagship, clean_documents, clean_stats, exact_dedup, exact_dedup_stats, complexity_cutoffs, complexity_filter, extract_turns, convert_rows, convert_skip_reasons,
        byte_shingles, minhash_signatures, band_keys, near_dedup_survivors, vector_normalise, vector_truncate, embed_stub, records_with_vectors, cluster_centroids, centroid_distance,
        cluster_sizes, inertia, nearest_centroid, kmeans_assign, bucket_quota, pool, high_priority, anneal, funnel, pool_metrics, source_mix, cluster_coverage, bucket_compare,
        length_histogram, distance_histogram, schema_profile, sample_first_n, sample_hashed, code_block_extract, raw_svg_extract, text_segments, segments_by_sql, shingles_by_sql, html_escape, page_titles, image_types,
        record_search, ids_from_paths, jsonl_round_trip, resume_pending, enrich_stub, retry_classes, call_usage, embedding_buckets, event_windows, events_first_seen,
    )
} | {"cluster_budget": budgets}

ORACLE_SQL = {
    "curate_flagship": f"WITH {DEDUPED}, cut AS (SELECT quantile_cont(r.n_chars, 0.1)::DOUBLE AS q FROM e WHERE r.lang = 'en') SELECT r.lang AS lang, count(*) AS n, sum(r.n_chars)::BIGINT AS chars FROM e, cut WHERE r.lang IS DISTINCT FROM 'en' OR r.n_chars > floor(q) GROUP BY ALL",
    "clean_documents": f"WITH {CLEANED} SELECT doc_id, lang, md5(text) AS text_md5, length(text) AS length FROM k",
    "clean_stats": f"WITH {CLEANED} SELECT count(*) AS total, count(*) FILTER (length(text) >= 3) AS kept, count(*) FILTER (text = '') AS dropped_empty, count(*) FILTER (text <> '' AND length(text) < 3) AS dropped_short FROM c",
    "exact_dedup": f"WITH {DEDUPED} SELECT r.doc_id AS doc_id, r.source AS source, position, copies FROM e",
    "exact_dedup_stats": f"WITH {DEDUPED} SELECT count(*) AS kept, sum(copies - 1)::BIGINT AS removed, count(*) FILTER (r.doc_id <> position) AS replaced FROM e",
    "complexity_cutoffs": "SELECT lang, floor(quantile_cont(n_chars, 0.1))::BIGINT AS cutoff FROM documents WHERE lang IN ('en', 'fr') GROUP BY lang",
    "complexity_filter": "WITH q AS (SELECT lang, floor(quantile_cont(n_chars, 0.1))::BIGINT AS cutoff FROM documents WHERE lang IN ('en', 'fr') GROUP BY lang) SELECT doc_id, d.lang, n_chars FROM documents d LEFT JOIN q USING (lang) WHERE cutoff IS NULL OR n_chars > cutoff",
    "extract_turns": """WITH t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS p FROM conversations WHERE role <> 'system'),
u AS (SELECT conv_id, max(CASE WHEN p = 1 AND role = 'user' THEN text END) AS instruction, max(CASE WHEN p = 2 AND role = 'assistant' THEN text END) AS reply FROM t GROUP BY conv_id)
SELECT conv_id, instruction, length(reply) AS svg_len, CASE WHEN coalesce(instruction, '') = '' THEN 'no_instruction' WHEN reply IS NULL THEN 'no_svg' END AS skip_reason FROM u""",
    "convert_rows": f"WITH {REASONS} SELECT doc_id, skip_reason, 2 AS turns, CASE WHEN skip_reason IS NULL THEN CASE WHEN tagged THEN 2 ELSE 1 END END AS items FROM r",
    "convert_skip_reasons": f"WITH {REASONS} SELECT coalesce(skip_reason, 'ok') AS skip_reason, count(*) AS n FROM r GROUP BY ALL",
    "byte_shingles": "WITH h AS (SELECT doc_id, hex(encode(text)) AS x FROM documents) SELECT doc_id, length(x) // 2 AS n_bytes, CASE WHEN length(x) <= 10 THEN 1 ELSE len(list_distinct(list_transform(range(0, length(x) // 2 - 4), lambda i: substr(x, 2 * i + 1, 10)))) END AS n_shingles FROM h",
    "minhash_signatures": _minhash_sql("SELECT doc_id, array_to_string(sig, ',') AS sig FROM g"),
    "band_keys": _minhash_sql("SELECT doc_id, band, md5(array_to_string(sig[band * 13 + 1:band * 13 + 13], ',')) AS key FROM (SELECT doc_id, sig, unnest(range(0, 9))::INT AS band FROM g)"),
    "near_dedup_survivors": _survivors_sql(),
    "kmeans_assign": KMEANS_SQL,
    "vector_normalise": f"WITH n AS (SELECT vec_id, embedding, {NORM.format(v='embedding')} AS n FROM embeddings) SELECT vec_id, round(embedding[1]::DOUBLE / n, 6) AS first, round(sqrt(list_sum(list_transform(embedding, lambda x: power(x::DOUBLE / n, 2)))), 6) AS norm FROM n",
    "vector_truncate": f"WITH n AS (SELECT vec_id, {D32} AS v FROM embeddings), m AS (SELECT *, {NORM.format(v='v')} AS n FROM n) SELECT vec_id, 32 AS dim, round(v[1] / n, 6) AS first, round(v[32] / n, 6) AS last FROM m",
    "embed_stub": "SELECT doc_id AS id, 16 AS dim, 0.0::DOUBLE AS total FROM documents",
    "records_with_vectors": "SELECT lang, label, count(*) AS n, (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT vec_id FROM embeddings)) AS missing FROM documents JOIN embeddings ON doc_id = vec_id GROUP BY ALL",
    "cluster_centroids": f"WITH {CENT} SELECT label, pos, round(m, 6) AS x FROM cent",
    "centroid_distance": f"WITH {CENT} SELECT vec_id, c.label, (SELECT count(*) FROM embeddings e WHERE e.label = c.label) AS cluster_size, round(round(sqrt(sum(power(x - m, 2))), 6), 4) AS distance FROM comp c JOIN cent USING (label, pos) GROUP BY vec_id, c.label",
    "cluster_sizes": "SELECT label, count(*) AS size, (SELECT max(label) + 1 FROM embeddings) AS actual_k FROM embeddings GROUP BY label",
    "inertia": f"WITH {CENT} SELECT round(sum(power(x - m, 2)), 4) AS inertia FROM comp JOIN cent USING (label, pos)",
    "nearest_centroid": f"WITH {CENT}, p AS (SELECT vec_id, cent.label AS l, sqrt(sum(power(x - m, 2))) AS d FROM comp JOIN cent USING (pos) GROUP BY ALL) SELECT vec_id, arg_min(l, struct_pack(d, l)) AS nearest, round(min(d), 5) AS distance FROM p GROUP BY vec_id",
    "bucket_quota": f"WITH {QUOTA_SQL} SELECT bucket, quota FROM quota",
    "cluster_budget": f"WITH {BUDGET_SQL} SELECT bucket, cluster, size, budget FROM budget",
    "pool": f"WITH {POOL_SQL} SELECT seq, bucket, cluster FROM pool",
    "high_priority": f"WITH {POOL_SQL} SELECT seq, bucket, cluster FROM high",
    "anneal": f"WITH {POOL_SQL} SELECT seq, bucket, cluster FROM pool WHERE seq NOT IN (SELECT seq FROM high)",
    "funnel": f"""WITH {DEDUPED}, q AS (SELECT r.lang AS lang, floor(quantile_cont(r.n_chars, 0.1)) AS cutoff FROM e WHERE r.lang IN ('en', 'fr') GROUP BY ALL),
s AS (SELECT 0 AS step, 'extract' AS stage, count(*) AS rows FROM documents UNION ALL SELECT 1, 'clean', count(*) FROM k UNION ALL SELECT 2, 'dedup_exact', count(*) FROM e UNION ALL SELECT 3, 'svg_filter', count(*) FROM e LEFT JOIN q ON q.lang = e.r.lang WHERE cutoff IS NULL OR e.r.n_chars > cutoff)
SELECT step, stage, rows, round(100.0::DOUBLE * rows / lag(rows) OVER (ORDER BY step), 1) AS percent_of_previous FROM s""",
    "pool_metrics": f"WITH {DEDUPED} SELECT round(avg(r.n_chars), 4) AS mean, median(r.n_chars) AS median, round(stddev_samp(r.n_chars), 4) AS stdev, min(r.n_chars) AS min, max(r.n_chars) AS max FROM e",
    "source_mix": "SELECT source, count(*) AS n, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 1) AS percent FROM documents GROUP BY source",
    "cluster_coverage": "WITH t AS (SELECT 'b' || (label % 3) AS bucket, count(DISTINCT label) AS total, count(DISTINCT CASE WHEN vec_id % 7 = 0 THEN label END) AS clusters FROM embeddings GROUP BY ALL) SELECT bucket, clusters, total, round(100.0::DOUBLE * clusters / total, 1) AS percent FROM t WHERE clusters > 0",
    "bucket_compare": "SELECT lang, count(*) AS pool, count(*) FILTER (n_chars > 3000) AS high FROM documents GROUP BY lang",
    "length_histogram": "WITH s AS (SELECT min(n_chars)::DOUBLE AS lo, max(n_chars)::DOUBLE AS hi FROM documents), b AS (SELECT least(floor((n_chars - lo) / ((hi - lo) / 30)), 29)::INT AS bin, lo, (hi - lo) / 30 AS w FROM documents, s) SELECT bin, round(lo + bin * w, 4) AS low, round(lo + (bin + 1) * w, 4) AS high, count(*) AS n FROM b GROUP BY bin, lo, w",
    "distance_histogram": f"WITH {QUOTA_SQL}, s AS (SELECT min(dist) AS lo, max(dist) AS hi FROM dist), b AS (SELECT least(floor((dist - lo) / ((hi - lo) / 50)), 49)::INT AS bin, (hi - lo) / 50 AS w, lo FROM dist, s) SELECT bin, count(*) AS n, round(count(*) / (sum(count(*)) OVER () * ((lo + (bin + 1) * w) - (lo + bin * w))), 4) AS density FROM b GROUP BY bin, w, lo",
    "schema_profile": "SELECT array_to_string(list_sort(list(DISTINCT role)), ',') AS roles, 'text' AS types, 'utf-8' AS formats, '' AS prompts, false AS has_images FROM conversations WHERE role <> 'system'",
    "sample_first_n": "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 100",
    "sample_hashed": "SELECT doc_id, lang FROM documents ORDER BY md5('42' || doc_id), doc_id LIMIT 100",
    "code_block_extract": f"WITH {FENCED_SQL} SELECT page_id, CASE WHEN page_id % 3 = 0 THEN trim(regexp_extract(text, '(?is)```svg\\s*\\n?(.*?)```', 1), chr(10) || ' ') END AS block FROM f",
    "raw_svg_extract": f"WITH {FENCED_SQL} SELECT page_id, nullif(regexp_extract(text, '(?is)<svg.*?</svg>'), '') AS raw, nullif(regexp_extract(text, '(?is)<svg.*?</svg>'), '') AS best FROM f",
    "text_segments": f"WITH {FENCED_SQL}, p AS (SELECT page_id, string_split(text, '```') AS ps FROM f), u AS (SELECT page_id, unnest(range(0, len(ps)))::INT AS place, unnest(ps) AS part FROM p) SELECT page_id, place, CASE WHEN place % 2 = 1 THEN 'code' ELSE 'text' END AS kind, CASE WHEN place % 2 = 1 THEN regexp_extract(part, '^(\\w*)', 1) ELSE '' END AS language, trim(CASE WHEN place % 2 = 1 THEN regexp_replace(part, '^\\w*', '') ELSE part END, chr(10) || ' ') AS body FROM u",
    "segments_by_sql": f"WITH {FENCED_SQL}, p AS (SELECT page_id, string_split(text, '```') AS ps FROM f), u AS (SELECT page_id, unnest(range(0, len(ps)))::INT AS place, unnest(ps) AS part FROM p) SELECT page_id, place, CASE WHEN place % 2 = 1 THEN 'code' ELSE 'text' END AS kind, CASE WHEN place % 2 = 1 THEN regexp_extract(part, '^(\\w*)', 1) ELSE '' END AS language, trim(CASE WHEN place % 2 = 1 THEN regexp_replace(part, '^\\w*', '') ELSE part END, chr(10) || ' ') AS body FROM u",
    "shingles_by_sql": "SELECT doc_id, count(DISTINCT g) AS n_shingles, count(*) AS n_places FROM (SELECT doc_id, substr(h, (2 * i + 1)::BIGINT, 10) AS g FROM (SELECT doc_id, h, unnest(range(greatest(len(h) // 2 - 4, 1))) AS i FROM (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents))) GROUP BY doc_id",
    "html_escape": "SELECT page_id, md5(replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#39;')) AS escaped_md5 FROM pages",
    "page_titles": "SELECT page_id, regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title FROM pages",
    "image_types": "SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 'image/png' WHEN 1 THEN 'image/jpeg' END AS type FROM documents",
    "record_search": "SELECT doc_id FROM documents WHERE contains(doc_id::VARCHAR, '17') OR contains(text, '17')",
    "ids_from_paths": "SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN 'stage2_illustration' ELSE 'stage1_icon' END || '/' || t || CASE WHEN doc_id % 2 = 0 THEN '/stage2-illustration-' ELSE '/stage1-icon-' END || t || '-data_000000:' || doc_id AS id FROM (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'text2svg' ELSE 'img2svg' END AS t FROM documents)",
    "jsonl_round_trip": "SELECT CASE WHEN doc_id % 50 = 7 THEN 'json_parse_error' ELSE 'ok' END AS skip_reason, count(*) AS n, sum(CASE WHEN doc_id % 50 <> 7 THEN n_chars END)::BIGINT AS chars FROM documents WHERE doc_id % 50 <> 8 GROUP BY ALL",
    "resume_pending": "SELECT lang, count(*) AS n FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic IS DISTINCT FROM 1) GROUP BY lang",
    "enrich_stub": "SELECT CASE WHEN length(text) % 10 = 3 THEN 'error' ELSE 'ok' END AS status, count(*) AS n, count(DISTINCT CASE WHEN length(text) % 10 <> 3 THEN upper(text[:3]) END) AS responses FROM documents GROUP BY ALL",
    "retry_classes": "SELECT CASE event_id % 8 WHEN 0 THEN 'ok' WHEN 1 THEN 'wait' WHEN 2 THEN 'wait' WHEN 3 THEN 'wait' WHEN 4 THEN 'stop' WHEN 5 THEN 'stop' ELSE 'retry' END AS class, count(*) AS n FROM events GROUP BY ALL",
    "call_usage": "SELECT 'stub' AS model, CASE WHEN doc_id % 9 = 0 THEN 'error' ELSE 'ok' END AS status, count(*) AS calls, 3 * count(*) AS completion_tokens FROM documents GROUP BY ALL",
    "embedding_buckets": "SELECT coalesce(lang, 'unknown') AS bucket, count(*) AS n FROM embeddings LEFT JOIN (SELECT doc_id, lang FROM documents WHERE doc_id % 3 <> 0) d ON vec_id = doc_id GROUP BY ALL",
    "events_first_seen": "SELECT event_type, min(ts) AS ts, arg_min(event_id, struct_pack(ts, event_id)) AS event_id FROM events GROUP BY event_type",
    "event_windows": "SELECT date_trunc('day', ts)::TIMESTAMP AS start, event_type, count(*) AS n FROM events GROUP BY ALL",
}
