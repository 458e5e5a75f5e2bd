"""Queries for scans, sinks, records and single rules, on the driver's tables.

JSON lines are made of ``documents``: 20 files by doc_id, in order of doc_id, some lines blank, some cut short.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gristmill import schema
from gristmill.operators import cluster, convert, curate, enrich, report, sample
from gristmill.plans import queries
from gristmill.sources import jsonl
from gristmill.sources.stores import saved, shared_folder, table

LINE = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("lang", T.StringType()), T.StructField("meta", T.StructType([T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]))])
FILES, CUT, BLANK, FIRST = 20, 7, 8, 5


def folder(spark, name: str) -> str:
    return f"{shared_folder(spark)}/tables-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def docs(spark, d) -> DataFrame:
    return table(spark, d, "documents")


def lines(spark, d, spoiled: bool = True) -> str:
    """A folder of JSON-line files, f=0 to f=19."""
    n, path = F.col("doc_id"), folder(spark, "lines")
    rows = docs(spark, d).select("doc_id", (n % FILES).alias("f"), F.to_json(F.struct("doc_id", "lang", F.struct("source", "n_chars").alias("meta"))).alias("value"))
    if spoiled:
        rows = rows.withColumn("value", F.when(n % 50 == CUT, '{"doc_id": ').when(n % 50 == BLANK, "  ").otherwise(F.col("value")))
    rows.repartition("f").sortWithinPartitions("f", "doc_id").select("f", "value").write.partitionBy("f").text(path)
    return path


def scan_lenient(spark, d):
    return jsonl.scan(spark, lines(spark, d), LINE).select("doc_id", "lang", "meta.source", "meta.n_chars")


def scan_strict(spark, d):
    return jsonl.scan(spark, lines(spark, d, False), LINE, "strict").select("doc_id", "lang", "meta.source", "meta.n_chars")


def scan_missing(spark, d):
    return jsonl.scan_or_empty(spark, folder(spark, "none"), LINE).agg(F.count("*").alias("n"))


def scan_field(spark, d):
    return jsonl.field(jsonl.scan(spark, lines(spark, d), LINE), "meta.source").groupBy("value").agg(F.count("*").alias("n"))


def line_count(spark, d):
    return spark.range(1).select(F.lit(jsonl.count_lines(spark, lines(spark, d))).cast("long").alias("n"))


def line_numbers(spark, d):
    return jsonl.numbered(jsonl.scan(spark, lines(spark, d), LINE)).select("doc_id", "line_no")


def scan_first_rows(spark, d):
    return jsonl.limited(jsonl.scan(spark, lines(spark, d), LINE), FIRST).select("doc_id", "line_no")


def sink_count(spark, d):
    """Written twice, the second time appended: what the sink says and what is there."""
    path, rows = folder(spark, "sink"), docs(spark, d).select("doc_id", "lang")
    said = jsonl.write(rows, path) + jsonl.write(rows, path, append=True)
    return spark.read.schema("doc_id long, lang string").json(path).groupBy("lang").agg(F.count("*").alias("n")).withColumn("said", F.lit(said).cast("long"))


def ordered_union(spark, d):
    """Three tables one after the other, numbered in their order."""
    rows = docs(spark, d).select("doc_id", "lang")
    all_ = jsonl.ordered_union([rows.where(f"doc_id % 3 = {k}") for k in (2, 0, 1)])
    return all_.groupBy("file_rank").agg(F.count("*").alias("n"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))


def image_uris(spark, d):
    name = F.concat(F.lit("p/"), F.col("page_id").cast("string"), F.element_at(F.array(*map(F.lit, (".png", ".JPG", ".bin"))), (F.col("page_id") % 3 + 1).cast("int")))
    pages = table(spark, d, "pages").select(name.alias("path"), F.encode("html", "utf-8").alias("content"))
    return enrich.data_uri(pages).select("path", F.md5("uri").alias("uri_md5"))


def call_log_sink(spark, d):
    path, n = folder(spark, "calls"), F.col("doc_id")
    rows = docs(spark, d).select(n.cast("string").alias("id"), F.lit("draw it").alias("instruction"), F.when(n % 9 == 0, "error").otherwise("ok").alias("status"), F.lit("a b c").alias("response"), F.lit(None).cast("string").alias("error"))
    for part in (0, 1):
        enrich.log_calls(enrich.call_log(rows.where(f"id % 2 = {part}"), "local", "stub"), path)
    return enrich.usage(spark.read.schema(schema.CALL_LOG).json(path))


def resume_limited(spark, d):
    done = table(spark, d, "labels").select(F.col("doc_id").alias("id"), F.when(F.col("toxic") == 1, "error").otherwise("ok").alias("status"))
    rows = docs(spark, d).select("doc_id", "lang")
    return enrich.pending(rows, done, "doc_id", limit=300).groupBy("lang").agg(F.count("*").alias("n"))


def records(spark, d) -> DataFrame:
    n = F.col("doc_id")
    meta = F.struct(F.when(n % 4 == 0, "").when(n % 4 == 1, F.lit(None).cast("string")).otherwise(F.concat(F.lit("m"), n.cast("string"))).alias("id"), F.lit("d").alias("domain"), "source")
    return docs(spark, d).select("doc_id", F.when(n % 8 != 0, F.concat(F.lit("r"), n.cast("string"))).alias("id"), "n_chars", meta.alias("_meta"))


def meta_upsert(spark, d):
    out = convert.with_meta(records(spark, d), domain=F.lit("new"), svg_len=F.col("n_chars"))
    return out.select("doc_id", "_meta.id", "_meta.domain", "_meta.source", "_meta.svg_len")


def record_keys(spark, d):
    rows = records(spark, d)
    return rows.select("doc_id", convert.record_key(rows).alias("key"))


def image_position(spark, d):
    n = F.col("doc_id")
    raw = F.concat(F.when(n % 4 == 0, "<image> ").otherwise(""), F.when(n % 5 == 0, "").otherwise("Instruction: "), F.coalesce("text", F.lit("")), F.when(n % 4 == 1, " <image>").otherwise(""))
    return docs(spark, d).select("doc_id", convert.image_first(raw).alias("first"))


def record_faults(spark, d):
    """One fault after another put in good records."""
    n = F.col("doc_id")
    words, picture = convert.text_item(F.lit("t")), convert.image_item(F.lit("a.png"))
    item = (
        F.when(n % 10 == 0, F.array(convert.text_item(F.lit(None).cast("string"))))
        .when(n % 10 == 1, F.array(picture.withField("image.format", F.lit("image/tiff")), words))
        .when(n % 10 == 2, F.array(picture.withField("image.relative_path", F.lit(None).cast("string"))))
        .when(n % 10 == 3, F.array(words, picture.withField("image.width", F.lit(None).cast("int"))))
        .when(n % 10 == 4, F.array(words.withField("type", F.lit("sound"))))
        .when(n % 10 == 5, F.array().cast(T.ArrayType(schema.ITEM)))
        .otherwise(F.array(picture, words))
    )
    user, reply = convert.turn("user", item), convert.turn("assistant", F.array(convert.text_item(convert.fenced(F.col("text")))))
    data = F.when(n % 10 == 6, F.array(user)).when(n % 10 == 7, F.array(reply, user)).otherwise(F.array(user, reply))
    prompts = F.when(n % 10 == 8, F.array(F.lit("p"))).otherwise(F.array(F.lit("")))
    return docs(spark, d).select("doc_id", convert.fault(data, prompts).alias("fault"))


#: Leaves of a good record, in order, what is put in their place, and what is wrong then.
WRONG = [
    ('"meta_prompt":[""],', "", "meta_prompt is missing"), ('"data":[', '"dates":[', "data is missing"), ('"meta_prompt":[""]', '"meta_prompt":""', "meta_prompt is no list"),
    ('"meta_prompt":[""]', '"meta_prompt":[0]', "meta_prompt is not known"), ('"data":[', '"data":[1,', "data is not two turns"), ('"role":"user"', '"role":7', "data[0].role is not user"),
    ('"content":[{"type":"image"', '"content":5,"was":[{"type":"image"', "data[0].content is no list with items"), ('"type":"image"', '"type":false', "data[0]: item type is not known"),
    ('"type":"relative_path"', '"type":null', "data[0]: image.type is not relative_path"), ('"format":"image/png"', '"format":["image/png"]', "data[0]: image.format is not known"),
    ('"relative_path":"a.png"', '"relative_path":3', "data[0]: image.relative_path is no path"), ('"width":0', '"width":"0"', "data[0]: image.width is no integer"),
    ('"height":0', '"height":0.5', "data[0]: image.height is no integer"), ('"type":"string"', '"type":1', "data[0]: text.type is not string"),
    ('"format":"utf-8"', '"format":{}', "data[0]: text.format is not utf-8"), ('"string":"t"', '"string":12', "data[0]: text.string is no string"),
    ('"role":"assistant"', '"role":["assistant"]', "data[1].role is not assistant"), ('"role":"assistant","content":[', '"role":"assistant","content":[],"was":[', "data[1].content is no list with items"),
    ('"role":"assistant","content":[', '"role":"assistant","content":[{"type":"image"},', "data[1]: image where none may be"), ('"role":"assistant","content":[', '"role":"assistant","content":[7,', "data[1]: item type is not known"),
    ("{", "[{", "record is no object"), ('{"meta_prompt":[""],', '{"meta_prompt":["",""],', None),
]


def typed_faults(spark, d):
    """Records of all documents in which each leaf in turn has another type, and one in 23 is good."""
    n = F.pmod("doc_id", F.lit(len(WRONG) + 1))
    image, words = convert.image_item(F.lit("a.png")), convert.text_item(F.lit("t"))
    data = F.array(convert.turn("user", F.array(image, words)), convert.turn("assistant", F.array(convert.text_item(F.col("text")))))
    good = F.to_json(F.struct(F.array(F.lit("")).alias("meta_prompt"), data.alias("data")))
    line, own = F.col("_good"), F.col("_good")
    for k, (was, now, _) in enumerate(WRONG):
        at = F.locate(was, own)
        line = F.when(n == k, F.concat(F.substring(own, F.lit(1), at - 1), F.lit(now), F.substring(own, at + len(was), F.length(own)))).otherwise(line)
    rows = docs(spark, d).select("doc_id", good.alias("_good")).select("doc_id", line.alias("_line")).select("doc_id", F.try_parse_json("_line").alias("v"))
    return rows.select("doc_id", convert.typed_fault(F.col("v")).alias("fault"))


def record_shape(spark, d):
    rows = docs(spark, d).select(F.to_json(F.struct("doc_id", F.when(F.col("doc_id") % 3 == 0, F.struct(F.col("lang").alias("a"))).alias("b"))).alias("line"))
    return convert.shapes(rows.withColumn("line", F.when(F.col("line").contains("17"), "{").otherwise(F.col("line"))), "line")


def viewer_scan(spark, d):
    """Chat records of all documents as JSON lines, some cut short, scanned once: counts, values and the ids of a sample."""
    n, path = F.col("doc_id"), folder(spark, "chats")
    image = convert.image_item(F.when(n % 2 == 0, "a.png").otherwise("a.jpg"))
    content = F.when(n % 4 == 0, F.array(image, convert.text_item(F.col("text")))).otherwise(F.array(convert.text_item(F.col("text"))))
    data = F.array(convert.turn("user", content), F.struct(F.when(n % 5 == 0, "tool").otherwise("assistant").alias("role"), F.array(convert.text_item(F.col("lang"))).alias("content")))
    prompts = F.when(n % 3 == 0, F.array(F.lit(""), F.lit(""))).otherwise(F.array(F.lit("")))
    line = F.to_json(F.struct(F.col("doc_id").alias("id"), prompts.alias("meta_prompt"), data.alias("data")))
    docs(spark, d).select(F.when(n % 50 == CUT, '{"id": ').when(n % 50 == BLANK, " ").otherwise(line).alias("value")).write.text(path)
    whole, picked = report.viewed(spark.read.text(path), 25)
    ids = picked.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "line"))), lambda x: F.get_json_object(x["line"], "$.id")), ",").alias("sample"))  # 25 rows
    return whole.select("rows", "rejects", *(F.array_join(c, ",").alias(c) for c in report.SETS), "has_image", "has_video").crossJoin(F.broadcast(ids))  # one row each


def prompt_contents(spark, d):
    uri, n = F.lit("data:image/png;base64,AA=="), F.col("doc_id")
    content = F.when(n % 3 == 0, enrich.prompt_content(F.col("text"))).when(n % 3 == 1, enrich.prompt_content(F.col("text"), uri)).otherwise(enrich.prompt_content(F.col("text"), uri, False))
    out = docs(spark, d).select("doc_id", content.alias("c"))
    return out.select("doc_id", F.array_join(F.transform("c", lambda x: x["type"]), ",").alias("types"), F.length(F.array_join(F.transform("c", lambda x: F.coalesce(x["text"], F.lit(""))), "")).alias("chars"))


def reply_blocks(spark, d):
    """Constructors of items and turns, read back by the rules that take records apart."""
    content = F.array(convert.image_item(F.lit("x/a.jpeg")), convert.text_item(F.col("text")))
    data = F.array(convert.turn("user", content), convert.turn("assistant", F.array(convert.text_item(convert.fenced(F.col("lang"), "txt")))))
    return docs(spark, d).select("doc_id", F.md5(convert.first_text(data, 1, "user")).alias("user_md5"), convert.first_text(data, 2, "assistant").alias("reply"), data[0]["content"][0]["image"]["format"].alias("format"))


def dedup_rates(spark, d):
    """Rates of the run's own stages: all rows, those left by exact and by near dedup, and the pool with its parts.

    Near-dedup drops the copies of a text within its domain as well, so it leaves the same rows of a domain with or without the stage before.
    """
    clean = saved(curate.clean(docs(spark, d)).select("doc_id", "lang", "source", "text"))  # both dedups read it
    exact = curate.exact_dedup(clean.select("doc_id", "source", F.sha2("text", 256).alias("text")), "text", queries.priority(), "doc_id").count()
    near, pool = queries.survivors(clean.select("doc_id", "lang", "text")).count(), queries.pooled(spark, d)
    high = saved(sample.high_priority(pool, queries.HIGH, queries.SEED, "seq"))
    r = report.rates(docs(spark, d).count(), exact, near, pool.count(), high.count(), sample.remainder(pool, high, "seq").count())
    return spark.range(1).select(F.round(F.lit(r["exact_rate"]), 6).alias("exact_rate"), F.round(F.lit(r["near_rate"]), 6).alias("near_rate"), F.lit(r["pool_ok"]).alias("pool_ok"))


def cluster_size_histogram(spark, d):
    sizes = table(spark, d, "embeddings").groupBy("label").agg(F.count("*").alias("size"))
    return report.histogram(sizes, "size", 10).select("bin", F.round("low", 4).alias("low"), F.round("high", 4).alias("high"), "n")


def kmeans_fixed_point(spark, d):
    """Of each bucket: rows, clusters, and rows that lie nearer (by over 0.01) to another cluster's mean."""
    v = table(spark, d, "embeddings").withColumn("bucket", F.concat(F.lit("b"), F.pmod("vec_id", F.lit(2)).cast("string")))
    rows = saved(cluster.clustered(v, "bucket", {"b0": 4}, 6).select("vec_id", "bucket", F.concat_ws("/", "bucket", "cluster_id").alias("own"), "embedding", "distance_to_centroid"))
    out = None
    for name in ("b0", "b1"):
        mine = rows.where(F.col("bucket") == name)
        middles = cluster.centroids(mine, ["own"]).withColumnRenamed("own", "label")
        part = cluster.nearest(mine, middles).groupBy("bucket").agg(F.count("*").alias("n"), F.countDistinct("own").alias("clusters"), F.count_if(F.col("distance") < F.col("distance_to_centroid") - 0.01).alias("nearer_to_another"))
        out = part if out is None else out.unionByName(part)
    return out


def projection(spark, d):
    """The two main axes of all rows; an axis has no sign of its own."""
    p = cluster.projected(table(spark, d, "embeddings"), "vec_id", rows=None)
    return p.select("vec_id", F.round(F.abs("x"), 4).alias("x"), F.round(F.abs("y"), 4).alias("y"))


def projection_sample(spark, d):
    return sample.hashed_sample(table(spark, d, "embeddings"), cluster.PROJECTED, "vec_id").select("vec_id", "label")


GOOD = f"WITH g AS (SELECT *, doc_id % {FILES} AS f FROM documents WHERE doc_id % 50 NOT IN ({CUT}, {BLANK}))"
NUMBERED = f"{GOOD}, l AS (SELECT doc_id, row_number() OVER (PARTITION BY f ORDER BY doc_id) - 1 AS line_no FROM g)"

QUERIES = {
    f.__name__: f
    for f in (
        scan_lenient, scan_strict, scan_missing, scan_field, line_count, line_numbers, scan_first_rows, sink_count, ordered_union, image_uris, call_log_sink, resume_limited, meta_upsert,
        record_keys, image_position, record_faults, typed_faults, record_shape, viewer_scan, prompt_contents, reply_blocks, dedup_rates, cluster_size_histogram, kmeans_fixed_point, projection, projection_sample,
    )
}

PROMPT = "Write SVG code for this instruction:\n"
ORACLE_SQL = {
    "scan_lenient": f"{GOOD} SELECT doc_id, lang, source, n_chars FROM g",
    "scan_strict": "SELECT doc_id, lang, source, n_chars FROM documents",
    "scan_missing": "SELECT 0::BIGINT AS n",
    "scan_field": f"{GOOD} SELECT source AS value, count(*) AS n FROM g WHERE source IS NOT NULL GROUP BY source",
    "line_count": f"SELECT count(*) AS n FROM documents WHERE doc_id % 50 <> {BLANK}",
    "line_numbers": f"{NUMBERED} SELECT doc_id, line_no FROM l",
    "scan_first_rows": f"{NUMBERED} SELECT doc_id, line_no FROM l WHERE line_no < {FIRST}",
    "sink_count": "SELECT lang, 2 * count(*) AS n, (SELECT 2 * count(*) FROM documents) AS said FROM documents GROUP BY lang",
    "ordered_union": "SELECT CASE doc_id % 3 WHEN 2 THEN 0 WHEN 0 THEN 1 ELSE 2 END::INT AS file_rank, count(*) AS n, min(doc_id) AS first, max(doc_id) AS last FROM documents GROUP BY ALL",
    "image_uris": "SELECT 'p/' || page_id || CASE page_id % 3 WHEN 0 THEN '.png' WHEN 1 THEN '.JPG' ELSE '.bin' END AS path, md5('data:' || CASE page_id % 3 WHEN 0 THEN 'image/png' WHEN 1 THEN 'image/jpeg' ELSE 'application/octet-stream' END || ';base64,' || base64(encode(html))) AS uri_md5 FROM pages",
    "call_log_sink": "SELECT 'stub' AS model, CASE WHEN doc_id % 9 = 0 THEN 'error' ELSE 'ok' END AS status, count(*) AS calls, 2 * count(*) AS prompt_tokens, 3 * count(*) AS completion_tokens FROM documents GROUP BY ALL",
    "resume_limited": "WITH f AS (SELECT * FROM documents ORDER BY doc_id LIMIT 300) SELECT lang, count(*) AS n FROM f WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic IS DISTINCT FROM 1) GROUP BY lang",
    "meta_upsert": "SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN '' WHEN 1 THEN NULL ELSE 'm' || doc_id END AS id, 'new' AS domain, source, n_chars AS svg_len FROM documents",
    "record_keys": "SELECT doc_id, CASE WHEN doc_id % 4 > 1 THEN 'm' || doc_id WHEN doc_id % 8 <> 0 THEN 'r' || doc_id ELSE '' END AS key FROM documents",
    "image_position": "WITH r AS (SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN '<image> ' ELSE '' END || CASE WHEN doc_id % 5 = 0 THEN '' ELSE 'Instruction: ' END || coalesce(text, '') || CASE WHEN doc_id % 4 = 1 THEN ' <image>' ELSE '' END AS p FROM documents) SELECT doc_id, strpos(p, '<image>') > 0 AND strpos(p, 'Instruction:') > strpos(p, '<image>') AS first FROM r",
    "record_faults": """SELECT doc_id, CASE doc_id % 10 WHEN 0 THEN 'text item without a string' WHEN 1 THEN 'image format not known' WHEN 2 THEN 'image item without a path' WHEN 3 THEN 'image size missing' WHEN 4 THEN 'item type not known'
  WHEN 5 THEN 'empty content' WHEN 6 THEN 'fewer than two turns' WHEN 7 THEN 'roles out of order' WHEN 8 THEN 'meta_prompt not known' ELSE CASE WHEN text IS NULL THEN 'text item without a string' END END AS fault FROM documents""",
    "prompt_contents": f"SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'text' WHEN 1 THEN 'image_url,text' ELSE 'text,image_url' END AS types, coalesce({len(PROMPT)} + length(text), 0)::INT AS chars FROM documents",
    "reply_blocks": "SELECT doc_id, md5(text) AS user_md5, '```txt' || chr(10) || lang || chr(10) || '```' AS reply, 'image/jpeg' AS format FROM documents",
    "dedup_rates": f"""
WITH s AS (SELECT count(*)::DOUBLE AS c FROM ({queries.ORACLE_SQL["near_dedup_survivors"]})), e AS (SELECT count(*)::DOUBLE AS b FROM ({queries.ORACLE_SQL["exact_dedup"]}))
SELECT round(1 - b / (SELECT count(*) FROM documents), 6) AS exact_rate, round(1 - c / b, 6) AS near_rate, true AS pool_ok FROM s, e""",
    "cluster_size_histogram": "WITH z AS (SELECT label, count(*) AS size FROM embeddings GROUP BY label), s AS (SELECT min(size)::DOUBLE AS lo, max(size)::DOUBLE AS hi FROM z), b AS (SELECT CASE WHEN hi > lo THEN least(floor((size - lo) / ((hi - lo) / 10)), 9) ELSE 0 END::INT AS bin, lo, (hi - lo) / 10 AS w FROM z, s) SELECT bin, round(lo + bin * w, 4) AS low, round(lo + (bin + 1) * w, 4) AS high, count(*) AS n FROM b GROUP BY bin, lo, w",
    "kmeans_fixed_point": "SELECT 'b' || (vec_id % 2) AS bucket, count(*) AS n, CASE vec_id % 2 WHEN 0 THEN 4 ELSE 6 END::BIGINT AS clusters, 0::BIGINT AS nearer_to_another FROM embeddings GROUP BY ALL",
    "typed_faults": "SELECT doc_id, CASE doc_id % " + str(len(WRONG) + 1) + " " + " ".join(f"WHEN {k} THEN '{w}'" for k, (_, _, w) in enumerate(WRONG) if w) + " END AS fault FROM documents",
    "record_shape": "SELECT count(*) AS rows, count(*) FILTER (contains(doc_id::VARCHAR, '17') OR (doc_id % 3 = 0 AND contains(lang, '17'))) AS rejects, 'OBJECT<b: OBJECT<a: STRING>, doc_id: BIGINT>' AS shape FROM documents",
    "viewer_scan": f"""
WITH g AS (SELECT * FROM documents WHERE doc_id % 50 <> {BLANK}), k AS (SELECT * FROM g WHERE doc_id % 50 <> {CUT})
SELECT (SELECT count(*) FROM g) AS rows, (SELECT count(*) FROM g WHERE doc_id % 50 = {CUT}) AS rejects, 'assistant,tool,user' AS roles, 'image,text' AS types, 'image/png' AS formats,
       ',|' AS prompts, true AS has_image, false AS has_video,
       (SELECT string_agg(doc_id::VARCHAR, ',' ORDER BY md5('42' || doc_id)) FROM (SELECT * FROM k ORDER BY md5('42' || doc_id) LIMIT 25)) AS sample""",
    "projection_sample": "SELECT vec_id, label FROM embeddings ORDER BY md5('42' || vec_id), vec_id LIMIT 50000",
    "projection": """
WITH RECURSIVE e AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
u AS (SELECT vec_id, unnest(x) AS v, generate_subscripts(x, 1) AS i FROM e),
z AS MATERIALIZED (SELECT vec_id, i, v - avg(v) OVER (PARTITION BY i) AS v FROM u),
m AS MATERIALIZED (SELECT list(r ORDER BY i) AS c FROM (SELECT i, list(s ORDER BY j) AS r FROM (SELECT a.i, b.i AS j, sum(a.v * b.v) AS s FROM z a JOIN z b USING (vec_id) GROUP BY ALL) GROUP BY i)),
p AS (SELECT 0 AS it, list_transform(c[1], lambda x: 1.0::DOUBLE) AS v FROM m
      UNION ALL SELECT it + 1, list_transform(w, lambda x: x / sqrt(list_inner_product(w, w))) FROM (SELECT it, list_transform(c, lambda r: list_inner_product(r, v)) AS w FROM p, m WHERE it < 3000)),
a AS MATERIALIZED (SELECT v, list_inner_product(v, list_transform(c, lambda r: list_inner_product(r, v))) AS l FROM p, m WHERE it = 3000),
n AS MATERIALIZED (SELECT list_transform(range(1, len(v) + 1), lambda i: list_transform(range(1, len(v) + 1), lambda j: c[i][j] - l * v[i] * v[j])) AS c FROM m, a),
q AS (SELECT 0 AS it, list_transform(c[1], lambda x: 1.0::DOUBLE) AS v FROM n
      UNION ALL SELECT it + 1, list_transform(w, lambda x: x / sqrt(list_inner_product(w, w))) FROM (SELECT it, list_transform(c, lambda r: list_inner_product(r, v)) AS w FROM q, n WHERE it < 3000))
SELECT vec_id, round(abs(list_inner_product(x, a.v)), 4) AS x, round(abs(list_inner_product(x, q.v)), 4) AS y FROM e, a, q WHERE q.it = 3000""",
}
