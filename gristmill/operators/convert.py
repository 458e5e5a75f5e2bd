"""Raw instruction rows to validated chat records, and chat records to intermediate records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill import schema
from gristmill.functions.text import extension_type, strip

#: The mark of an image and of the instruction in a raw prompt; formats and prompts that a record may have.
IMAGE, MARK = "<image>", "Instruction:"
FORMATS = ["image/jpeg", "image/png"]
PROMPTS = {"sft": [""], "pretrain": ["", ""]}
#: What the inner parts of items are called.
TEXT_TYPE, TEXT_FORMAT, IMAGE_TYPE = "string", "utf-8", "relative_path"
#: Fixed value: what follows the instruction's mark in a raw prompt.
TAIL = r'(?s)Instruction:\s*"?(.*?)"?\s*$'


def user_text(prompt: Column) -> Column:
    """What follows the mark, without white space and quotes around it; null if nothing is left."""
    tail = F.regexp_extract(prompt, TAIL, 1)
    bare = strip(F.regexp_replace(strip(tail), '^"+|"+$', ""))
    return F.when(prompt.contains(MARK), F.nullif(bare, F.lit("")))


def image_first(prompt: Column) -> Column:
    """The image's mark stands before the instruction's; false if either is missing."""
    at, mark = F.locate(IMAGE, prompt), F.locate(MARK, prompt)
    return (at > 0) & (mark > 0) & (at < mark)


def text_item(text: Column) -> Column:
    inner = F.struct(F.lit(TEXT_TYPE).alias("type"), F.lit(TEXT_FORMAT).alias("format"), text.alias("string"))
    return F.struct(F.lit("text").alias("type"), inner.alias("text"), F.lit(None).cast(schema.ITEM["image"].dataType).alias("image")).cast(schema.ITEM)


def image_item(path: Column) -> Column:
    inner = F.struct(F.lit(IMAGE_TYPE).alias("type"), extension_type(path).alias("format"), path.alias("relative_path"), F.lit(0).alias("width"), F.lit(0).alias("height"))
    return F.struct(F.lit("image").alias("type"), F.lit(None).cast(schema.ITEM["text"].dataType).alias("text"), inner.alias("image")).cast(schema.ITEM)


def turn(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def fenced(reply: Column, language: str = "svg") -> Column:
    return F.concat(F.lit(f"```{language}\n"), reply, F.lit("\n```"))


def _item_fault(item: Column) -> Column:
    text, image = item["text"], item["image"]
    return (
        F.when(item["type"] == "text", F.when(text.isNull() | text["string"].isNull(), "text item without a string"))
        .when(item["type"] == "image", F.when(image.isNull() | image["relative_path"].isNull(), "image item without a path").when(~F.coalesce(image["format"].isin(FORMATS), F.lit(False)), "image format not known").when(image["width"].isNull() | image["height"].isNull(), "image size missing"))
        .otherwise("item type not known")
    )


def fault(data: Column, prompts: Column) -> Column:
    """The first thing wrong with a chat record, else null."""
    known = F.array(*(F.array(*map(F.lit, p)) for p in PROMPTS.values()))
    faults = F.filter(F.transform(F.flatten(F.transform(data, lambda t: t["content"])), _item_fault), lambda x: x.isNotNull())
    return (
        F.when(prompts.isNull() | ~F.array_contains(known, prompts), "meta_prompt not known")
        .when(data.isNull() | (F.size(data) < 2), "fewer than two turns")
        .when((data[0]["role"] != "user") | (data[1]["role"] != "assistant"), "roles out of order")
        .when(F.exists(data, lambda t: t["content"].isNull() | (F.size(t["content"]) == 0)), "empty content")
        .otherwise(F.try_element_at(faults, F.lit(1)))
    )


def kind(v: Column, path: str) -> Column:
    """The type of a leaf of a record: OBJECT, ARRAY, STRING, BIGINT, BOOLEAN, VOID (a null) and so on; null where it is missing."""
    return F.regexp_extract(F.schema_of_variant(F.try_variant_get(v, path, "variant")), "^[A-Z]+", 0)


def _is(v: Column, path: str, *values: str) -> Column:
    """The part is a string and one of some values."""
    return F.coalesce((kind(v, path) == "STRING") & F.try_variant_get(v, path, "string").isin(*values), F.lit(False))


def _typed_item_faults(content: Column, images: bool) -> Column:
    """What is wrong with each item of a turn's content that isn't right."""
    return F.filter(F.transform(content, lambda item: _typed_item_fault(item, images)), lambda x: x.isNotNull())


def _typed_item_fault(item: Column, images: bool) -> Column:
    number = lambda path: F.coalesce(kind(item, path).isin("BIGINT", "BOOLEAN"), F.lit(False))
    text = (
        F.when(~_is(item, "$.text.type", TEXT_TYPE), f"text.type is not {TEXT_TYPE}")
        .when(~_is(item, "$.text.format", TEXT_FORMAT), f"text.format is not {TEXT_FORMAT}")
        .when(~F.coalesce(kind(item, "$.text.string") == "STRING", F.lit(False)), "text.string is no string")
    )
    image = F.when(F.lit(not images), "image where none may be")
    image = (
        image.when(~_is(item, "$.image.type", IMAGE_TYPE), f"image.type is not {IMAGE_TYPE}")
        .when(~_is(item, "$.image.format", *FORMATS), "image.format is not known")
        .when(~F.coalesce((kind(item, "$.image.relative_path") == "STRING") & (F.try_variant_get(item, "$.image.relative_path", "string") != ""), F.lit(False)), "image.relative_path is no path")
        .when(~number("$.image.width"), "image.width is no integer")
        .when(~number("$.image.height"), "image.height is no integer")
    )
    return F.when(_is(item, "$.type", "text"), text).when(_is(item, "$.type", "image"), image).otherwise("item type is not known")


def typed_fault(v: Column) -> Column:
    """The first thing wrong with a record of any shape, null if nothing is.

    ``v`` is a VARIANT column (made by ``try_parse_json`` in a projection before, so it is parsed once), and a part of the wrong type isn't the same as a missing one.
    Parts are looked at in the order of a record: prompt and data, then each turn's role, content and items.
    """
    prompt, turns = F.try_variant_get(v, "$.meta_prompt", "array<variant>"), F.try_variant_get(v, "$.data", "array<variant>")
    blank = F.size(prompt).between(1, 2) & F.forall(prompt, lambda p: _is(p, "$", ""))
    there = lambda path, of: F.try_variant_get(v, path, of).isNotNull()
    list_of = lambda path: there(path, "array<variant>")
    out = (
        F.when(~there("$", "map<string,variant>"), "record is no object")
        .when(~there("$.meta_prompt", "variant"), "meta_prompt is missing")
        .when(~there("$.data", "variant"), "data is missing")
        .when(~list_of("$.meta_prompt"), "meta_prompt is no list")
        .when(~F.coalesce(blank, F.lit(False)), "meta_prompt is not known")
        .when(~F.coalesce(list_of("$.data") & (F.size(turns) == 2), F.lit(False)), "data is not two turns")
    )
    for n, role in enumerate(("user", "assistant")):
        own = f"$.data[{n}]"
        content = F.try_variant_get(v, f"{own}.content", "array<variant>")
        faults = _typed_item_faults(content, images=n == 0)
        out = (
            out.when(~_is(v, f"{own}.role", role), f"data[{n}].role is not {role}")
            .when(~F.coalesce(list_of(f"{own}.content") & (F.size(content) > 0), F.lit(False)), f"data[{n}].content is no list with items")
            .when(F.size(faults) > 0, F.concat(F.lit(f"data[{n}]: "), F.try_element_at(faults, F.lit(1))))
        )
    return out


def shapes(records: DataFrame, line: str) -> DataFrame:
    """(rows, rejects, shape) of JSON lines: how many there are, how many can't be read, and the schema that fits the rest."""
    v = F.try_parse_json(line)
    return records.agg(F.count(line).alias("rows"), F.count_if(F.col(line).isNotNull() & v.isNull()).alias("rejects"), F.schema_of_variant_agg(v).alias("shape"))


def converted(raw: DataFrame, mode: str = "sft", prefix: str = "") -> DataFrame:
    """``raw`` with meta_prompt, data, skip_reason (null where the record is good) and warning.

    Reasons rank: no reply, no instruction, number of images, path, extension, schema.
    """
    prompt, reply, images = F.col("instruction"), F.col("output"), F.coalesce("images", F.array().cast("array<string>"))
    tagged, path = F.coalesce(prompt.contains(IMAGE), F.lit(False)), F.try_element_at(images, F.lit(1))
    user = user_text(prompt)
    reason = (
        F.when(F.coalesce(reply, F.lit("")) == "", "missing_assistant_text")
        .when(user.isNull(), "missing_user_content")
        .when(tagged & (F.size(images) != 1), "invalid_image_format")
        .when(tagged & (F.coalesce(path, F.lit("")) == ""), "invalid_relative_path")
        .when(tagged & path.startswith("/"), "invalid_relative_path")
        .when(tagged & extension_type(path).isNull(), "invalid_image_format")
    )
    picture, words = image_item(F.concat(F.lit(prefix), path)), text_item(user)
    content = F.when(tagged & image_first(prompt), F.array(picture, words)).when(tagged, F.array(words, picture)).otherwise(F.array(words))
    data = F.array(turn("user", content), turn("assistant", F.array(text_item(fenced(reply)))))
    out = raw.withColumns({"_reason": reason, "meta_prompt": F.array(*map(F.lit, PROMPTS[mode])), "data": data})
    wrong = fault(F.col("data"), F.col("meta_prompt"))
    out = out.withColumn("skip_reason", F.coalesce("_reason", F.when(wrong.isNotNull(), F.concat(F.lit("schema_validation_failed: "), wrong))))
    return out.withColumn("warning", F.when(~tagged & (F.size(images) > 0), "images_without_tag")).drop("_reason")


def skip_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy(F.coalesce("skip_reason", F.lit("ok")).alias("skip_reason")).agg(F.count("*").alias("n"))


def first_text(data: Column, place: int, role: str) -> Column:
    """The first text of a turn that has the role, else null; may be empty."""
    own = F.try_element_at(data, F.lit(place))
    item = F.try_element_at(F.filter(own["content"], lambda i: (i["type"] == "text") & i["text"]["string"].isNotNull()), F.lit(1))
    return F.when(own["role"] == role, item["text"]["string"])


def extracted(records: DataFrame) -> DataFrame:
    """instruction, reply, svg_len, skip_reason of chat records; an empty reply is kept."""
    out = records.withColumns({"instruction": first_text(F.col("data"), 1, "user"), "reply": first_text(F.col("data"), 2, "assistant")})
    reason = F.when(F.coalesce("instruction", F.lit("")) == "", "no_instruction").when(F.col("reply").isNull(), "no_svg")
    return out.withColumns({"skip_reason": reason, "svg_len": F.length("reply").cast("long")})


def with_meta(df: DataFrame, **values: Column) -> DataFrame:
    """``_meta`` with fields set (a shallow merge)."""
    meta = F.col("_meta")
    for name, value in values.items():
        meta = meta.withField(name, value)
    return df.withColumn("_meta", meta)


def record_key(df: DataFrame) -> Column:
    """``_meta.id``, else ``id``, else the empty string."""
    return F.coalesce(F.nullif(F.col("_meta.id"), F.lit("")), F.col("id"), F.lit("")) if "id" in df.columns else F.coalesce(F.col("_meta.id"), F.lit(""))
