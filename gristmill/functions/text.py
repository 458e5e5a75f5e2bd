"""Column functions on text."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: What counts as white space at the ends of a text.
SPACE = r"[\s\p{Z}\x{85}\x{1c}-\x{1f}]"
NO_SPACE = SPACE.replace("[", "[^", 1)
MIN_LENGTH = 3


def _nfc(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else unicodedata.normalize("NFC", t) for t in texts.to_pylist()], pa.string())


def nfc(text: Column) -> Column:
    """NFC form; only texts with a character outside ASCII are sent to Python.

    It is called nondeterministic so that no filter on its result is pushed below it and makes it run twice.
    """
    made = F.arrow_udf(_nfc, StringType()).asNondeterministic()
    return F.coalesce(made(F.when(F.octet_length(text) != F.length(text), text)), text)


def strip(text: Column) -> Column:
    """Without white space of any kind at the ends (``trim`` takes spaces only).

    One match from the start to the last other character; a search for white space at the end would begin anew at each space.
    """
    return F.regexp_extract(text, f"(?s)\\A{SPACE}*+(.*{NO_SPACE})", 1)


def clean_text(text: Column) -> Column:
    return strip(nfc(text))


def code_block(text: Column, language: str) -> Column:
    """The trimmed body of the first fenced block of a language (any case), else null."""
    found = F.regexp_extract(text, rf"(?is)```{language}\s*\n?(.*?)```", 1)
    return F.when(text.rlike(rf"(?is)```{language}\s*\n?.*?```"), strip(found))


def raw_element(text: Column, name: str = "svg") -> Column:
    """The first whole element of a name, tags included, else null."""
    found = F.regexp_extract(text, rf"(?is)<{name}.*?</{name}>", 0)
    return F.when(found != "", found)


def best_element(text: Column, name: str = "svg") -> Column:
    """From a fenced block if there is one, else raw."""
    return F.coalesce(code_block(text, name), raw_element(text, name))


def escape_html(text: Column) -> Column:
    #: The five characters and their entities, ampersand first.
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def segments(text: Column) -> Column:
    """array<struct<kind, language, body>>: text and fenced code in turn, empty texts left out."""
    parts = F.split(text, "```", -1)

    def made(part: Column, at: Column) -> Column:
        code = (at % 2) == 1
        language = F.when(code, F.regexp_extract(part, r"^(\w*)", 1)).otherwise("")
        body = F.when(code, strip(F.regexp_replace(part, r"^\w*", ""))).otherwise(part)
        return F.struct(F.when(code, "code").otherwise("text").alias("kind"), language.alias("language"), body.alias("body"))

    return F.filter(F.transform(parts, made), lambda s: (s["kind"] == "code") | (strip(s["body"]) != ""))


def extension_type(path: Column) -> Column:
    """Image type by the file name's last suffix, else null."""
    #: The formats that a record may have.
    kinds = {"jpg": "image/jpeg", "jpeg": "image/jpeg", "png": "image/png"}
    suffix = F.lower(F.regexp_extract(path, r"\.([^./\\]+)$", 1))
    return F.create_map(*(F.lit(x) for kv in kinds.items() for x in kv))[suffix]


def shingle_counts(batches: Iterator[pa.RecordBatch], width: int = 5) -> Iterator[pa.RecordBatch]:
    """(doc_id, n_bytes, n_shingles) with distinct runs of ``width`` bytes."""
    from gristmill.operators.lsh import byte_shingles

    for batch in batches:
        n = [len(byte_shingles(t or "", width)) for t in batch["text"].to_pylist()]
        size = pc.binary_length(batch["text"]).fill_null(0).cast(pa.int64())
        yield pa.RecordBatch.from_arrays([batch["doc_id"], size, pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_shingles"])
