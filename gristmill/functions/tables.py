"""Table functions for SQL: ``LATERAL text_segments(text)``, ``LATERAL text_shingles(text, width)`` and ``table_shingles(TABLE(t), width)``."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.functions import arrow_udtf, udtf
from pyspark.sql.types import IntegerType, LongType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult


def _text(arg: AnalyzeArgument, what: str) -> None:
    if not isinstance(arg.dataType, StringType) and arg.dataType.typeName() != "void":
        raise ValueError(f"{what} takes a string, not {arg.dataType.simpleString()}")


class Segments:
    """(place, kind, language, body): text and fenced code in turn, as ``text.segments`` has them; a null text has none."""

    @staticmethod
    def analyze(text: AnalyzeArgument) -> AnalyzeResult:
        _text(text, "text_segments")
        return AnalyzeResult(StructType().add("place", IntegerType()).add("kind", StringType()).add("language", StringType()).add("body", StringType()))

    def eval(self, text: str | None) -> Iterator[tuple[int, str, str, str]]:
        place = 0
        for n, part in enumerate(text.split("```") if text is not None else ()):
            if n % 2:
                language = re.match(r"[A-Za-z0-9_]*", part)[0]
                yield place, "code", language, part[len(language) :].strip()
            elif part.strip():
                yield place, "text", "", part
            else:
                continue
            place += 1


class Shingles:
    """(shingle, n): each distinct run of ``width`` UTF-8 bytes as a number, and how often it comes; a shorter text is one."""

    @staticmethod
    def analyze(text: AnalyzeArgument, width: AnalyzeArgument) -> AnalyzeResult:
        _text(text, "text_shingles")
        if not width.isConstantExpression or not isinstance(width.value, int) or not 1 <= width.value <= 7:
            raise ValueError("text_shingles takes a constant width of 1 to 7")
        return AnalyzeResult(StructType().add("shingle", LongType()).add("n", LongType()))

    def eval(self, text: str | None, width: int) -> Iterator[tuple[int, int]]:
        data, seen = (text or "").encode(), {}
        for at in range(max(1, len(data) - width + 1)):
            shingle = int.from_bytes(data[at : at + width], "big")
            seen[shingle] = seen.get(shingle, 0) + 1
        yield from seen.items()


class TableShingles:
    """(id, shingle, n) of a table of an id and a text: as ``Shingles``, with the rows of a text as one Arrow batch.

    Whole tables go through it by batches; Spark takes no such function behind LATERAL.
    """

    def eval(self, table: pa.RecordBatch, widths: pa.Array) -> Iterator[pa.RecordBatch]:
        width = widths[0].as_py()
        if not isinstance(width, int) or not 1 <= width <= 7:
            raise ValueError("table_shingles takes a width of 1 to 7")
        for key, text in zip(table.column(0).to_pylist(), table.column(1).cast(pa.large_binary()), strict=True):
            text = text.as_py() or b""
            data = np.frombuffer(text, np.uint8).astype(np.int64)
            made = np.zeros(max(1, len(data) - width + 1), np.int64)
            for i in range(min(width, len(data))):
                made = (made << 8) | data[i : len(made) + i]
            shingle, n = np.unique(made, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), key)), pa.array(shingle), pa.array(n.astype(np.int64))], ["id", "shingle", "n"])


def register(spark: SparkSession) -> None:
    spark.udtf.register("text_segments", udtf(Segments))
    spark.udtf.register("text_shingles", udtf(Shingles))
    spark.udtf.register("table_shingles", arrow_udtf(TableShingles, returnType="id long, shingle long, n long"))
