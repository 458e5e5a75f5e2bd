"""Enrichment of records by an injected callable: resume, retries, result rows and a call log.

No client and no keys are part of this; whoever passes a callable that reaches a service has to
see that its terms permit the use.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gristmill import schema

#: How statuses are treated.
WAIT, STOP = {429, 500, 502, 503, 504}, {400, 401, 403, 404}


#: Bytes of texts whose calls are made at a time; a longer text is a part of its own.
PART = 1 << 20


class CallError(Exception):
    """A failed call with its status (None: no answer) and the seconds the other side asks to wait."""

    def __init__(self, status: int | None = None, retry_after: str | None = None, message: str = ""):
        super().__init__(message or f"status {status}")
        self.status, self.retry_after = status, retry_after


def retry_class(status: Column) -> Column:
    """ok, wait (with the asked delay), stop or retry."""
    return F.when(status.between(200, 299), "ok").when(status.isin(*sorted(WAIT)), "wait").when(status.isin(*sorted(STOP)), "stop").otherwise("retry")


def delay(attempt: int, error: CallError) -> float:
    if error.status in WAIT and error.retry_after:
        try:
            return max(0.0, float(error.retry_after))
        except ValueError:  # a date: wait as if nothing was said
            pass
    return float(2**attempt)


def attempt(call: Callable[[str], str], prompt: str, retries: int, sleep: Callable[[float], None] = time.sleep) -> str:
    for n in range(retries + 1):
        try:
            return call(prompt)
        except CallError as e:
            if e.status in STOP or n == retries:
                raise
            sleep(delay(n, e))
    raise AssertionError


def pending(df: DataFrame, done: DataFrame, key: str, retry_errors: bool = True, limit: int = 0, order: str | None = None) -> DataFrame:
    """Rows that aren't done; an empty id never counts as done, an error is tried again if so asked.

    A limit takes the first rows by ``order`` (the key if none) before those that are done go, so a repeated
    run with one limit doesn't go on to further rows.
    """
    if limit:
        df = df.orderBy(order or key).limit(limit)
    finished = done.where((F.col("id").cast("string") != "") & ((F.col("status") == "ok") if retry_errors else F.lit(True)))
    return df.join(finished.select(F.col("id").alias(key)).distinct(), key, "left_anti")


def parts(batch: pa.RecordBatch, text: str = "instruction") -> Iterator[pa.RecordBatch]:
    """Slices of at least one row and about PART bytes of texts."""
    ends = np.cumsum(pc.binary_length(batch[text]).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + PART, "right")))
        yield batch.slice(lo, hi - lo)
        lo = hi


def enriched(df: DataFrame, key: str, text: str, make: Callable[[], Callable[[str], str]], retries: int = 3, threads: int = 8, tasks: int | None = None, pause: bool = True) -> DataFrame:
    """(id, instruction, status, response, error): a failed call is a row, never a failed task.

    A batch is worked on in parts of about PART bytes of texts, so what a task holds grows neither with its rows nor with its batches.
    """
    own = df.select(F.col(key).cast("string").alias("id"), F.col(text).alias("instruction"))
    own = own.repartition(tasks) if tasks else own

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        call = make()

        def one(prompt: str | None) -> tuple:
            try:
                return "ok", attempt(call, prompt, retries, time.sleep if pause else lambda s: None), None
            except Exception as e:  # noqa: BLE001  the caller's failures become rows
                return "error", None, f"{type(e).__name__}: {e}"

        with ThreadPoolExecutor(threads) as threads_:
            for part in (p for b in batches for p in parts(b)):
                made = zip(*threads_.map(one, part["instruction"].to_pylist()), strict=True)
                yield pa.RecordBatch.from_arrays([part["id"], part["instruction"], *(pa.array(c, pa.string()) for c in made)], schema.ENRICHED.names)

    return own.mapInArrow(run, schema.ENRICHED)


def call_log(results: DataFrame, url: str, model: str) -> DataFrame:
    words = lambda c: F.size(F.split(F.coalesce(c, F.lit("")), r"\s+"))
    return results.select(F.current_timestamp().alias("ts"), F.lit(url).alias("url"), F.lit(model).alias("model"), "status", words(F.col("instruction")).alias("prompt_tokens"), words(F.col("response")).alias("completion_tokens"), "error")


def log_calls(log: DataFrame, path: str) -> int | None:
    """Append a call log as JSON lines and return its rows; None if it can't be written, as a log must not end a run."""
    from gristmill.sources.jsonl import write

    try:
        return write(log, path, append=True)
    except Exception:  # noqa: BLE001  whatever the store says
        logging.getLogger(__name__).warning("the call log could not be written to %s", path, exc_info=True)
        return None


def usage(log: DataFrame) -> DataFrame:
    return log.groupBy("model", "status").agg(F.count("*").alias("calls"), F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens"))


def data_uri(images: DataFrame) -> DataFrame:
    """(path, uri) of a binaryFile scan."""
    from gristmill.functions.text import extension_type

    flat = F.translate(F.base64("content"), "\r\n", "")  # Spark breaks long base64 into lines
    return images.select("path", F.concat(F.lit("data:"), F.coalesce(extension_type(F.col("path")), F.lit("application/octet-stream")), F.lit(";base64,"), flat).alias("uri"))


def prompt_content(instruction: Column, uri: Column | None = None, image_first: bool = True) -> Column:
    """The content array of a request: text, and an image before or after it."""
    kind = "array<struct<type:string,text:string,url:string>>"
    words = F.struct(F.lit("text").alias("type"), F.format_string("Write SVG code for this instruction:\n%s", instruction).alias("text"), F.lit(None).cast("string").alias("url"))
    if uri is None:
        return F.array(words).cast(kind)
    image = F.struct(F.lit("image_url").alias("type"), F.lit(None).cast("string").alias("text"), uri.alias("url"))
    return F.array(*((image, words) if image_first else (words, image))).cast(kind)
