"""Token counts of byte-level BPE by rank-synchronous merging of arrays.

Texts are cut into pre-tokens by the vocabulary's own rule, and equal pre-tokens of a batch are merged once,
all distinct ones together in flat arrays (``bpe``). The symbols that survive are counted.

What a batch needs is bounded: texts are worked on in runs of rows of RUN bytes (a longer text is a run of its own), and
nothing is kept from run to run.

Defined cases: a null text is empty and has 0 bytes and 0 tokens; a special token's string inside a text is
that one token, as the library's default has it; repeated rows and null ids are rows like others; an empty table gives no rows; extra columns don't matter.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gristmill.llm.bpe import Merges
from gristmill.llm.text import buffers, runs, tidy

LIMIT = 512
#: Bytes of texts that are cut and merged together.
RUN = 8 << 20
#: Symbols that are merged together; a longer pre-token is a part of its own.
SYMBOLS = 1 << 16
#: Fixed value: the byte-level rule for pre-tokens.
RULE = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")
#: Blocks of characters whose kind doesn't differ between versions of Unicode; texts with others are cut by the tokenizer itself.
SETTLED = regex.compile(r"[\x00-՗֐-࡯ऀ-௿ഀ-⁯₠-Ꟁ가-￿\U0001F000-\U0001FAFF\U00020000-\U0002B700]*")


class Vocabulary:
    """Merges, what the special tokens are called, and the tokenizer's own way to cut texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            model = json.load(f)
        self.merges = Merges(model["model"])
        specials = [t["content"] for t in model["added_tokens"]]
        self.special = regex.compile("|".join(map(regex.escape, specials))) if specials else None
        self.cut_by_library = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str

    def cut(self, text: str) -> tuple[list[str], int]:
        """Pre-tokens of a text, and how many special tokens stand between them."""
        parts = self.special.split(text) if self.special else [text]
        out: list[str] = []
        for part in parts:
            if SETTLED.fullmatch(part):
                out += RULE.findall(part)
            elif part:
                out += [part[lo:hi] for _, (lo, hi) in self.cut_by_library(part)]
        return out, len(parts) - 1


def merged_counts(vocabulary: Vocabulary, distinct: pa.Array) -> np.ndarray:
    """Tokens of each of some distinct pre-tokens (a string array), in parts of about SYMBOLS symbols."""
    data, offs = buffers(distinct)
    out = np.zeros(len(distinct), np.int64)
    for lo, hi in runs(offs, SYMBOLS):
        own = np.diff(offs[lo : hi + 1])
        full = np.flatnonzero(own > 0)
        if len(full):
            out[lo + full] = vocabulary.merges.merged(data[offs[lo] : offs[hi]], own[full], whole=False)[1]
    return out


def counts(vocabulary: Vocabulary, texts: pa.Array) -> np.ndarray:
    """Tokens of each text; null counts as empty."""
    _, offs = buffers(texts)
    out = np.zeros(len(texts), np.int64)
    for lo, hi in runs(offs, RUN):
        cuts, ends, special = [], [], []
        for text in texts.slice(lo, hi - lo).to_pylist():
            parts, n = vocabulary.cut(text or "")
            cuts += parts
            ends.append(len(cuts))
            special.append(n)
        names = pa.array(cuts, pa.string()).dictionary_encode()
        del cuts
        sums = np.concatenate(([0], np.cumsum(merged_counts(vocabulary, names.dictionary)[names.indices.to_numpy()])))
        out[lo:hi] = np.diff(sums[ends], prepend=0) + special
    return out


def _count(path: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(path)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(np.diff(buffers(batch["text"])[1])), pa.array(counts(vocabulary, batch["text"]))], ["doc_id", "n_bytes", "n_tokens"])

    return run


def counted(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of each row; ``path`` names the vocabulary's file."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    made = docs.select("doc_id", "text").mapInArrow(tidy(_count(path)), f"doc_id {kind}, n_bytes long, n_tokens long")
    return made.withColumn("over_limit", F.col("n_tokens") > limit)
