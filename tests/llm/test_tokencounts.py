import random

import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from gristmill.llm import tokencounts as tc
from conftest import ODD  # tests/llm/conftest

PATH = public_tokenizers.path("byte_bpe_50k.json")


def library(texts):
    tokenizer = Tokenizer.from_file(PATH)
    return [len(tokenizer.encode(t or "", add_special_tokens=False).ids) for t in texts]


def test_odd_rows_equal_the_library(spark, documents):
    rows = [*ODD, (20, "a<|endoftext|> b  <|endoftext|><|endoftext|>"), (21, "  \n\n a\t\tb  "), (22, "don't WE'LL I'm x're 12345 ½ ٣"), (23, " ".join(["word"] * 600))]
    got = sorted(map(repr, (tuple(r) for r in tc.counted(documents(rows), PATH).collect())))
    true = library([r[1] for r in rows])
    assert got == sorted(repr((r[0], len((r[1] or "").encode()), n, n > 512)) for r, n in zip(rows, true, strict=True))
    assert tc.counted(documents([]), PATH).collect() == []


def test_random_texts_equal_the_library(monkeypatch):
    rng = random.Random(3)
    pick = lambda: chr(rng.choice([rng.randrange(32, 127), rng.randrange(32, 127), rng.randrange(160, 0x3000), rng.randrange(0x1F300, 0x1F700), 0x558, 0xA7CE, 0x3D000]))
    texts = [" ".join("".join(pick() for _ in range(rng.randrange(1, 9))) for _ in range(rng.randrange(40))) for _ in range(200)]
    texts += ["a" * n for n in range(1, 40)] + ["".join(rng.choice("abcdefgh") for _ in range(8000)), "ab" * 3000, None, ""]
    v = tc.Vocabulary(PATH)
    assert tc.counts(v, pa.array(texts)).tolist() == library(texts)
    monkeypatch.setattr(tc, "RUN", 200)
    monkeypatch.setattr(tc, "SYMBOLS", 30)
    assert tc.counts(v, pa.array(texts)).tolist() == library(texts)


def test_given_texts_equal_the_library(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    true = dict(zip([r.doc_id for r in rows], library([r.text for r in rows]), strict=True))
    assert {r.doc_id: r.n_tokens for r in tc.counted(spark.read.parquet(f"{small}/documents.parquet"), PATH).collect()} == true
