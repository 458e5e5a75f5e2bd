"""A training-data pipeline over ``documents``: five stages, each one operator.

Each stage works on all that the stage before it kept, and is written as Parquet in between. The
first four return the columns of ``documents``, whatever their names; the last returns a row for each packed piece.

Defined cases of all stages: null and empty texts and null ids are rows like others, repeated rows stay
separate but in the second stage, texts of any length are taken whole, and an empty table gives an empty one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gristmill.llm import mixing, neardup, packing, secrets, toxicity
from gristmill.sources.stores import saved, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go; the model learns from those that are labelled.

    Null and empty texts score as the model's bias does; without any label all documents stay.
    """
    return toxicity.cleaned(docs, table(spark, sf_dir, "labels"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: five-word shingles, similarity 0.8.

    It is the one with the smallest id (null last); rows of one id with unlike texts all stay, as do all
    rows with a null or blank text, which have no copies.
    """
    return neardup.deduped(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking secrets are masked in the texts; all documents stay, null texts as null."""
    return secrets.masked(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: the same in every run, null sources last and for themselves."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids placed in windows; a null or empty text has the end token alone."""
    return packing.packed(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_copies),
    ("secret_scan", mask_secrets),
    ("mixing", mix_sources),
    ("packing", pack),
]

#: The toxicity model can't be expressed in SQL; the tests hold run() against plain stages, and the model against plain steps.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
