"""Queries that apply each operator to its whole table, and their SQL."""

from __future__ import annotations

import public_tokenizers

from gristmill.llm import fingerprints, html, language, mixing, neardup, neighbours, packing, passages, resampling, secrets, tokencounts, toxicity, vectorcodes
from gristmill.sources.stores import table

QUERIES = {
    "op1_minhash_near_dedup": lambda spark, d: neardup.components(table(spark, d, "documents"), k=3, similarity=0.85),
    "op2_nearest_neighbours": lambda spark, d: neighbours.nearest(table(spark, d, "embeddings")),
    "op3_fingerprints": lambda spark, d: fingerprints.fingerprints(table(spark, d, "documents")),
    "op4_substring_dedup": lambda spark, d: passages.passages(table(spark, d, "documents")),
    "op5_html_extraction": lambda spark, d: html.extracted(table(spark, d, "pages")),
    "op6_toxicity": lambda spark, d: toxicity.digest(table(spark, d, "documents"), table(spark, d, "labels")),
    "op7_packing": lambda spark, d: packing.packed(table(spark, d, "documents"), public_tokenizers.path("word_bpe_49k.json")),
    "op8_language_id": lambda spark, d: language.predicted(table(spark, d, "documents")),
    "op9_secret_scan": lambda spark, d: secrets.digest(table(spark, d, "documents")),
    "op10_mixing": lambda spark, d: mixing.taken(table(spark, d, "documents")),
    "op11_vector_codes": lambda spark, d: vectorcodes.encoded(table(spark, d, "embeddings")),
    "op12_token_counts": lambda spark, d: tokencounts.counted(table(spark, d, "documents"), public_tokenizers.path("byte_bpe_50k.json")),
    "op13_resampling": lambda spark, d: resampling.resampled(table(spark, d, "documents"), table(spark, d, "benchmark")),
}

ORACLE_SQL = {"op2_nearest_neighbours": neighbours.NEAREST_SQL, "op1_minhash_near_dedup": neardup.COMPONENTS_SQL, "op9_secret_scan": secrets.DIGEST_SQL, "op10_mixing": mixing.TAKEN_SQL, "op11_vector_codes": vectorcodes.ENCODED_SQL, "op13_resampling": resampling.RESAMPLED_SQL}
