"""Registered queries of the numbered operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from ledgerline.llm import (
    alignment,
    chunks,
    collocations,
    embeddings,
    language,
    licenses,
    mixing,
    ngrams,
    packing,
    quality,
    sentencepieces,
    simhash,
    toxicity,
)

QUERIES: dict[str, Callable] = {
    "op1_lm_scoring": ngrams.query,
    "op2_simhash_near_dedup": simhash.query,
    "op3_best_fit_packing": packing.query,
    "op4_license_scan": licenses.query,
    "op5_embedding_near_dedup": embeddings.query,
    "op6_toxicity": toxicity.query,
    "op7_language_id": language.query,
    "op8_quality_classifier": quality.query,
    "op9_document_fingerprints": chunks.query,
    "op10_mixing": mixing.query,
    "op11_sentencepiece_codec": sentencepieces.query,
    "op12_tokenizer_alignment": alignment.query,
    "op13_phrase_collocations": collocations.query,
}

#: SQL counterparts; the other operators are tested against brute force in ``tests/llm``.
ORACLE_SQL: dict[str, str] = {"op10_mixing": mixing.oracle(), "op13_phrase_collocations": collocations.oracle()}
