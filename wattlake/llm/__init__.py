"""Operators of a training-data pipeline; queries() and oracle_sql() gather the modules' own."""

from . import hard_negatives, license_scan, line_dedup, lm_scoring, mixing, ngram_join, quality, sentencepiece_codec, sharding, token_alignment, toxicity, vector_dedup, vector_topk

_MODULES = [line_dedup, ngram_join, mixing, sharding, vector_topk, vector_dedup, toxicity, sentencepiece_codec, lm_scoring, quality, license_scan, hard_negatives, token_alignment]


def queries():
    return {k: f for m in _MODULES for k, f in m.QUERIES.items()}


def oracle_sql():
    return {k: s for m in _MODULES for k, s in m.SQL.items()}
