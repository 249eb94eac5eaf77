"""Queries of the training-data operators, and their DuckDB SQL."""

from __future__ import annotations

import corpus_pipeline

from . import (
    filteraudit, fingerprints, language, licensescan, mixing, neardup, packing, sharding, tokencount, topk, toxicity,
    urlfilter, vectorcodes,
)

QUERIES = {
    "op1_document_fingerprints": fingerprints.op1_document_fingerprints,
    "op2_language_id": language.op2_language_id,
    "op3_minhash_near_dedup": neardup.op3_minhash_near_dedup,
    "op4_source_mixing": mixing.op4_source_mixing,
    "op5_token_counts": tokencount.op5_token_counts,
    "op6_packing": packing.op6_packing,
    "op7_exact_top_k": topk.op7_exact_top_k,
    "op8_sharding": sharding.op8_sharding,
    "op9_toxicity": toxicity.op9_toxicity,
    "op10_url_filters": urlfilter.op10_url_filters,
    "op11_vector_codes": vectorcodes.op11_vector_codes,
    "op12_filter_audit": filteraudit.op12_filter_audit,
    "op13_license_scan": licensescan.op13_license_scan,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op3_minhash_near_dedup": neardup.OP3_SQL,
    "op4_source_mixing": mixing.OP4_SQL,
    "op7_exact_top_k": topk.OP7_SQL,
    "op8_sharding": sharding.OP8_SQL,
    "op10_url_filters": urlfilter.OP10_SQL,
    "op11_vector_codes": vectorcodes.OP11_SQL,
    "op12_filter_audit": filteraudit.OP12_SQL,
    "op13_license_scan": licensescan.OP13_SQL,
}
