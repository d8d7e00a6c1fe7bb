"""The queries of this subpackage and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from eventlens.llm import (
    exact_dedup, mixing, periodic_runs, perspectives, piecewise_hash, sentencepiece_codec, simhash, token_attribution,
    token_store, toxicity, url_filter, vector_codes, warc,
)

QUERIES = {
    "op1_token_attribution": token_attribution.op1_token_attribution,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_perspectives": perspectives.op3_perspectives,
    "op4_sentencepiece": sentencepiece_codec.op4_sentencepiece,
    "op5_piecewise_hash": piecewise_hash.op5_piecewise_hash,
    "op6_mixing": mixing.op6_mixing,
    "op7_warc": warc.op7_warc,
    "op8_simhash_near_dedup": simhash.op8_simhash_near_dedup,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_url_filter": url_filter.op10_url_filter,
    "op11_token_store": token_store.op11_token_store,
    "op12_vector_codes": vector_codes.op12_vector_codes,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}

ORACLE = {
    "op3_perspectives": perspectives.ORACLE,
    "op6_mixing": mixing.ORACLE,
    "op7_warc": warc.ORACLE,
    "op9_exact_dedup": exact_dedup.ORACLE,
    "op12_vector_codes": vector_codes.ORACLE,
}
