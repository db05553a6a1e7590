"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from foliospark.llm import bpe, embedding_dedup, language_id, line_dedup, minhash, mixing, nearest, secrets, token_counts, url_filter

QUERIES = {
    "op1_secret_scans": secrets.op1_secret_scans,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_bpe": bpe.op3_bpe,
    "op4_language_id": language_id.op4_language_id,
    "op5_minhash": minhash.op5_minhash,
    "op6_token_counts": token_counts.op6_token_counts,
    "op7_url_filters": url_filter.op7_url_filters,
    "op8_nearest": nearest.op8_nearest,
    "op9_embedding_dedup": embedding_dedup.op9_embedding_dedup,
    "op10_mixing": mixing.op10_mixing,
}

#: Where SQL gives the same rows on whole tables in reasonable time; the others are tested against brute force.
ORACLES = {
    "op1_secret_scans": secrets.OP1_SQL,
    "op2_line_dedup": line_dedup.OP2_SQL,
    "op5_minhash": minhash.OP5_SQL,
    "op7_url_filters": url_filter.OP7_SQL,
    "op8_nearest": nearest.OP8_SQL,
    "op9_embedding_dedup": embedding_dedup.OP9_SQL,
}
