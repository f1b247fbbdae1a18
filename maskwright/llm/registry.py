"""Queries of the training-data operators and, where SQL can express them, their DuckDB counterparts."""

from __future__ import annotations

from . import bpe_lexicon, exact_dedup, kd_shards, line_dedup, near_dedup, packing, pii, token_counts, toxicity, vector_dedup

QUERIES = {
    "op1_bpe_transducer": bpe_lexicon.query,
    "op2_odd_sketches": near_dedup.query,
    "op3_content_sort": exact_dedup.query,
    "op4_pii_checksums": pii.query,
    "op5_sum_of_squares_packing": packing.query,
    "op6_string_kernel_toxicity": toxicity.query,
    "op7_nn_descent": vector_dedup.query,
    "op8_viterbi_counts": token_counts.query,
    "op9_line_windows": line_dedup.query,
    "op10_kd_tree_shards": kd_shards.query,
}
ORACLES = {"op2_odd_sketches": near_dedup.ORACLE, "op3_content_sort": exact_dedup.ORACLE, "op7_nn_descent": vector_dedup.ORACLE, "op9_line_windows": line_dedup.ORACLE}
