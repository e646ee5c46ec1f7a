"""Queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from tidemark.llm import bitplanes, decontaminate, delta_lloyd, exact_dedup, near_dedup, oracles, packing, prefix_trie, pseudonyms, quality, quotes, secrets, set_join, url_lists

QUERIES = {
    "op1_quote_linking": quotes.op1_quote_linking,
    "op2_setsketch_near_dedup": near_dedup.op2_setsketch_near_dedup,
    "op3_streaming_exact_dedup": exact_dedup.op3_streaming_exact_dedup,
    "op4_bit_planes": bitplanes.op4_bit_planes,
    "op5_feistel_pseudonyms": pseudonyms.op5_feistel_pseudonyms,
    "op6_random_indexing_quality": quality.op6_random_indexing_quality,
    "op7_assignment_secrets": secrets.op7_assignment_secrets,
    "op8_suffix_array_decontamination": decontaminate.op8_suffix_array_decontamination,
    "op9_variable_best_fit": packing.op9_variable_best_fit,
    "op10_temporal_url_lists": url_lists.op10_temporal_url_lists,
    "op11_delta_lloyd": delta_lloyd.op11_delta_lloyd,
    "op12_combination_join": set_join.op12_combination_join,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}

ORACLES = {
    "op1_quote_linking": oracles.OP1,
    "op2_setsketch_near_dedup": oracles.OP2,
    "op3_streaming_exact_dedup": oracles.OP3,
    "op8_suffix_array_decontamination": oracles.OP8,
    "op10_temporal_url_lists": oracles.OP10,
    "op11_delta_lloyd": oracles.OP11,
    "op12_combination_join": oracles.OP12,
    "op13_prefix_trie": oracles.OP13,
}
