"""Queries of this subpackage and their SQL."""

from __future__ import annotations

from boxwright.llm import op1_scoring, op2_records, op3_packing, op4_chat, op5_pii, op6_outliers, op7_chosen_path, op8_suffixes, op9_recompression, op10_decontaminate, oracles

QUERIES = {
    "op1_masked_pseudo_likelihood": op1_scoring.query,
    "op2_binary_records": op2_records.query,
    "op3_curve_packing": op3_packing.query,
    "op4_prefix_targets": op4_chat.query,
    "op5_weak_supervision_pii": op5_pii.query,
    "op6_robust_outliers": op6_outliers.query,
    "op7_chosen_path_join": op7_chosen_path.query,
    "op8_suffix_radix_dedup": op8_suffixes.query,
    "op9_recompression_dedup": op9_recompression.query,
    "op10_automaton_decontamination": op10_decontaminate.query,
}
ORACLES = {
    "op4_prefix_targets": op4_chat.ORACLE,
    "op8_suffix_radix_dedup": oracles.BYTE_REPEATS,
    "op9_recompression_dedup": oracles.WORD_REPEATS,
    "op10_automaton_decontamination": oracles.DECONTAMINATION,
}
