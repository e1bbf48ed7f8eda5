"""The queries of this subpackage, and their DuckDB SQL where there is one."""

from __future__ import annotations

from . import decontamination, divergence, licenses, line_dedup, mixing, odd_sketch, pii, quality, simhash, suffix_dedup, token_counts, toxicity, turns

QUERIES = {
    "op1_suffix_dedup": suffix_dedup.query,
    "op2_mixing": mixing.query,
    "op3_simhash": simhash.query,
    "op4_line_dedup": line_dedup.query,
    "op5_quality_rules": quality.query,
    "op6_pii": pii.query,
    "op7_decontamination": decontamination.query,
    "op8_license_scan": licenses.query,
    "op9_token_counts": token_counts.query,
    "op10_toxicity": toxicity.query,
    "op11_divergence": divergence.query,
    "op12_odd_sketch": odd_sketch.query,
    "op13_turns": turns.query,
}

ORACLES = {"op4_line_dedup": line_dedup.SQL, "op5_quality_rules": quality.SQL, "op11_divergence": divergence.SQL, "op12_odd_sketch": odd_sketch.SQL, "op13_turns": turns.SQL}
