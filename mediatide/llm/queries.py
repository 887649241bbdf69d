"""The queries of this subpackage by name, and their SQL where SQL can express them."""

from __future__ import annotations

from mediatide.llm import (
    bin_packing,
    context_mixing,
    hamming_dedup,
    host_paths,
    language_id,
    lattice_dedup,
    line_dedup,
    line_frequency,
    phrase_mining,
    quality_ordinal,
    source_mixing,
    token_alignment,
    toxicity,
)

QUERIES = {
    "op1_quality_ordinal": quality_ordinal.op1_quality_ordinal,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_context_mixing": context_mixing.op3_context_mixing,
    "op4_bin_packing": bin_packing.op4_bin_packing,
    "op5_source_mixing": source_mixing.op5_source_mixing,
    "op6_line_frequency": line_frequency.op6_line_frequency,
    "op7_lattice_dedup": lattice_dedup.op7_lattice_dedup,
    "op8_toxicity": toxicity.op8_toxicity,
    "op9_minhash_dedup": hamming_dedup.op9_minhash_dedup,
    "op10_language_id": language_id.op10_language_id,
    "op11_host_paths": host_paths.op11_host_paths,
    "op12_token_alignment": token_alignment.op12_token_alignment,
    "op13_phrase_mining": phrase_mining.op13_phrase_mining,
}

SQL = {
    "op2_line_dedup": line_dedup.SQL,
    "op6_line_frequency": line_frequency.SQL,
    "op13_phrase_mining": phrase_mining.SQL,
}
