"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from marketpulse.llm.chat import OP1_SQL, op1_chat_perspectives
from marketpulse.llm.exact_dedup import OP9_SQL, op9_exact_dedup
from marketpulse.llm.fill_in_middle import OP13_SQL, op13_fill_in_middle
from marketpulse.llm.fingerprints import OP2_SQL, op2_fingerprints
from marketpulse.llm.hard_negatives import OP11_SQL, op11_hard_negatives
from marketpulse.llm.language_model import op8_language_model
from marketpulse.llm.line_dedup import op6_fuzzy_lines
from marketpulse.llm.mixing import OP4_SQL, op4_mix_sources
from marketpulse.llm.near_dedup import OP7_SQL, op7_near_dedup
from marketpulse.llm.packing import op10_pack_sequences
from marketpulse.llm.parity_join import OP12_SQL, op12_parity_join
from marketpulse.llm.quality import op5_quality_rules
from marketpulse.llm.token_counts import op3_token_counts

QUERIES = {
    "op1_chat_perspectives": op1_chat_perspectives,
    "op2_fingerprints": op2_fingerprints,
    "op3_token_counts": op3_token_counts,
    "op4_mix_sources": op4_mix_sources,
    "op5_quality_rules": op5_quality_rules,
    "op6_fuzzy_lines": op6_fuzzy_lines,
    "op7_near_dedup": op7_near_dedup,
    "op8_language_model": op8_language_model,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_pack_sequences": op10_pack_sequences,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_parity_join": op12_parity_join,
    "op13_fill_in_middle": op13_fill_in_middle,
}

ORACLE = {
    "op1_chat_perspectives": OP1_SQL,
    "op2_fingerprints": OP2_SQL,
    "op4_mix_sources": OP4_SQL,
    "op7_near_dedup": OP7_SQL,
    "op9_exact_dedup": OP9_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_parity_join": OP12_SQL,
    "op13_fill_in_middle": OP13_SQL,
}
