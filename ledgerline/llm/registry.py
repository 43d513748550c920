"""Queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from ledgerline.llm.op10_hmm_lm import op10_hmm_lm
from ledgerline.llm.op11_conversation_repair import op11_conversation_repair, oracle as _repair_sql
from ledgerline.llm.op12_token_files import op12_token_files
from ledgerline.llm.op13_merkle_manifest import op13_merkle_manifest, oracle as _merkle_sql
from ledgerline.llm.op1_suffix_dedup import op1_suffix_dedup
from ledgerline.llm.op2_decontaminate import op2_decontaminate
from ledgerline.llm.op3_minhash_dedup import op3_minhash_dedup
from ledgerline.llm.op4_url_filter import op4_url_filter
from ledgerline.llm.op5_line_crf import op5_line_crf
from ledgerline.llm.op6_toxicity import op6_toxicity
from ledgerline.llm.op7_quality_rules import op7_quality_rules
from ledgerline.llm.op8_language_id import op8_language_id
from ledgerline.llm.op9_byte_bpe import op9_byte_bpe

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_decontaminate": op2_decontaminate,
    "op3_minhash_dedup": op3_minhash_dedup,
    "op4_url_filter": op4_url_filter,
    "op5_line_crf": op5_line_crf,
    "op6_toxicity": op6_toxicity,
    "op7_quality_rules": op7_quality_rules,
    "op8_language_id": op8_language_id,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_hmm_lm": op10_hmm_lm,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_token_files": op12_token_files,
    "op13_merkle_manifest": op13_merkle_manifest,
}

SQL: dict[str, str] = {"op11_conversation_repair": _repair_sql(), "op13_merkle_manifest": _merkle_sql()}
