"""The registered queries of this subpackage and, where SQL can express them, their SQL."""

from __future__ import annotations

from orgloom.llm import chat, decontam, fim, jaccard, language, mixing, negatives, neighbours, pii, quality, shards, substrings, tokens

QUERIES = {
    "op1_decontamination": decontam.op1_decontamination,
    "op2_language_id": language.op2_language_id,
    "op3_chat_format": chat.op3_chat_format,
    "op4_quality_score": quality.op4_quality_score,
    "op5_token_count": tokens.op5_token_count,
    "op6_personal_data": pii.op6_personal_data,
    "op7_jaccard_join": jaccard.op7_jaccard_join,
    "op8_substring_dedup": substrings.op8_substring_dedup,
    "op9_nearest": neighbours.op9_nearest,
    "op10_source_mix": mixing.op10_source_mix,
    "op11_fill_in_middle": fim.op11_fill_in_middle,
    "op12_shards": shards.op12_shards,
    "op13_hard_negatives": negatives.op13_hard_negatives,
}
ORACLES = {
    "op1_decontamination": decontam.ORACLE,
    "op3_chat_format": chat.ORACLE,
    "op10_source_mix": mixing.ORACLE,
    "op11_fill_in_middle": fim.ORACLE,
    "op12_shards": shards.ORACLE,
    "op13_hard_negatives": negatives.ORACLE,
}
