"""Registry of the operators' queries and their DuckDB SQL."""

from __future__ import annotations

from bankmart.llm import conversations, decontaminate, hard_negatives, jaccard_join, knn, language, language_model, licenses, mixing, quality_rules, repeats, token_files, url_rules

QUERIES = {
    "op1_token_files": token_files.op1,
    "op2_decontaminate": decontaminate.op2,
    "op3_topk": knn.op3,
    "op5_url_rules": url_rules.op5,
    "op4_language_model": language_model.op4,
    "op6_licenses": licenses.op6,
    "op7_mixing": mixing.op7,
    "op8_jaccard_join": jaccard_join.op8,
    "op9_repeats": repeats.op9,
    "op10_language": language.op10,
    "op11_quality_rules": quality_rules.op11,
    "op12_hard_negatives": hard_negatives.op12,
    "op13_conversations": conversations.op13,
}

ORACLE = {
    "op3_topk": knn.OP3_SQL,
    "op5_url_rules": url_rules.op5_sql(),
    "op11_quality_rules": quality_rules.op11_sql(),
    "op12_hard_negatives": hard_negatives.OP12_SQL,
}
