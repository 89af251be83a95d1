"""Queries of the training-data operators: ``name -> (builder, oracle SQL or None)``."""

from __future__ import annotations

from canopy.llm import (
    chat, decontaminate, htmltext, lexical, line_dedup, ngram_join, packing, pii, quality, sharding, suffix_dedup, toxicity,
    whitening,
)

QUERIES = {
    "op1_decontaminate": (decontaminate.query, decontaminate.ORACLE_SQL),
    "op2_toxicity": (toxicity.query, None),
    "op3_sharding": (sharding.query, sharding.ORACLE_SQL),
    "op4_pii": (pii.query, None),
    "op5_html_text": (htmltext.query, None),
    "op6_quality_rules": (quality.query, quality.ORACLE_SQL),
    "op7_suffix_dedup": (suffix_dedup.query, None),
    "op8_line_dedup": (line_dedup.query, None),
    "op9_ngram_join": (ngram_join.query, None),
    "op10_packing": (packing.query, None),
    "op11_whitening": (whitening.query, None),
    "op12_chat_format": (chat.query, chat.ORACLE_SQL),
    "op13_lexical_search": (lexical.query, lexical.ORACLE_SQL),
}
