"""One query per operator, over its whole table, and its SQL where SQL can express it."""

from __future__ import annotations

from countloom.llm import (
    chat_format,
    decontaminate,
    exact_dedup,
    hard_negatives,
    line_rules,
    lm,
    merkle,
    pieces,
    quality,
    repeats,
    simhash,
    toxicity,
    warc,
)

QUERIES = {
    "op1_toxicity": toxicity.query,
    "op2_chat_format": chat_format.query,
    "op3_suffix_dedup": repeats.query,
    "op4_simhash": simhash.query,
    "op5_quality": quality.query,
    "op6_decontaminate": decontaminate.query,
    "op7_sentencepiece": pieces.query,
    "op8_warc": warc.query,
    "op9_exact_dedup": exact_dedup.query,
    "op10_lm_score": lm.query,
    "op11_hard_negatives": hard_negatives.query,
    "op12_line_rules": line_rules.query,
    "op13_merkle": merkle.query,
}

SQL = {
    "op2_chat_format": chat_format.SQL,
    "op6_decontaminate": decontaminate.SQL,
    "op8_warc": warc.SQL,
    "op9_exact_dedup": exact_dedup.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
    "op12_line_rules": line_rules.SQL,
    "op13_merkle": merkle.SQL,
}
