"""The named queries of this subpackage and their SQL where SQL can express them."""

from __future__ import annotations

from wordloom.llm import chat, decontamination, exact_dedup, hard_negatives, html_text, line_runs, merkle, mixing, ngram_join, quality, secrets, substrings, url_filters

QUERIES = {
    "op1_chat_formatting": chat.query,
    "op2_mixing": mixing.query,
    "op3_line_dedup": line_runs.query,
    "op4_url_filters": url_filters.query,
    "op5_html_extraction": html_text.query,
    "op6_decontamination": decontamination.query,
    "op7_quality_rules": quality.query,
    "op8_ngram_join": ngram_join.query,
    "op9_substring_dedup": substrings.query,
    "op10_secret_scan": secrets.query,
    "op11_hard_negatives": hard_negatives.query,
    "op12_merkle_manifest": merkle.query,
    "op13_exact_dedup": exact_dedup.query,
}

SQL = {
    "op1_chat_formatting": chat.SQL,
    "op3_line_dedup": line_runs.SQL,
    "op4_url_filters": url_filters.SQL,
    "op6_decontamination": decontamination.SQL,
    "op7_quality_rules": quality.SQL,
    "op8_ngram_join": ngram_join.SQL,
    "op9_substring_dedup": substrings.SQL,
    "op11_hard_negatives": hard_negatives.SQL,
    "op12_merkle_manifest": merkle.SQL,
    "op13_exact_dedup": exact_dedup.SQL,
}
