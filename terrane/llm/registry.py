"""Queries and oracle SQL of this subpackage; ``__spark_entry__`` adds them if it can import them."""

from __future__ import annotations

from terrane.llm import exact_dedup, language_id, line_dedup, mixing, near_dedup, quality_rules, secret_scan, sentencepiece_codec, source_divergence, spelling_variants, substring_dedup, suffix_dedup, token_counts

QUERIES = {
    "op1_sentencepiece": sentencepiece_codec.op1,
    "op2_exact_dedup": exact_dedup.op2,
    "op3_near_dedup": near_dedup.op3,
    "op4_secret_scan": secret_scan.op4,
    "op5_language_id": language_id.op5,
    "op6_line_dedup": line_dedup.op6,
    "op7_suffix_dedup": suffix_dedup.op7,
    "op8_mix_sources": mixing.op8,
    "op9_substring_dedup": substring_dedup.op9,
    "op10_quality_rules": quality_rules.op10,
    "op11_spelling_variants": spelling_variants.op11,
    "op12_source_divergence": source_divergence.op12,
    "op13_token_counts": token_counts.op13,
    "language_of_pages": language_id.language_of_pages,
    "quality_counts": quality_rules.quality_counts,
}
ORACLE_SQL = {
    "op2_exact_dedup": exact_dedup.SQL,
    "op4_secret_scan": secret_scan.SQL,
    "op6_line_dedup": line_dedup.SQL,
    "op7_suffix_dedup": suffix_dedup.SQL,
    "op8_mix_sources": mixing.SQL,
    "op9_substring_dedup": substring_dedup.SQL,
    "op12_source_divergence": source_divergence.SQL,
    "quality_counts": quality_rules.SQL,
}
