"""The queries of the operators in this folder, and their SQL where it can express them."""

from __future__ import annotations

from . import fingerprints, mixing, near_dedup, packing, pii, quality_classifier, quality_rules, separators, substring_dedup, url_filter

QUERIES = {
    "op1_ordinal_quality": quality_classifier.op1_ordinal_quality,
    "op2_semi_markov_pii": pii.op2_semi_markov_pii,
    "op3_separator_scan": separators.op3_separator_scan,
    "op4_harmonic_packing": packing.op4_harmonic_packing,
    "op5_multiset_hash": fingerprints.op5_multiset_hash,
    "op6_circulant_minhash": near_dedup.op6_circulant_minhash,
    "op7_line_frequency": quality_rules.op7_line_frequency,
    "op8_mix_sources": mixing.op8_mix_sources,
    "op9_collinear_chaining": substring_dedup.op9_collinear_chaining,
    "op10_url_filter": url_filter.op10_url_filter,
}

ORACLES = {
    "op6_circulant_minhash": near_dedup.ORACLE,
    "op7_line_frequency": quality_rules.ORACLE,
    "op8_mix_sources": mixing.ORACLE,
    "op10_url_filter": url_filter.ORACLE,
}
