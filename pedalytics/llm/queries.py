"""Named queries of the subpackage and, where SQL can say it, their DuckDB oracle."""

from __future__ import annotations

from pedalytics.llm import (
    decontamination,
    fingerprints,
    html_extraction,
    minhash_dedup,
    oracle,
    quality,
    sentencepiece,
    simhash_dedup,
    source_divergence,
    substring_dedup,
    suffix_dedup,
    token_counts,
    url_filters,
    vector_codes,
)

QUERIES = {
    f.__name__: f
    for f in (
        substring_dedup.op1_substring_dedup,
        fingerprints.op2_fingerprints,
        sentencepiece.op3_sentencepiece,
        quality.op4_quality_classifier,
        decontamination.op5_decontamination,
        minhash_dedup.op6_minhash_dedup,
        url_filters.op7_url_filters,
        html_extraction.op8_html_extraction,
        token_counts.op9_token_counts,
        suffix_dedup.op10_suffix_dedup,
        vector_codes.op11_vector_codes,
        simhash_dedup.op12_simhash_dedup,
        source_divergence.op13_source_divergence,
    )
}

ORACLE: dict[str, str] = {
    "op1_substring_dedup": oracle.SUBSTRING_DEDUP,
    "op5_decontamination": oracle.DECONTAMINATION,
    "op6_minhash_dedup": oracle.MINHASH_DEDUP,
    "op10_suffix_dedup": oracle.SUFFIX_DEDUP,
    "op11_vector_codes": vector_codes.ORACLE,
    "op13_source_divergence": source_divergence.ORACLE,
}
