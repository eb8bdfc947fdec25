"""The queries of this package: one per operator, over its whole table."""

from __future__ import annotations

from panelcast.llm import (decontam, html_extract, line_dedup, mixing, near_dedup, suffix_dedup, token_align, token_counts,
                           topk_search, toxicity, url_filters, warc, whitening)

QUERIES = {
    "op1_line_dedup": line_dedup.query,
    "op2_url_filters": url_filters.query,
    "op3_decontamination": decontam.query,
    "op4_toxicity": toxicity.query,
    "op5_warc": warc.query,
    "op6_near_dedup": near_dedup.query,
    "op7_html_text": html_extract.query,
    "op8_token_counts": token_counts.query,
    "op9_topk_search": topk_search.query,
    "op10_mixing": mixing.query,
    "op11_suffix_dedup": suffix_dedup.query,
    "op12_whitening": whitening.query,
    "op13_token_alignment": token_align.query,
}

ORACLES = {
    "op1_line_dedup": line_dedup.SQL,
    "op2_url_filters": url_filters.SQL,
    "op3_decontamination": decontam.SQL,
    "op9_topk_search": topk_search.SQL,
    "op10_mixing": mixing.SQL,
}
