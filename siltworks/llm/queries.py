"""Queries of this folder and, where SQL can state them, their oracles."""

from __future__ import annotations

from siltworks.llm.p10_truncated import p10_cut_rates, p10_found
from siltworks.llm.p1_tokens import P1_PIECES_SQL, p1_piece_budget, p1_token_budget, p1_token_counts
from siltworks.llm.p2_spam import p2_found
from siltworks.llm.p3_cutoffs import P3_CUTOFFS_SQL, p3_cutoffs
from siltworks.llm.p4_template import p4_found, p4_main_content
from siltworks.llm.p5_quality import p5_found, p5_page_statistics
from siltworks.llm.p6_repeated import P6_CLEAN_SQL, P6_FOUND_SQL, p6_clean_pages, p6_found, p6_line_excess
from siltworks.llm.p7_batches import p7_found, p7_record_classes
from siltworks.llm.p8_encode import p8_ids
from siltworks.llm.p9_leaks import p9_found, p9_leak_report

QUERIES = {
    "p1_token_counts": p1_token_counts,
    "p1_token_budget": p1_token_budget,
    "p1_piece_budget": p1_piece_budget,
    "p2_found": p2_found,
    "p3_cutoffs": p3_cutoffs,
    "p4_found": p4_found,
    "p4_main_content": p4_main_content,
    "p5_found": p5_found,
    "p5_page_statistics": p5_page_statistics,
    "p6_found": p6_found,
    "p6_clean_pages": p6_clean_pages,
    "p6_line_excess": p6_line_excess,
    "p7_found": p7_found,
    "p7_record_classes": p7_record_classes,
    "p8_ids": p8_ids,
    "p9_found": p9_found,
    "p9_leak_report": p9_leak_report,
    "p10_found": p10_found,
    "p10_cut_rates": p10_cut_rates,
}

ORACLES = {
    "p1_piece_budget": P1_PIECES_SQL,
    "p3_cutoffs": P3_CUTOFFS_SQL,
    "p6_found": P6_FOUND_SQL,
    "p6_clean_pages": P6_CLEAN_SQL,
}
