"""Registry of the queries run by the driver and the bench."""

from __future__ import annotations

from . import room, room_files

QUERIES = {
    "keyword_hits": room.q_keyword_hits,
    "raw_details": room.q_raw_details,
    "file_report": room.q_file_report,
    "relevance_distinct": room.q_relevance_distinct,
    "relevance_hits_gt5": room.q_relevance_hits_gt5,
    "keyword_report": room.q_keyword_report,
    "keyword_totals": room.q_keyword_totals,
    "keyword_report_by_name": room.q_keyword_report_by_name,
    "request_files_by_name": room.q_request_files_by_name,
    "unmatched_files": room.q_unmatched_files,
    "skipped_files": room.q_skipped_files,
    "run_summary": room.q_run_summary,
    "request_report": room.q_request_report,
    "request_report_weighted": room.q_request_report_weighted,
    "path_parts": room.q_path_parts,
    "index_numbers": room.q_index_numbers,
    "extension_routing": room.q_extension_routing,
    "extension_census": room.q_extension_census,
    "cell_addresses": room.q_cell_addresses,
    "numeric_cell_filter": room.q_numeric_cell_filter,
    "float_column_drop": room.q_float_column_drop,
    "cell_hits": room.q_cell_hits,
    "workbook_segments": room.q_workbook_segments,
    "category_hits": room.q_category_hits,
    "first_hit_per_category": room.q_first_hit_per_category,
    "first_hit_per_document": room.q_first_hit_per_document,
    "scope_index": room.q_scope_index,
    "prior_index_parse": room.q_prior_index_parse,
    "request_report_any": room.q_request_report_any,
    "dictionary_unpivot": room.q_dictionary_unpivot,
    "dictionary_dedup": room.q_dictionary_dedup,
    "team_dictionary": room.q_team_dictionary,
    "user_keywords": room.q_user_keywords,
    "pages_per_file": room.q_pages_per_file,
    "density_route": room.q_density_route,
    "slide_skip_rule": room.q_slide_skip_rule,
    "special_char_strip": room.q_special_char_strip,
    "null_tokens": room.q_null_tokens,
    "extract_with_errors": room.q_extract_with_errors,
    "page_hits": room.q_page_hits,
    "workbook_document_hits": room.q_workbook_document_hits,
    "slide_hits": room.q_slide_hits,
    "message_hits": room.q_message_hits,
    "paragraph_hits": room.q_paragraph_hits,
    "keyword_files": room.q_keyword_files,
    "request_files": room.q_request_files,
    "keyword_lists": room.q_keyword_lists,
    "request_lists": room.q_request_lists,
    **room_files.QUERIES,
}


def oracle() -> dict[str, str]:
    from .oracle import sql_queries, sql_queries_2
    from .oracle_files import files_sql
    q = {**sql_queries(), **sql_queries_2(), **files_sql()}
    return {k: v for k, v in q.items() if k in QUERIES}
