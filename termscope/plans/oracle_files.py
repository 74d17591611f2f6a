"""DuckDB twins of ``room_files``."""

from __future__ import annotations

from .oracle import ROOM_FILES, W, hits_ctes, sql_queries, sql_queries_2


def files_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["inventory"] = """
SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS length, 'txt' AS file_type, '' AS index_number,
       'doc_id=' || CAST(doc_id AS VARCHAR) AS folder FROM documents"""
    q["whole_text_files"] = """
SELECT doc_id, CAST(1 AS BIGINT) AS seg_ord, '1' AS location, 1 AS page_count, coalesce(text, '') || chr(10) AS text FROM documents"""
    q["latin1_lines"] = """
SELECT doc_id, CAST(generate_subscripts(l, 1) AS BIGINT) AS seg_ord, CAST(strlen(unnest(l)) AS BIGINT) AS n_bytes
FROM (SELECT doc_id, string_split(text || chr(10), chr(10)) AS l FROM documents)"""
    q["csv_cells"] = """
SELECT source, row, c.col, c.value FROM (
  SELECT source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS row, doc_id, lang, text FROM documents) d,
unnest([{'col': 1, 'value': CAST(doc_id AS VARCHAR)}, {'col': 2, 'value': 'say "' || lang || '", then'},
        {'col': 3, 'value': text}]) AS t(c)"""
    q["folder_scan"] = f"""WITH whole AS (SELECT doc_id, lang, text FROM documents WHERE lang IN ('en', 'fr')),{hits_ctes(
        True, seg="whole", key="doc_id")}
SELECT d.doc_id, CASE d.lang WHEN 'en' THEN 'txt' WHEN 'fr' THEN 'csv' ELSE 'unknown' END AS handler,
       CASE WHEN d.lang IN ('en', 'fr') THEN 'scanned' ELSE 'unknown' END AS status, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hits
FROM documents d LEFT JOIN (SELECT doc_id, sum(hits) AS n FROM hits GROUP BY 1) h USING (doc_id)"""
    q["prefix_keys"] = f"WITH {ROOM_FILES}\nSELECT substr(path, 2) AS key FROM named WHERE starts_with(path, '/room/src1')"
    q["stored_dictionary"] = """
SELECT p_type AS category, p_name AS keyword, CAST(p_partkey AS BIGINT) AS row_ord FROM part WHERE p_size % 5 = 1"""
    cells = ("red Colors, blue Colors, hot Temperature, cold Temperature, ring Shapes, rod Shapes, plate Shapes, "
             "widget Things, gizmo Things, gear Things, bolt Things, anvil Things")
    values = ", ".join("('{1}', '{0}')".format(*x.split()) for x in cells.split(", "))
    q["extra_terms"] = f"""
WITH d AS (SELECT * FROM (VALUES {values}) AS t(category, keyword)
           UNION ALL SELECT DISTINCT 'User_Input', string_split(p_name, ' ')[1] FROM part),
tok AS (SELECT CAST(p_partkey AS VARCHAR) AS path, unnest(regexp_split_to_array(lower(p_name), '[^{W}]+')) AS tok FROM part)
SELECT path, category, keyword, CAST(count(*) AS BIGINT) AS hits FROM tok JOIN d ON tok = lower(keyword) GROUP BY ALL"""
    q["request_sheet"] = """
SELECT CAST(item_id AS VARCHAR) || '.0' AS request_no, CASE item_id % 2 WHEN 0 THEN ' IT ' ELSE 'HR' END AS area,
       coalesce(text, '') AS sentence, row_number() OVER (ORDER BY item_id) AS row_ord FROM benchmark"""
    q["sink_raw_hits"] = f"""
SELECT category, CASE WHEN category = '' THEN '(none)' ELSE category END AS category_part, CAST(count(*) AS BIGINT) AS n_rows
FROM ({sql_queries_2()["raw_details"]}) GROUP BY 1, 2"""
    report = sql_queries()["file_report"]
    q["sink_reports"] = f"""
SELECT f.fmt, r.file_name, r.path, r.relevant, r.keyword_details FROM ({report}) r, (VALUES ('parquet'), ('csv')) AS f(fmt)"""
    q["sink_quoted_csv"] = """
SELECT '"' || CAST(p_partkey AS VARCHAR) || '","' || p_name || '","' || p_brand || '"' AS line FROM part"""
    q["sink_summary"] = sql_queries()["run_summary"]
    q["nan_test"] = """
SELECT event_id, (event_id % 5 = 0 OR event_id % 7 = 0 OR value IS NULL OR isnan(value)) AS is_nan FROM events"""
    q["path_ids"] = "SELECT c_name AS guid, NOT suffix(c_name, '3') AS ok FROM customer"
    q["empty_input"] = f"""WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS text, generate_subscripts(string_split(text, chr(10)), 1) AS seg_ord
  FROM documents),{hits_ctes(True, seg="lines", key="doc_id, seg_ord")}
SELECT * FROM (VALUES ('no segments', CAST(0 AS BIGINT), CAST(0 AS BIGINT)), ('no entries', 0, 0)) AS t(input, n_rows, hits)
UNION ALL SELECT 'both', CAST(count(*) AS BIGINT), CAST(coalesce(sum(hits), 0) AS BIGINT) FROM hits"""
    q["bookkeeping_file"] = f"""WITH {ROOM_FILES}, kept AS (SELECT path FROM files WHERE NOT suffix(path, '0.txt'))
SELECT path, 'File' AS entry FROM kept
UNION ALL SELECT DISTINCT regexp_extract(path, '^(/room/[^/]+)/', 1), 'Folder' FROM kept"""
    q["row_window"] = """
SELECT 'p_name' AS category, p_name AS keyword, CAST(p_partkey + 1 AS BIGINT) AS row_ord FROM part WHERE p_partkey + 1 <= 50
UNION ALL SELECT 'p_brand', p_brand, CAST(1000000000 + p_partkey + 1 AS BIGINT) FROM part WHERE p_partkey + 1 <= 50"""
    # A doubled mark at both ends of every word run; a bound of a match takes one of the two.
    word, other = r"[\p{L}\p{N}_]", r"[^\p{L}\p{N}_\x01\x02]"
    live = (rf"(?i)\x01th(?:{word}s?\x02|\x02\x02{other}(?:\x01\x01s\x02|\x01))|\x01a[nr]d?\x02|\x01(?:of|to)\x02")
    more = rf"(?i)\x01e(?:{word}\x02|\x02\x02{other}\x01)"
    q["live_patterns"] = f"""
WITH lines AS (SELECT unnest(string_split(text, chr(10))) AS t FROM documents),
marked AS (SELECT regexp_replace(t, '({word}+)', chr(1) || chr(1) || '\\1' || chr(2) || chr(2), 'g') AS t FROM lines),
found AS (SELECT 'Live' AS category, unnest(regexp_extract_all(t, '{live}')) AS m FROM marked
          UNION ALL SELECT 'Other', unnest(regexp_extract_all(t, '{more}')) FROM marked)
SELECT category, lower(replace(replace(m, chr(1), ''), chr(2), '')) AS keyword, CAST(count(*) AS BIGINT) AS hits FROM found GROUP BY 1, 2"""
    return q
