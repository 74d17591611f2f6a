"""DuckDB twins of the test-room queries (the correctness oracle).

The room mapping of ``sources/testbed.py`` is repeated here in SQL over the
driver's views. Word-bounded matching in RE2 (no lookaround, ASCII ``\\b``):
single-word keywords count equal lower-cased tokens; phrases double every
non-word character of the text and of the keyword so that each match can
consume its own boundary character, one literal branch per phrase.
"""

from __future__ import annotations

import re

from ..sources.testbed import (CELL_DICTIONARY, MIN_EXTRACTABLE_CHARS, MIN_SHAPE_CHARS, TEAMS, TEST_DICTIONARY,
                               TEST_EXTENSIONS, TEST_GUID, TEST_USER_KEYWORDS)

USER_CATEGORY = "User Input"

W = r"\p{L}\p{N}_"


def final_dictionary(with_user: bool = True) -> list[tuple[str, str, int, int]]:
    """(category, keyword, cat_ord, kw_ord) after de-duplication and user terms."""
    seen: set[str] = set()
    rows: list[tuple[str, str, int]] = []
    for i, (c, k) in enumerate(TEST_DICTIONARY):
        if k not in seen:
            seen.add(k)
            rows.append((c, k, i + 1))
    if with_user:
        first = 1 << 60
        terms = [t.strip() for t in TEST_USER_KEYWORDS.split(",")]
        for j, t in enumerate([t for t in terms if t]):
            rows.append((USER_CATEGORY, t, first + j))
    cat_first: dict[str, int] = {}
    for c, _, o in rows:
        cat_first[c] = min(cat_first.get(c, o), o)
    order = {c: i + 1 for i, c in enumerate(sorted(cat_first, key=lambda c: (cat_first[c], c)))}
    return [(c, k, order[c], o) for c, k, o in rows]


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _single(k: str) -> bool:
    return re.fullmatch(r"\w+", k) is not None


def dict_values(with_user: bool = True) -> str:
    rows = ", ".join(f"({_q(c)}, {_q(k)}, {co}, {ko})" for c, k, co, ko in final_dictionary(with_user))
    return f"(VALUES {rows}) AS d(category, keyword, cat_ord, kw_ord)"


ROOM_FILES = f"""
docs AS (
  SELECT doc_id, n_chars, lang, source, doc_id // 20 AS k FROM documents),
named AS (
  SELECT doc_id, n_chars,
    '/room/' || source || '/' ||
    CASE k % 5 WHEN 0 THEN ''
               WHEN 1 THEN CAST(k % 9 + 1 AS VARCHAR) || '.' || CAST(k % 4 AS VARCHAR) || '_'
               WHEN 2 THEN CAST(k % 9 + 1 AS VARCHAR) || '.' || CAST(k % 4 AS VARCHAR) || ' '
               WHEN 3 THEN CAST(k % 9 + 1 AS VARCHAR) || '. '
               ELSE CAST(k % 9 + 1 AS VARCHAR) || '.' || CAST(k % 4 AS VARCHAR) || '.' || CAST(k % 3 AS VARCHAR) || ' ' END
    || CASE WHEN k % 2 = 0 THEN upper(lang) ELSE lang END || ' doc ' || CAST(k AS VARCHAR) || '.' ||
    CASE lang WHEN 'en' THEN 'txt' WHEN 'fr' THEN 'csv' WHEN 'de' THEN 'docx' ELSE 'md' END AS path
  FROM docs),
parts AS (
  SELECT doc_id, n_chars, path, string_split(path, '/')[-1] AS file_name FROM named),
files AS (
  SELECT doc_id, path, file_name,
    substr(path, 1, length(path) - length(file_name)) AS folder,
    string_split(path, '.')[-1] AS file_type,
    CASE WHEN regexp_extract(file_name, '^[0-9.]*', 0) = '.' THEN ' '
         ELSE regexp_extract(file_name, '^[0-9.]*', 0) END AS index_number,
    CASE WHEN suffix(path, '.md') THEN 'unknown'
         WHEN n_chars < {MIN_EXTRACTABLE_CHARS} THEN 'failed' ELSE 'scanned' END AS status
  FROM parts),
all_seg AS (
  SELECT p.path, s.seg_ord, s.text, p.doc_id FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS text,
           generate_subscripts(string_split(text, chr(10)), 1) AS seg_ord
    FROM documents) s
  JOIN parts p ON p.doc_id = s.doc_id),
seg AS (SELECT s.path, s.seg_ord, s.text FROM all_seg s JOIN files f ON f.doc_id = s.doc_id AND f.status = 'scanned')"""


def hits_ctes(with_user: bool = True, seg: str = "seg", key: str = "path, seg_ord",
              text: str = "text", prefix: str = "") -> str:
    """CTEs ``dict``, ``tok``, ``t2`` and ``hits(<key>, category, cat_ord,
    keyword, kw_ord, hits)`` (names carry ``prefix``)."""
    entries = final_dictionary(with_user)
    phrases = [(c, k, co, ko) for c, k, co, ko in entries if not _single(k)]
    branches = []
    for c, k, co, ko in phrases:
        doubled = re.sub(r"([^\w])", r"\1\1", k.lower())
        pat = f"[^{W}]" + re.escape(doubled).replace("\\ ", " ") + f"[^{W}]"
        branches.append(
            f"SELECT {key}, {_q(c)} AS category, {co} AS cat_ord, {_q(k)} AS keyword, {ko} AS kw_ord, "
            f"CAST(len(regexp_extract_all(t2, {_q(pat)})) AS BIGINT) AS hits FROM {prefix}t2")
    phrase_sql = " UNION ALL ".join(branches) if branches else \
        f"SELECT {key}, '' AS category, 0 AS cat_ord, '' AS keyword, 0 AS kw_ord, CAST(0 AS BIGINT) AS hits FROM {prefix}t2 WHERE false"
    p = prefix
    return f"""
{p}dict AS (SELECT * FROM {dict_values(with_user)}),
{p}tok AS (
  SELECT {key}, lower(t) AS tok FROM (
    SELECT {key}, unnest(regexp_split_to_array({text}, '[^{W}]+')) AS t FROM {seg})),
{p}single_hits AS (
  SELECT {', '.join('tok.' + x.strip() for x in key.split(','))}, d.category, d.cat_ord, d.keyword, d.kw_ord,
         CAST(count(*) AS BIGINT) AS hits
  FROM {p}tok tok JOIN {p}dict d ON tok.tok = lower(d.keyword)
  WHERE regexp_full_match(d.keyword, '[{W}]+')
  GROUP BY ALL),
{p}t2 AS (
  SELECT {key}, ' ' || regexp_replace(lower({text}), '([^{W}])', '\\1\\1', 'g') || ' ' AS t2 FROM {seg}),
{p}phrase_hits AS ({phrase_sql}),
{p}hits AS (
  SELECT * FROM {p}single_hits UNION ALL SELECT * FROM {p}phrase_hits WHERE hits > 0)"""


def room_hits_sql(select: str, with_user: bool = True, extra: str = "", seg: str = "seg") -> str:
    ext = f",\n{extra}" if extra else ""
    return f"WITH {ROOM_FILES},{hits_ctes(with_user, seg=seg)}{ext}\n{select}"


REQUESTS = """
reqs AS (
  SELECT CAST(item_id // 2 AS VARCHAR) AS request_no_s, CAST(item_id AS BIGINT) AS row_ord,
         CASE item_id % 3 WHEN 0 THEN 'IT' WHEN 1 THEN ' it' || chr(9) ELSE 'HR' END AS area,
         text AS sentence FROM benchmark),
it AS (
  SELECT TRY_CAST(trunc(TRY_CAST(request_no_s AS DOUBLE)) AS INTEGER) AS request_no, row_ord, sentence FROM reqs
  WHERE lower(trim(area, ' ' || chr(9))) = 'it' AND TRY_CAST(trunc(TRY_CAST(request_no_s AS DOUBLE)) AS INTEGER) IS NOT NULL)"""

ROLL_UP = """
SELECT CAST(it.request_no AS BIGINT) AS request_no, it.row_ord, it.sentence AS request,
       CASE WHEN coalesce(agg.n_rel, 0) > 0 THEN 'Yes' ELSE 'No' END AS relevant_files_found,
       CAST(coalesce(agg.n_rel, 0) AS BIGINT) AS n_relevant_files,
       coalesce(agg.file_names, '') AS file_names, coalesce(agg.index_numbers, '') AS index_numbers,
       coalesce(agg.paths, '') AS paths
FROM it LEFT JOIN (
  SELECT p.row_ord, count(*) AS n_rel,
         string_agg(f.file_name, ', ' ORDER BY f.path) || ', ' AS file_names,
         string_agg(f.index_number, ', ' ORDER BY f.path) || ', ' AS index_numbers,
         string_agg(f.path, ', ' ORDER BY f.path) || ', ' AS paths
  FROM pairs p JOIN files f USING (path) GROUP BY p.row_ord) agg USING (row_ord)"""


def sql_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    q["keyword_hits"] = room_hits_sql(
        "SELECT path, CAST(seg_ord AS BIGINT) AS seg_ord, category, keyword, hits FROM hits", seg="all_seg")
    q["file_report"] = room_hits_sql("""
SELECT f.file_name, f.index_number, f.folder, f.file_type, 'Successful' AS scan_status,
       kw.n_keywords_found, cat.n_keyword_categories, kw.keyword_details, cat.category_details,
       f.path, CASE WHEN kw.n_keywords_found >= 5 THEN 'Yes' ELSE 'No' END AS relevant
FROM kw JOIN cat USING (path) JOIN files f USING (path)
UNION ALL
SELECT file_name, index_number, folder, 'Unknown', 'Unsuccessful', CAST(0 AS BIGINT), CAST(0 AS BIGINT),
       '', '', '', '' FROM files WHERE status = 'unknown'""", extra="""
per_kw AS (SELECT path, keyword, sum(hits) AS n FROM hits GROUP BY ALL),
per_cat AS (SELECT path, category, cat_ord, min(seg_ord) AS first_seg FROM hits GROUP BY ALL),
kw AS (SELECT path, CAST(sum(n) AS BIGINT) AS n_keywords_found, count(*) AS n_distinct,
              string_agg(keyword || '(' || CAST(n AS VARCHAR) || '), ', '' ORDER BY keyword) AS keyword_details
       FROM per_kw GROUP BY path),
cat AS (SELECT path, CAST(count(*) AS BIGINT) AS n_keyword_categories,
               string_agg(category, ', ' ORDER BY first_seg, cat_ord) AS category_details
        FROM per_cat GROUP BY path)""")
    rel = """
per_kw AS (SELECT path, keyword, sum(hits) AS n FROM hits GROUP BY ALL),
kw AS (SELECT path, sum(n) AS total, count(*) AS n_distinct FROM per_kw GROUP BY path)"""
    q["relevance_distinct"] = room_hits_sql(
        "SELECT path, CASE WHEN n_distinct > 5 THEN 'Yes' ELSE 'No' END AS relevant FROM kw", extra=rel)
    q["relevance_hits_gt5"] = room_hits_sql(
        "SELECT path, CASE WHEN total > 5 THEN 'Yes' ELSE 'No' END AS relevant FROM kw", extra=rel)
    q["keyword_report"] = room_hits_sql("""
SELECT keyword, keyword_category, n_files, total_hits, CAST(mx.n AS BIGINT) AS max_hits, max_file_names, max_file_paths,
       all_file_names, index_numbers, paths
FROM pairs JOIN totals USING (keyword) JOIN top USING (keyword) JOIN names USING (keyword)
     JOIN idx USING (keyword) JOIN mx USING (keyword)""", extra="""
per_file AS (SELECT h.keyword, h.path, sum(h.hits) AS n, f.file_name, f.index_number
             FROM hits h JOIN files f USING (path) GROUP BY h.keyword, h.path, f.file_name, f.index_number),
totals AS (SELECT keyword, CAST(count(DISTINCT path) AS BIGINT) AS n_files, CAST(sum(n) AS BIGINT) AS total_hits,
                  string_agg(path, ', ' ORDER BY path) AS paths FROM per_file GROUP BY keyword),
mx AS (SELECT keyword, max(n) AS n FROM per_file GROUP BY keyword),
top AS (SELECT p.keyword, string_agg(p.file_name, ', ' ORDER BY p.file_name, p.path) AS max_file_names,
               string_agg(p.path, ', ' ORDER BY p.file_name, p.path) AS max_file_paths
        FROM per_file p JOIN mx USING (keyword, n) GROUP BY p.keyword),
names AS (SELECT keyword, string_agg(file_name, ', ' ORDER BY p) AS all_file_names FROM (
            SELECT keyword, file_name, min(path) AS p FROM per_file GROUP BY ALL) GROUP BY keyword),
idx AS (SELECT keyword, string_agg(index_number, ', ' ORDER BY p) AS index_numbers FROM (
            SELECT keyword, index_number, min(path) AS p FROM per_file GROUP BY ALL) GROUP BY keyword),
pairs AS (SELECT DISTINCT keyword, category AS keyword_category FROM hits)""")
    for name, counted in (("keyword_totals", "path"), ("keyword_report_by_name", "file_name")):
        q[name] = room_hits_sql(f"""
SELECT p.keyword, p.keyword_category, t.n_files, t.total_hits, t.max_hits
FROM (SELECT DISTINCT keyword, category AS keyword_category FROM hits) p JOIN (
  SELECT keyword, CAST(count(DISTINCT {counted}) AS BIGINT) AS n_files, CAST(sum(n) AS BIGINT) AS total_hits,
         CAST(max(n) AS BIGINT) AS max_hits
  FROM (SELECT h.keyword, h.path, f.file_name, sum(h.hits) AS n FROM hits h JOIN files f USING (path) GROUP BY ALL)
  GROUP BY keyword) t USING (keyword)""")
    q["unmatched_files"] = room_hits_sql(
        "SELECT file_name, path FROM files WHERE status = 'scanned' "
        "AND path NOT IN (SELECT DISTINCT path FROM hits)")
    q["skipped_files"] = f"WITH {ROOM_FILES}\nSELECT file_name, path, status AS reason FROM files " \
                         "WHERE status IN ('unknown', 'failed')"
    q["run_summary"] = room_hits_sql("""
SELECT CAST((SELECT count(*) FROM files) AS BIGINT) AS n_files,
       CAST((SELECT count(*) FROM files WHERE status IN ('unknown', 'failed')) AS BIGINT) AS number_of_file_skipped,
       CAST((SELECT coalesce(sum(hits), 0) FROM hits) AS BIGINT) AS total_hits,
       CASE WHEN (SELECT count(*) FROM reqs WHERE lower(trim(area, ' ' || chr(9))) = 'it'
                  AND TRY_CAST(trunc(TRY_CAST(request_no_s AS DOUBLE)) AS INTEGER) IS NULL) > 0
            THEN '|request list has rows without a valid number' ELSE '' END AS message""", extra=REQUESTS)
    q["request_report"] = room_hits_sql(ROLL_UP, extra=REQUESTS + "," + hits_ctes(
        True, seg="it", key="row_ord", text="sentence", prefix="r_") + """,
req_kw AS (SELECT DISTINCT row_ord, keyword FROM r_hits WHERE keyword IN (SELECT keyword FROM hits)),
file_kw AS (SELECT DISTINCT path, keyword FROM hits),
pairs AS (SELECT fk.path, rk.row_ord FROM file_kw fk JOIN req_kw rk USING (keyword)
          GROUP BY ALL HAVING count(*) >= 5)""")
    q["request_files_by_name"] = room_hits_sql("""
SELECT rk.row_ord, f.path, count(*) AS n_keywords
FROM (SELECT DISTINCT f.file_name, h.keyword FROM hits h JOIN files f USING (path)) fk
JOIN (SELECT DISTINCT row_ord, keyword FROM r_hits) rk USING (keyword)
JOIN (SELECT f.file_name, min(h.path) AS path FROM hits h JOIN files f USING (path) GROUP BY 1) f USING (file_name)
GROUP BY ALL HAVING count(*) >= 5""", extra=REQUESTS + "," + hits_ctes(
        True, seg="it", key="row_ord", text="sentence", prefix="r_"))
    q["request_report_weighted"] = room_hits_sql(ROLL_UP, extra=REQUESTS + """,
per_kw AS (SELECT path, keyword, sum(hits) AS n FROM hits GROUP BY ALL),
rk AS (SELECT DISTINCT it.row_ord, k.keyword FROM it
       JOIN (SELECT DISTINCT keyword FROM per_kw) k ON contains(lower(it.sentence), lower(k.keyword))),
pairs AS (SELECT path, row_ord FROM per_kw JOIN rk USING (keyword)
          GROUP BY ALL HAVING sum(n) >= 5)""")
    q["path_parts"] = f"WITH {ROOM_FILES}\nSELECT path, file_name, folder, file_type, index_number, " \
        "CASE WHEN suffix(path, '.txt') THEN 'txt' WHEN suffix(path, '.csv') THEN 'csv' " \
        "WHEN suffix(path, '.docx') THEN 'docx' ELSE 'unknown' END AS handler, " \
        "CASE WHEN starts_with(path, '/room') THEN substr(path, 6) ELSE path END AS rel_path, " \
        "CASE WHEN starts_with(folder, '/room') THEN substr(folder, 6) ELSE folder END AS rel_folder FROM files"
    return q


# ---- second batch -----------------------------------------------------------

# The oracle's own statement of routing, kinds and numeric text (not the code's).
HANDLERS = [
    ("csv", ".csv"), ("xlsb", ".xlsb"), ("msg", ".msg"), ("txt", ".txt"), ("rtf", ".rtf"), ("docx", ".docx .DOCX"),
    ("doc", ".doc .DOC"), ("odt", ".odt"), ("ppt", ".pptx ppt .PPTX .PPT"),
    ("image", ".PNG .png .JPEG .jpeg .JPG .jpg .gif .pnm .PNM"), ("xlsx", ".xlsx .xlsm .xls .XLS XLSX"),
    ("pdf", ".pdf .PDF"), ("tiff", ".tiff .tif .jfif .bmp")]
KINDS = [
    ("Microsoft Excel", ".xlsx"), ("Microsoft Word", ".doc .docx .DOCX"), ("Text File", ".txt"),
    ("Image", ".jpg .png .bmp .pnm .jfif .jpeg .tiff"), ("Microsoft Powerpoint", ".pptx .ppt"), ("Adobe PDF", ".pdf")]
FLOAT = r"^\s*([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][0-9]+)?\s*$|^\s*([iI][nN][fF]([iI][nN][iI][tT][yY])?|[nN][aA][nN])\s*$"


def _addr(c: str, r: str) -> str:
    c = f"CAST({c} AS INTEGER)"
    return (f"(CASE WHEN {c} <= 26 THEN chr(64 + {c}) "
            f"WHEN {c} <= 702 THEN chr(64 + ({c} - 1) // 26) || chr(65 + ({c} - 1) % 26) "
            f"ELSE chr(65 + ({c} - 703) // 676) || chr(65 + (({c} - 703) // 26) % 26) || chr(65 + ({c} - 703) % 26) END"
            f" || CAST({r} AS VARCHAR))")


def _suffix_case(expr: str, groups, lower: bool = False, default: str = "'unknown'") -> str:
    parts = []
    for name, suffixes in groups:
        conds = " OR ".join(f"suffix({expr}, {_q(s.lower() if lower else s)})" for s in suffixes.split())
        parts.append(f"WHEN {conds} THEN {_q(name)}")
    return "CASE " + " ".join(parts) + f" ELSE {default} END"


ROUTING = """
rp AS (
  SELECT '/room/mixed/' || replace(p_name, ' ', '_') || '_' || CAST(p_partkey AS VARCHAR) || '.' ||
         {exts}[p_partkey % {n} + 1] AS path FROM part)""".format(
    exts="[" + ", ".join(_q(e) for e in TEST_EXTENSIONS) + "]", n=len(TEST_EXTENSIONS))

CELLS = """
cells AS (
  SELECT '/room/sheets/' || p_type || '.xlsx' AS path, p_brand AS sheet,
         CAST(p_partkey + CASE WHEN p_partkey % 7 = 0 THEN 100000 ELSE 0 END + 1 AS INTEGER) AS row, c.col, c.value, c.number
  FROM part, unnest([
    {'col': 1, 'value': p_name, 'number': NULL::DOUBLE},
    {'col': 2, 'value': p_brand, 'number': NULL::DOUBLE},
    {'col': 3, 'value': p_type, 'number': NULL::DOUBLE},
    {'col': 4, 'value': NULL::VARCHAR, 'number': CAST(p_size AS DOUBLE)},
    {'col': 5, 'value': NULL::VARCHAR, 'number': p_retailprice},
    {'col': 6, 'value': CAST(p_size AS VARCHAR), 'number': NULL::DOUBLE},
    {'col': 7, 'value': '#' || CAST(p_partkey AS VARCHAR), 'number': NULL::DOUBLE},
    {'col': 8, 'value': CASE WHEN p_partkey % 3 = 0 THEN '0' END, 'number': NULL::DOUBLE}]) AS t(c))"""


def _category_patterns(rows) -> list[tuple[str, str]]:
    """(category, doubled-text RE2 pattern with the keyword in group 1)."""
    cats: dict[str, list[str]] = {}
    for c, k in rows:
        cats.setdefault(c, []).append(k)
    out = []
    for c, kws in cats.items():
        alts = "|".join(re.escape(re.sub(r"([^\w])", r"\1\1", k)).replace("\\ ", " ") for k in kws)
        out.append((c, f"(?i)[^{W}]({alts})[^{W}]"))
    return out


T2O = f"""
t2o AS (
  SELECT path, seg_ord, ' ' || regexp_replace(text, '([^{W}])', '\\1\\1', 'g') || ' ' AS t2 FROM seg)"""

T2ALL = T2O.replace("FROM seg)", "FROM all_seg)")

WHOLE = f"""
whole AS (
  SELECT p.path, ' ' || regexp_replace(d.text, '([^{W}])', '\\1\\1', 'g') || ' ' AS t2
  FROM documents d JOIN parts p USING (doc_id))"""


def _undouble(x: str) -> str:
    return f"replace({x}, '  ', ' ')"


def _first_hits(src: str, key: str) -> str:
    branches = [f"SELECT {key}, {_q(c)} AS category, {_undouble(f'regexp_extract(t2, {_q(p)}, 1)')} AS first_match "
                f"FROM {src}" for c, p in _category_patterns(TEST_DICTIONARY)]
    return "SELECT * FROM (" + " UNION ALL ".join(branches) + ") WHERE first_match <> ''"


SCOPE = f"""
fh AS ({_first_hits('t2o', 'path, seg_ord')}),
m AS (SELECT path, '[' || string_agg('''' || first_match || '''', ', ' ORDER BY first_match) || ']' AS lst
      FROM (SELECT DISTINCT path, first_match FROM fh) GROUP BY path),
scope AS (
  SELECT k.kind, f.file_name AS title, f.path AS folder_path, 'Scanned' AS reviewed, 'On File System' AS status,
         CASE WHEN k.kind <> 'Unknown' AND m.lst IS NOT NULL THEN 'In Scope' ELSE 'Out of Scope' END AS scope,
         CASE WHEN k.kind <> 'Unknown' AND m.lst IS NOT NULL THEN 'Matches: ' || m.lst ELSE '' END AS notes
  FROM files f LEFT JOIN m USING (path)
  CROSS JOIN LATERAL (SELECT {_suffix_case('f.file_name', KINDS, default="'Unknown'")} AS kind) k
  UNION ALL
  SELECT 'Folder', 'room', '/room', '', '', '', ''
  UNION ALL
  SELECT DISTINCT 'Folder', source, '/room/' || source, '', '', '', '' FROM documents)"""


def sql_queries_2() -> dict[str, str]:
    q: dict[str, str] = {}
    q["raw_details"] = room_hits_sql("""
SELECT file_name, index_number, folder, path, file_type, page_count, keyword, category, location FROM (
  SELECT f.file_name, f.index_number, f.folder, f.path, f.file_type, s.page_count, h.keyword, h.category,
         s.location, unnest(range(h.hits)) AS occ
  FROM hits h JOIN seg2 s USING (path, seg_ord) JOIN files f USING (path))
UNION ALL
SELECT file_name, index_number, folder, path, 'Unknown', '', '', '', '' FROM files WHERE status = 'unknown'""",
        extra="""
seg2 AS (
  SELECT p.path, s.seg_ord, CAST(s.seg_ord AS VARCHAR) AS location, CAST(s.n AS VARCHAR) AS page_count FROM (
    SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS seg_ord,
           len(string_split(text, chr(10))) AS n FROM documents) s JOIN parts p USING (doc_id))""")
    single_case = "(upper({s}) <> lower({s}) AND ({s} = upper({s}) OR {s} = lower({s})))"
    special = "regexp_matches({s}, '[@_!#$%^&*()<>?/|}}{{~:]')"
    keep = "regexp_replace({s}, '[^0-9.\\s]+', '', 'g')"

    def lone(x):
        return f"(CASE WHEN length({x}) = 1 THEN replace({x}, '.', ' ') ELSE {x} END)"
    first, cut = "string_split(file_name, ' ')[1]", "string_split(string_split(file_name, ' ')[1], '_')[1]"
    bad_first = single_case.format(s=first) + " OR " + special.format(s=first)
    bad_cut = single_case.format(s=cut) + " OR " + special.format(s=cut)
    q["index_numbers"] = f"""WITH {ROOM_FILES}
SELECT path, file_name,
  {lone("regexp_extract(file_name, '^[0-9.]*', 0)")} AS idx_latest,
  CASE WHEN {bad_first} THEN ' ' ELSE {lone(keep.format(s=cut))} END AS idx_token_test,
  CASE WHEN {bad_cut} THEN ' ' ELSE {lone(keep.format(s=cut))} END AS idx_cut_then_test,
  {lone(keep.format(s=cut))} AS idx_token_cut,
  {keep.format(s=cut)} AS idx_token_cut_keep_dot,
  {first} AS idx_token
FROM files"""
    q["extension_routing"] = f"""WITH {ROUTING}
SELECT path, string_split(path, '.')[-1] AS file_type,
  {_suffix_case('path', HANDLERS)} AS handler,
  {_suffix_case('lower(path)', HANDLERS, lower=True)} AS handler_any_case,
  {_suffix_case("string_split(path, '/')[-1]", KINDS, default="'Unknown'")} AS kind
FROM rp"""
    q["extension_census"] = f"""WITH {ROUTING}
SELECT string_split(path, '.')[-1] AS file_type, CAST(count(*) AS BIGINT) AS n_files FROM rp GROUP BY 1"""
    col, row = "(p_partkey % 16384 + 1)", "(p_partkey // 16384 + 1)"
    q["cell_addresses"] = f"""
SELECT p_partkey, CAST({col} AS INTEGER) AS col, CAST({row} AS INTEGER) AS row,
       {_addr(col, row)} AS address, p_brand || ': ' || {_addr(col, row)} AS location FROM part"""
    numeric = f"regexp_matches(regexp_replace(value, '[^A-Za-z0-9\\s.]+', '', 'g'), {_q(FLOAT)})"
    q["numeric_cell_filter"] = f"""WITH {CELLS}
SELECT path, sheet, row, col, value, {numeric} AS numeric_looking,
       (length(value) >= 2 AND NOT {numeric}) AS keep
FROM cells WHERE value IS NOT NULL"""
    q["float_column_drop"] = f"""WITH {CELLS},
numcols AS (SELECT path, sheet, col FROM cells GROUP BY ALL HAVING bool_and(value IS NULL AND number IS NOT NULL))
SELECT c.path, c.sheet, c.row, c.col, c.value FROM cells c
WHERE NOT EXISTS (SELECT 1 FROM numcols n WHERE n.path = c.path AND n.sheet = c.sheet AND n.col = c.col)"""
    branches = []
    cats: dict[str, list[str]] = {}
    for c, k in CELL_DICTIONARY:
        cats.setdefault(c, []).append(k)
    for c, kws in cats.items():
        pat = f"(?i)(^|[^{W}])(" + "|".join(re.escape(k) for k in kws) + f")($|[^{W}])"
        branches.append(f"SELECT path, sheet || ': ' || {_addr('col', 'row')} AS location, {_q(c)} AS category, "
                        f"value AS text FROM cells WHERE value IS NOT NULL AND regexp_matches(value, {_q(pat)})")
    q["cell_hits"] = f"WITH {CELLS}\n" + " UNION ALL ".join(branches)
    q["workbook_segments"] = f"""WITH {CELLS},
sheets AS (SELECT path, CAST(count(DISTINCT sheet) AS INTEGER) AS page_count FROM cells GROUP BY path)
SELECT c.path, c.sheet || ': ' || {_addr('c.col', 'c.row')} AS location, s.page_count, c.value AS text
FROM cells c JOIN sheets s USING (path)
WHERE c.value IS NOT NULL AND c.value <> ''"""
    branches = [f"SELECT path, seg_ord, {_q(c)} AS category, "
                f"{_undouble(f'unnest(regexp_extract_all(t2, {_q(p)}, 1))')} AS keyword FROM t2o"
                for c, p in _category_patterns(TEST_DICTIONARY)]
    q["category_hits"] = f"""WITH {ROOM_FILES},{T2ALL}
SELECT path, CAST(seg_ord AS BIGINT) AS seg_ord, category, keyword, CAST(count(*) AS BIGINT) AS hits
FROM ({' UNION ALL '.join(branches)}) WHERE keyword <> '' GROUP BY ALL"""
    q["first_hit_per_category"] = f"""WITH {ROOM_FILES},{T2ALL}
SELECT path, CAST(seg_ord AS BIGINT) AS seg_ord, category, first_match FROM ({_first_hits('t2o', 'path, seg_ord')})"""
    q["first_hit_per_document"] = f"""WITH {ROOM_FILES},{WHOLE}
SELECT path, category, first_match FROM ({_first_hits('whole', 'path')})"""
    q["scope_index"] = f"""WITH {ROOM_FILES},{T2O},{SCOPE}
SELECT *, row_number() OVER (ORDER BY folder_path) AS row_no FROM scope"""
    parsed = f"""SELECT folder_path AS path, title, trim(unnest(regexp_extract_all(notes, '''([^'']*)''', 1))) AS match
FROM scope WHERE notes <> ''"""
    q["prior_index_parse"] = f"WITH {ROOM_FILES},{T2O},{SCOPE}\n{parsed}"
    q["request_report_any"] = f"""WITH {ROOM_FILES},{T2O},{SCOPE},
im AS ({parsed}),
rq AS (SELECT item_id // 2 AS request_no, item_id AS row_ord, text AS sentence FROM benchmark),
pairs AS (SELECT DISTINCT rq.request_no, rq.row_ord, im.path, im.title AS file_name FROM rq JOIN im
          ON contains(lower(rq.sentence), lower(im.match)))
SELECT CAST(request_no AS BIGINT) AS request_no, CAST(row_ord AS BIGINT) AS row_ord, CAST(count(*) AS BIGINT) AS n_files,
       string_agg(file_name, ' ' ORDER BY path) AS file_names FROM pairs GROUP BY request_no, row_ord"""
    uni = " UNION ALL ".join(
        f"SELECT {_q(c)} AS category, CAST({c} AS VARCHAR) AS keyword, "
        f"CAST({i} * 1000000000 + p_partkey + 1 AS BIGINT) AS row_ord FROM part"
        for i, c in enumerate(["p_name", "p_brand", "p_type"]))
    longd = f"SELECT * FROM ({uni}) WHERE keyword IS NOT NULL AND trim(keyword) <> ''"
    q["dictionary_unpivot"] = longd
    q["dictionary_dedup"] = (f"SELECT category, keyword, row_ord FROM ({longd}) "
                             "QUALIFY row_number() OVER (PARTITION BY keyword ORDER BY row_ord) = 1")
    teams = "[" + ", ".join(_q(t) for t in TEAMS) + "]"
    q["team_dictionary"] = f"""
SELECT d.team, d.category, d.keyword, d.row_ord FROM (
  SELECT {teams}[p_size % {len(TEAMS)} + 1] AS team, p_type AS category, p_name AS keyword,
         CAST(p_partkey AS BIGINT) AS row_ord FROM part) d
WHERE d.team IN (SELECT c_mktsegment FROM customer WHERE c_name = {_q(TEST_GUID)})"""
    q["user_keywords"] = """
WITH t AS (
  SELECT item_id, CASE WHEN text IS NULL OR lower(trim(text)) IN ('none', 'nan') THEN []::VARCHAR[]
    ELSE list_filter(list_transform(string_split(text, ','),
                                    lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '') END AS terms
  FROM benchmark)
SELECT item_id, CAST(generate_subscripts(terms, 1) - 1 AS BIGINT) AS pos, unnest(terms) AS keyword FROM t"""
    pages = """
pg AS (
  SELECT '/room/chats/conv ' || CAST(conv_id AS VARCHAR) ||
         CASE WHEN conv_id % 4 = 0 THEN '.doc' ELSE '.pdf' END AS path,
         CAST(turn + 1 AS INTEGER) AS page,
         CASE WHEN turn % 2 = 1 THEN chr(10) || chr(9) || ' \\n' || text || ' ' || chr(10) || chr(10) ELSE text END AS text
  FROM conversations)"""
    q["pages_per_file"] = f"""WITH {pages}
SELECT path, CAST(max(page) AS BIGINT) AS pages, CAST(count(*) AS BIGINT) AS page_rows FROM pg GROUP BY path"""
    ends = "regexp_replace(text, '^[\\s\\x0B\\x1C-\\x1F\\x85\\p{Z}]+|[\\s\\x0B\\x1C-\\x1F\\x85\\p{Z}]+$', '', 'g')"
    clean = f"replace(replace(replace(replace(replace({ends}, ' ', ''), '\\r', ' '), '\\n', ' '), '\\x', ' '), '0c', ' ')"
    q["density_route"] = f"""WITH {pages},
per AS (SELECT path, CAST(sum(length({clean})) AS BIGINT) AS letters,
               CAST(count(*) AS BIGINT) AS pages FROM pg GROUP BY path)
SELECT path, letters, pages,
       CASE WHEN suffix(path, '.doc') OR suffix(path, '.DOC') OR letters >= pages * 150 THEN 'text' ELSE 'ocr' END AS route
FROM per"""
    q["slide_skip_rule"] = f"""
WITH per AS (
  SELECT '/room/decks/conv ' || CAST(conv_id AS VARCHAR) || '.pptx' AS path,
         CAST(count(*) * CASE WHEN conv_id % 3 = 0 THEN 2 ELSE 1 END AS BIGINT) AS shapes,
         CAST(count(*) FILTER (WHERE length(trim(text)) < {MIN_SHAPE_CHARS}) AS BIGINT) AS failed_shapes,
         CAST(max(turn + 1) + CASE WHEN conv_id % 3 = 0 THEN 100 ELSE 0 END AS BIGINT) AS slides
  FROM conversations GROUP BY conv_id)
SELECT path, shapes, failed_shapes, slides, (failed_shapes > 0 AND failed_shapes = shapes) AS skipped,
       (failed_shapes = slides) AS skipped_by_slide_count FROM per"""
    q["special_char_strip"] = """
SELECT page_id, regexp_replace(url, '[^A-Za-z0-9\\s]+', '', 'g') AS stripped,
       regexp_replace(url, '[^A-Za-z0-9\\s.]+', '', 'g') AS stripped_keep_dots FROM pages"""
    nt = "CASE WHEN {c} IS NULL OR CAST({c} AS VARCHAR) IN ('None', 'NaN', 'nan') THEN '' ELSE CAST({c} AS VARCHAR) END"
    q["null_tokens"] = f"""
SELECT d.doc_id, {nt.format(c='l.quality')} AS quality, {nt.format(c='l.toxic')} AS toxic
FROM documents d LEFT JOIN labels l USING (doc_id)"""
    q["extract_with_errors"] = f"""WITH {ROOM_FILES}
SELECT p.path, CAST(s.seg_ord AS BIGINT) AS seg_ord, CAST(s.seg_ord AS VARCHAR) AS location,
       CAST(s.n AS INTEGER) AS page_count, s.line AS text, NULL::VARCHAR AS error
FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS seg_ord,
             len(string_split(text, chr(10))) AS n FROM documents WHERE n_chars >= {MIN_EXTRACTABLE_CHARS}) s
JOIN parts p USING (doc_id)
UNION ALL
SELECT p.path, NULL, NULL, NULL, NULL, 'ValueError: file too short to parse'
FROM documents d JOIN parts p USING (doc_id) WHERE d.n_chars < {MIN_EXTRACTABLE_CHARS}"""
    q["page_hits"] = f"""WITH {pages},
pseg AS (SELECT path, CAST(page AS BIGINT) AS seg_ord, CAST(page AS VARCHAR) AS location,
                CAST(count(*) OVER (PARTITION BY path) AS INTEGER) AS page_count, text FROM pg),{hits_ctes(
        True, seg="pseg", key="path, seg_ord, location, page_count", prefix="p_")}
SELECT path, location, page_count, category, keyword, hits FROM p_hits"""
    cell_first = []
    for c, pat in _category_patterns(CELL_DICTIONARY):
        cell_first.append(f"SELECT path, {_q(c)} AS category, {_undouble(f'regexp_extract(t2, {_q(pat)}, 1)')} "
                          f"AS first_match FROM wdoc")
    q["workbook_document_hits"] = f"""WITH {CELLS},
first_sheet AS (SELECT path, min(CAST(split_part(sheet, '#', 2) AS INTEGER)) AS s FROM cells GROUP BY path),
wdoc AS (
  SELECT c.path, ' ' || regexp_replace(string_agg(coalesce(c.value, CAST(c.number AS VARCHAR)), ' ' ORDER BY c.col, c.row), '([^{W}])', '\\1\\1', 'g') || ' ' AS t2
  FROM cells c JOIN first_sheet f ON c.path = f.path AND CAST(split_part(c.sheet, '#', 2) AS INTEGER) = f.s
  GROUP BY c.path)
SELECT * FROM ({' UNION ALL '.join(cell_first)}) WHERE first_match <> ''"""
    q["slide_hits"] = f"""WITH
sl AS (SELECT '/room/decks/conv ' || CAST(conv_id AS VARCHAR) || '.pptx' AS path, turn + 1 AS slide, text,
              max(turn + 1 + CASE WHEN conv_id % 3 = 0 THEN 100 ELSE 0 END) OVER (PARTITION BY conv_id) AS slides
       FROM conversations),
sseg AS (SELECT path, CAST(slide * 4294967296 + 1 AS BIGINT) AS seg_ord, CAST(slide AS VARCHAR) AS location,
                CAST(slides AS INTEGER) AS page_count, text FROM sl),{hits_ctes(
        True, seg="sseg", key="path, seg_ord, location, page_count", prefix="s_")}
SELECT path, seg_ord, location, page_count, category, keyword, hits FROM s_hits"""
    q["message_hits"] = f"""WITH
msg AS (SELECT '/room/mail/conv ' || CAST(conv_id AS VARCHAR) || ' turn ' || CAST(turn AS VARCHAR) || '.msg' AS path,
               role AS subject, text AS body FROM conversations),
mseg AS (SELECT path, CAST(1 AS BIGINT) AS seg_ord, '1' AS location, 1 AS page_count, body AS text FROM msg
         UNION ALL
         SELECT path, CAST(2 AS BIGINT), '1', 1, subject FROM msg),{hits_ctes(
        True, seg="mseg", key="path, seg_ord, location, page_count", prefix="m_")}
SELECT path, seg_ord, location, page_count, category, keyword, hits FROM m_hits"""
    q["paragraph_hits"] = f"""WITH {ROOM_FILES},
pseg2 AS (SELECT path, CAST(seg_ord AS BIGINT) AS seg_ord, '1' AS location, 1 AS page_count, text FROM all_seg),{hits_ctes(
        True, seg="pseg2", key="path, seg_ord, location, page_count", prefix="g_")}
SELECT path, seg_ord, location, page_count, category, keyword, hits FROM g_hits"""
    q["keyword_files"] = room_hits_sql("""
SELECT p.keyword, p.path, f.file_name, f.index_number, CAST(p.n AS BIGINT) AS hits, p.n = m.mx AS is_max
FROM (SELECT keyword, path, sum(hits) AS n FROM hits GROUP BY ALL) p
JOIN (SELECT keyword, max(n) AS mx FROM (SELECT keyword, path, sum(hits) AS n FROM hits GROUP BY ALL) GROUP BY keyword) m
  USING (keyword)
JOIN files f USING (path)""")
    q["request_files"] = room_hits_sql("""
SELECT rk.row_ord, fk.path, CAST(count(*) AS BIGINT) AS n_keywords
FROM (SELECT DISTINCT path, keyword FROM hits) fk
JOIN (SELECT DISTINCT row_ord, keyword FROM r_hits) rk USING (keyword)
GROUP BY ALL HAVING count(*) >= 5""", extra=REQUESTS + "," + hits_ctes(
        True, seg="it", key="row_ord", text="sentence", prefix="r_"))
    chunks = """
cells AS (SELECT {g}, list, (no - 1) // 100 AS cell, count(*) AS n_values, string_agg(value, ', ' ORDER BY no) AS items
          FROM vals GROUP BY ALL)
SELECT {g}, list, CAST(row_number() OVER (PARTITION BY {g}, list ORDER BY cell) AS INTEGER) AS chunk,
       CAST(n_values AS BIGINT) AS n_values, items FROM cells"""
    q["keyword_lists"] = room_hits_sql("SELECT * FROM chunked", extra="""
per_file AS (SELECT h.keyword, h.path, sum(h.hits) AS n, f.file_name, f.index_number
             FROM hits h JOIN files f USING (path) GROUP BY h.keyword, h.path, f.file_name, f.index_number),
top AS (SELECT * FROM per_file p WHERE n = (SELECT max(n) FROM per_file m WHERE m.keyword = p.keyword)),
fno AS (SELECT path, row_number() OVER (ORDER BY path) AS no, row_number() OVER (ORDER BY file_name, path) AS no2 FROM files),
vals AS (SELECT keyword, 'paths' AS list, no, path AS value FROM per_file JOIN fno USING (path)
         UNION ALL SELECT keyword, 'file_names', no, file_name FROM (SELECT keyword, file_name, min(path) AS path FROM per_file GROUP BY ALL) JOIN fno USING (path)
         UNION ALL SELECT keyword, 'index_numbers', no, index_number FROM (SELECT keyword, index_number, min(path) AS path FROM per_file GROUP BY ALL) JOIN fno USING (path)
         UNION ALL SELECT keyword, 'max_file_names', no2, file_name FROM top JOIN fno USING (path)
         UNION ALL SELECT keyword, 'max_file_paths', no2, path FROM top JOIN fno USING (path)),
chunked AS (WITH """ + chunks.format(g="keyword") + ")")
    q["request_lists"] = room_hits_sql("SELECT * FROM chunked", extra=REQUESTS + "," + hits_ctes(
        True, seg="it", key="row_ord", text="sentence", prefix="r_") + """,
pairs AS (SELECT rk.row_ord, fk.path FROM (SELECT DISTINCT path, keyword FROM hits) fk
          JOIN (SELECT DISTINCT row_ord, keyword FROM r_hits) rk USING (keyword) GROUP BY ALL HAVING count(*) >= 5),
fno AS (SELECT path, file_name, index_number, row_number() OVER (ORDER BY path) AS no FROM files),
vals AS (SELECT CAST(row_ord AS BIGINT) AS row_ord, v.list, no, v.value FROM pairs JOIN fno USING (path),
         unnest([{'list': 'paths', 'value': path}, {'list': 'file_names', 'value': file_name}, {'list': 'index_numbers', 'value': index_number}]) AS t(v)),
chunked AS (WITH """ + chunks.format(g="row_ord") + ")")
    return q
