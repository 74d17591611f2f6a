"""The registered queries: each runs one operator or report over the test room
built from the driver's tables (``sources/testbed.py``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.match import keyword_hits, matchable
from ..sources import testbed as tb
from . import reports
from .materialize import materialize

HIT_KEY = ("path", "seg_ord", "location", "page_count")


_PREPARED: dict[tuple[str, bool], DataFrame] = {}


def room_dictionary(spark: SparkSession, with_user: bool = True) -> DataFrame:
    """The room's dictionary (fixed rows), prepared once per session: category
    order, keyword ids, patterns."""
    key = (spark.sparkContext.applicationId, with_user)
    if key not in _PREPARED:
        d = matchable(tb.room_dictionary(spark, with_user))
        _PREPARED[key] = spark.createDataFrame(d.toArrow(), d.schema)
    return _PREPARED[key]


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The room's hits with each segment's location and page count; matching
    shuffles nothing, so each report aggregates straight from the scan."""
    return keyword_hits(tb.room_segments(spark, sf_dir), room_dictionary(spark), key=HIT_KEY, prepared=True)


def q_keyword_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits per line and dictionary entry, over every document."""
    return (keyword_hits(tb.all_segments(spark, sf_dir), room_dictionary(spark), prepared=True)
            .select("path", "seg_ord", "category", "keyword", "hits"))


def q_raw_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per occurrence, Unknown files appended."""
    return reports.raw_details(tb.room_files(spark, sf_dir), _hits(spark, sf_dir))


def q_file_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R2 (A1-A5, U2, J3, O1)."""
    return reports.file_report(tb.room_files(spark, sf_dir), _hits(spark, sf_dir), sort=True)


def q_relevance_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relevant when more than 5 distinct keywords."""
    r = reports.file_report(tb.room_files(spark, sf_dir), _hits(spark, sf_dir),
                            threshold=5, metric="keywords", inclusive=False)
    return r.where(F.col("scan_status") == "Successful").select("path", "relevant")


def q_relevance_hits_gt5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relevant when more than 5 hits."""
    r = reports.file_report(tb.room_files(spark, sf_dir), _hits(spark, sf_dir),
                            threshold=5, metric="hits", inclusive=False)
    return r.where(F.col("scan_status") == "Successful").select("path", "relevant")


def q_keyword_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3 (A6-A12, W1) with its list columns."""
    return reports.keyword_report(tb.room_files(spark, sf_dir), _hits(spark, sf_dir), lists=True)


def q_keyword_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R3 as a run writes it by default: numbers, no lists."""
    return reports.keyword_report(tb.room_files(spark, sf_dir), _hits(spark, sf_dir))


def q_keyword_report_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files counted by name, as the reference does."""
    return reports.keyword_report(tb.room_files(spark, sf_dir), _hits(spark, sf_dir), by="name")


def q_unmatched_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R5 (J7, U3, U4)."""
    return reports.unmatched_files(tb.room_files(spark, sf_dir), _hits(spark, sf_dir))


def q_skipped_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R6 (U6)."""
    return reports.skipped_files(tb.room_files(spark, sf_dir))


def q_run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R9 (A19): skip count, totals, warnings (requests whose number is not an
    integer are quarantined with a warning)."""
    from .requests import quarantined_requests
    reqs = tb.room_requests(spark, sf_dir)
    bad = quarantined_requests(reqs).agg(F.count(F.lit(1)).alias("n"))
    warnings = bad.where("n > 0").select(F.lit(1).alias("ord"),
                                         F.lit("request list has rows without a valid number").alias("warning"))
    return reports.run_summary(tb.room_files(spark, sf_dir), _hits(spark, sf_dir), warnings)


def q_request_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4 (J4, J5, A13, A14, P15)."""
    from .requests import request_report
    return request_report(tb.room_files(spark, sf_dir), _hits(spark, sf_dir), tb.room_requests(spark, sf_dir),
                          room_dictionary(spark), lists=True)


def q_request_files_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords pooled per file name, the name's first path in the pair."""
    from .requests import request_matches
    return request_matches(tb.room_files(spark, sf_dir), _hits(spark, sf_dir), tb.room_requests(spark, sf_dir),
                           room_dictionary(spark), by="name").select(
        F.col("row_ord").cast("long").alias("row_ord"), "path", "n_keywords")


def q_request_report_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4b (A22)."""
    from .requests import request_report_weighted
    return request_report_weighted(tb.room_files(spark, sf_dir), _hits(spark, sf_dir),
                                   tb.room_requests(spark, sf_dir), room_dictionary(spark), lists=True)


def q_path_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path parts, index number, route, paths relative to the run root."""
    from ..functions.paths import strip_root
    return tb.room_files(spark, sf_dir).select("path", "file_name", "folder", "file_type",
                                               "index_number", "handler",
                                               strip_root("path", "/room").alias("rel_path"),
                                               strip_root("folder", "/room").alias("rel_folder"))


# ---- paths, routing, census -------------------------------------------------

def q_index_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4, P4b, P4b', P4c, P4d on every file name."""
    from ..functions.paths import index_number
    f = tb.room_files(spark, sf_dir).select("path", "file_name")
    n = F.col("file_name")
    return f.select("path", "file_name",
                    index_number(n, "latest").alias("idx_latest"),
                    index_number(n, "token_test").alias("idx_token_test"),
                    index_number(n, "cut_then_test").alias("idx_cut_then_test"),
                    index_number(n, "token_cut").alias("idx_token_cut"),
                    index_number(n, "token_cut_keep_dot").alias("idx_token_cut_keep_dot"),
                    index_number(n, "token").alias("idx_token"))


def q_extension_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P13 (case-sensitive list and lower-cased), P3, P14."""
    from ..functions.paths import file_name, file_type, handler, kind
    p = tb.routing_paths(spark, sf_dir)
    return p.select("path", file_type("path").alias("file_type"), handler("path").alias("handler"),
                    handler("path", case_sensitive=False).alias("handler_any_case"),
                    kind(file_name("path")).alias("kind"))


def q_extension_census(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files per extension."""
    from ..functions.paths import file_type
    return (tb.routing_paths(spark, sf_dir).groupBy(file_type("path").alias("file_type"))
              .agg(F.count(F.lit(1)).alias("n_files")))


# ---- cells ------------------------------------------------------------------

def q_cell_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses over the whole column range (1..16384)."""
    from ..functions.cells import cell_address, qualified_location
    p = tb.read(spark, sf_dir, "part")
    col = (F.col("p_partkey") % 16384 + 1).cast("int")
    row = (F.floor(F.col("p_partkey") / 16384) + 1).cast("int")
    return p.select("p_partkey", col.alias("col"), row.alias("row"),
                    cell_address(col, row).alias("address"),
                    qualified_location(F.col("p_brand"), col, row).alias("location"))


def q_numeric_cell_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which string cells are matched."""
    from ..functions.text import numeric_looking, text_cell_keep
    c = tb.room_cells(spark, sf_dir).where(F.col("value").isNotNull())
    return c.select("path", "sheet", "row", "col", "value",
                    numeric_looking("value").alias("numeric_looking"),
                    text_cell_keep("value").alias("keep"))


def q_float_column_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """drop the columns of a sheet whose cells are all numbers."""
    c = tb.room_cells(spark, sf_dir)
    numeric_cols = (c.groupBy("path", "sheet", "col")
                     .agg(F.bool_and(F.col("value").isNull() & F.col("number").isNotNull()).alias("all_num"))
                     .where("all_num"))
    return c.join(numeric_cols, ["path", "sheet", "col"], "left_anti").select("path", "sheet", "row", "col", "value")


def q_cell_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 (S5, P7): string cells holding a term of a category."""
    from ..operators.match import cell_hits
    from ..sources.scans import cell_segments
    seg = cell_segments(tb.room_cells(spark, sf_dir))
    d = tb.dict_from_rows(spark, tb.CELL_DICTIONARY)
    return (cell_hits(seg, d, key=("path", "seg_ord", "location"))
            .select("path", "location", "category", "text"))


def q_workbook_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cell segments with ``Sheet: A1`` locations and sheet counts."""
    from ..sources.scans import workbook_segments
    return workbook_segments(tb.room_cells(spark, sf_dir), skip_falsy=True).select(
        "path", "location", "page_count", "text")


# ---- other match modes ------------------------------------------------------

def q_category_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-category alternation, matches as written."""
    from ..operators.match import category_hits
    d = tb.dict_from_rows(spark, tb.TEST_DICTIONARY)
    return (category_hits(tb.all_segments(spark, sf_dir), d)
            .select("path", "seg_ord", "category", "keyword", F.col("hits").cast("long").alias("hits")))


def q_first_hit_per_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4: first match of each category per line."""
    from ..operators.match import first_hit_per_category
    d = tb.dict_from_rows(spark, tb.TEST_DICTIONARY)
    return first_hit_per_category(tb.all_segments(spark, sf_dir), d).select(
        "path", "seg_ord", "category", "first_match")


def q_first_hit_per_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5: first match of each category per document (whole text)."""
    from ..operators.match import first_hit_per_category
    d = tb.dict_from_rows(spark, tb.TEST_DICTIONARY)
    return first_hit_per_category(tb.all_texts(spark, sf_dir), d, key=("path",)).select(
        "path", "category", "first_match")


def _scope_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..sources.inventory import with_folders
    files = tb.room_files(spark, sf_dir).select("path", "file_name")
    # A document's lines are searched as one text with blanks for line feeds, as its segments would be.
    whole = tb.room_texts(spark, sf_dir).select("path", F.translate("text", "\n", " ").alias("text"))
    first = reports.scope_first_hits(tb.room_segments(spark, sf_dir), tb.dict_from_rows(spark, tb.TEST_DICTIONARY), whole)
    return reports.scope_index(with_folders(files), first)


def q_scope_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R7 (S2, M4, A15, P14, W3): with the running row number over entries."""
    from ..operators.ordering import sequential_row_number
    return sequential_row_number(_scope_index(spark, sf_dir), "folder_path", "row_no")


def q_prior_index_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scope index's notes parsed back into terms."""
    from .requests import parse_prior_index
    idx = _scope_index(spark, sf_dir).where(F.col("notes") != "")
    return parse_prior_index(idx).select(F.col("folder_path").alias("path"), "title", "match")


def q_request_report_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """R4c (A23, M6): requests against the scope index's match lists."""
    from .requests import parse_prior_index, request_report_any
    idx = materialize(_scope_index(spark, sf_dir).where(F.col("notes") != ""))
    matches = parse_prior_index(idx).select(F.col("folder_path").alias("path"),
                                            F.col("title").alias("file_name"), "match")
    return request_report_any(tb.room_requests(spark, sf_dir), matches)


# ---- dictionaries -----------------------------------------------------------

def _wide_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = tb.read(spark, sf_dir, "part")
    return p.select((F.col("p_partkey") + 1).cast("long").alias("row"), "p_name", "p_brand", "p_type")


def q_dictionary_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide sheet (one column per category) to a long dictionary."""
    from ..sources.dictionary import unpivot_wide
    return unpivot_wide(_wide_sheet(spark, sf_dir), ["p_name", "p_brand", "p_type"])


def q_dictionary_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First category wins per keyword."""
    from ..sources.dictionary import dedup_keywords, unpivot_wide
    return dedup_keywords(unpivot_wide(_wide_sheet(spark, sf_dir), ["p_name", "p_brand", "p_type"]))


def q_team_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The run user's team, then that team's dictionary."""
    from ..sources.dictionary import team_dictionary
    return team_dictionary(tb.room_users(spark, sf_dir), tb.team_keywords(spark, sf_dir), tb.TEST_GUID)


def q_user_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each request text read as a comma list of user terms."""
    from ..sources.dictionary import user_keywords_column
    b = tb.read(spark, sf_dir, "benchmark")
    return (b.select("item_id", F.posexplode(user_keywords_column(F.col("text"))).alias("pos", "keyword"))
             .select("item_id", F.col("pos").cast("long").alias("pos"), "keyword"))


# ---- pages, density, slides -------------------------------------------------

def q_pages_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages per file and page segments' page_count."""
    from ..operators.density import pages_per_file
    return pages_per_file(tb.room_pages(spark, sf_dir))


def q_density_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text layer or OCR per paged file."""
    from ..operators.density import density_route
    return density_route(tb.room_pages(spark, sf_dir))


def q_slide_skip_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A20."""
    from ..operators.density import slide_skip
    return slide_skip(tb.room_slides(spark, sf_dir))


# ---- scalar helpers ---------------------------------------------------------

def q_special_char_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P9 on page URLs (with and without dots kept)."""
    from ..functions.text import strip_special
    p = tb.read(spark, sf_dir, "pages")
    return p.select("page_id", strip_special("url").alias("stripped"),
                    strip_special("url", keep_dots=True).alias("stripped_keep_dots"))


def q_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null spellings to '' over documents left-joined to labels."""
    from ..functions.text import null_token
    d = tb.read(spark, sf_dir, "documents").select("doc_id")
    lab = tb.read(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id", "left")
    return j.select("doc_id", null_token(F.col("quality").cast("string")).alias("quality"),
                    null_token(F.col("toxic").cast("string")).alias("toxic"))


# ---- extractor hook ---------------------------------------------------------

def _line_extractor(path, body):
    """Test-room extractor: lines of a text body; bodies shorter than the
    room's minimum raise, as a corrupt file would."""
    if body is None or len(body) < tb.MIN_EXTRACTABLE_CHARS:
        raise ValueError("file too short to parse")
    lines = body.split("\n")
    return [(i + 1, str(i + 1), len(lines), line) for i, line in enumerate(lines)]


def q_extract_with_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-file Python extraction; failures become error rows."""
    from ..operators.extract import extract
    files = tb.all_texts(spark, sf_dir).select("path", F.col("text").alias("content"))
    return extract(files, _line_extractor).select("path", "seg_ord", "location", "page_count", "text", "error")


def _segment_hits(spark: SparkSession, seg: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    from ..sources.scans import with_page_count
    key = ("path", "seg_ord", "location") if counts is not None else HIT_KEY
    h = keyword_hits(seg, room_dictionary(spark), key=key, prepared=True)
    h = h if counts is None else with_page_count(h, counts)
    return h.select("path", "seg_ord", "location", "page_count", "category", "keyword", "hits")


def q_page_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S9 + M1: keyword hits per page; the page count joins the hits."""
    from ..sources.scans import page_counts, page_texts
    pages = tb.room_pages(spark, sf_dir)
    return _segment_hits(spark, page_texts(pages), page_counts(pages)).drop("seg_ord")


def q_workbook_document_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S5b + M5: the first sheet of each workbook, numbers too, as one
    column-major text, first match of each category in it."""
    from ..operators.match import first_hit_per_category
    from ..sources.scans import workbook_as_document
    doc = workbook_as_document(tb.room_cells(spark, sf_dir))
    d = tb.dict_from_rows(spark, tb.CELL_DICTIONARY)
    return first_hit_per_category(doc, d, key=("path",)).select("path", "category", "first_match")


def q_slide_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S10 + M1: hits per slide text run; slides without text count as slides."""
    from ..sources.scans import slide_counts, slide_texts
    runs = tb.room_slides(spark, sf_dir)
    return _segment_hits(spark, slide_texts(runs), slide_counts(runs))


def q_message_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S12 + M1: every turn is a mail (subject = role, body = text), two segments each."""
    from ..sources.scans import message_segments
    c = tb.read(spark, sf_dir, "conversations")
    msgs = c.select(F.format_string("/room/mail/conv %d turn %d.msg", F.col("conv_id"), F.col("turn")).alias("path"),
                    F.col("text").alias("body"), F.col("role").alias("subject"))
    return _segment_hits(spark, message_segments(msgs))


def q_paragraph_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S11 + M1: every document as a word file, scanned by paragraph."""
    from ..sources.scans import paragraph_segments
    docs = tb.all_texts(spark, sf_dir).select("path", F.split("text", "\n").alias("paragraphs"))
    return _segment_hits(spark, paragraph_segments(docs))


def q_keyword_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A8-A11 long form: one row per keyword and file (no per-keyword list)."""
    return reports.keyword_files(tb.room_files(spark, sf_dir), _hits(spark, sf_dir))


def q_request_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J4/A13 long form: one row per relevant (request, file) pair."""
    from .requests import request_matches
    return (request_matches(tb.room_files(spark, sf_dir), _hits(spark, sf_dir), tb.room_requests(spark, sf_dir),
                            room_dictionary(spark))
            .select(F.col("row_ord").cast("long").alias("row_ord"), "path", "n_keywords"))


# Files of a chunk in the room's list queries.
LIST_FILES = 100


def q_keyword_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list columns of R3 in chunks."""
    return reports.keyword_lists(tb.room_files(spark, sf_dir), materialize(_hits(spark, sf_dir), "hits"), LIST_FILES)


def q_request_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list columns of R4 in chunks."""
    from .requests import request_lists, request_matches
    files = tb.room_files(spark, sf_dir)
    pairs = request_matches(files, _hits(spark, sf_dir), tb.room_requests(spark, sf_dir), room_dictionary(spark))
    return request_lists(files, pairs, LIST_FILES).withColumn("row_ord", F.col("row_ord").cast("long"))
