"""The reports a user asks for (R1-R3, R5-R7, R9) built from ``files`` and
``hits``.

``files``: ``path, file_name, folder, file_type, index_number, status`` with
status ``scanned`` / ``unknown`` (no handler) / ``failed`` (extraction error).
``hits``: ``path, seg_ord, category, cat_ord, keyword, kw_ord, hits`` from
``operators.match.keyword_hits``.

"Walk order" in the reference is the file system's; here files are ordered by
path, so "first appearance" of a file-level value is its smallest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.paths import UNKNOWN, file_name, kind
from ..functions.text import keyword_count_label, yes_no
from ..operators.lists import chunked_lists, ordered_values, render
from ..operators.match import first_hit_per_category
from ..operators.ordering import sequential_row_number

FILE_PARTS = ["file_name", "index_number", "folder", "file_type"]


def raw_details(files: DataFrame, hits: DataFrame, expand: bool = True) -> DataFrame:
    """One row per occurrence (M1b) with file details, pages and location;
    Unknown files appended with blanks (U2). ``hits`` carry ``location`` and
    ``page_count`` from the matcher, so the text is not read again."""
    # The files' rows are hashed, so a task holds neither side's hits sorted.
    h = hits.join(files.select("path", *FILE_PARTS).hint("shuffle_hash"), "path")
    if expand:
        h = h.withColumn("occurrence", F.explode(F.sequence(F.lit(1), F.col("hits").cast("int"))))
    found = h.select("file_name", "index_number", "folder", "path", "file_type",
                     F.col("page_count").cast("string").alias("page_count"), "keyword",
                     "category", "location")
    unknown = files.where(F.col("status") == "unknown").select(
        "file_name", "index_number", "folder", "path", F.lit(UNKNOWN).alias("file_type"),
        F.lit("").alias("page_count"), F.lit("").alias("keyword"), F.lit("").alias("category"),
        F.lit("").alias("location"))
    return found.unionByName(unknown)


def file_keywords(hits: DataFrame) -> DataFrame:
    """One row per file and dictionary entry: hits and first segment. The
    matcher's rows aggregate straight to this, partially before the shuffle."""
    return (hits.groupBy("path", "category", "cat_ord", "keyword")
                .agg(F.sum("hits").alias("n"), F.min("seg_ord").alias("first_seg")))


def file_report(files: DataFrame, hits: DataFrame, threshold: int = 5,
                metric: str = "hits", inclusive: bool = True, sort: bool = False) -> DataFrame:
    """R2 (A1-A5, J3, U2, O1): one row per file with hits, Unknown files
    appended with zeros and ``Unsuccessful``.

    Relevance (A5, A5b, A5c): ``metric`` ``hits`` (total hits) or ``keywords``
    (distinct keywords), compared with ``threshold`` (``>=`` when
    ``inclusive``, else ``>``).

    One aggregate to (file, entry), then one per file that collects its entries
    (no more than the dictionary has); both lists are derived in the row."""
    per = file_keywords(hits).groupBy("path").agg(
        F.sort_array(F.collect_list(F.struct("keyword", "category", "cat_ord", "n", "first_seg"))).alias("_e"))
    # Sorted by keyword, an entry list is cut into runs of one keyword each.
    starts = F.filter(F.sequence(F.lit(0), F.size("_e") - 1),
                      lambda i: (i == 0) | (F.get("_e", i)["keyword"] != F.get("_e", i - 1)["keyword"]))
    counts = F.transform("_starts", lambda i, j: F.struct(
        F.get("_e", i)["keyword"].alias("k"),
        F.aggregate(F.slice("_e", i + 1, F.coalesce(F.get("_starts", j + 1), F.size("_e")) - i),
                    F.lit(0).cast("long"), lambda acc, e: acc + e["n"]).alias("n")))
    categories = F.array_distinct(F.transform(
        F.sort_array(F.transform("_e", lambda e: F.struct(e["first_seg"].alias("s"), e["cat_ord"].alias("o"), e["category"].alias("c")))),
        lambda x: x["c"]))
    total = F.aggregate("_e", F.lit(0).cast("long"), lambda acc, e: acc + e["n"])
    per = per.withColumn("_starts", starts).select("path", counts.alias("_kws"), categories.alias("_cats"), total.alias("n_keywords_found"))
    labels = F.transform("_kws", lambda x: keyword_count_label(x["k"], x["n"]))
    value = F.col("n_keywords_found") if metric == "hits" else F.size("_kws")
    relevant = value >= threshold if inclusive else value > threshold
    found = (per.join(files.select("path", *FILE_PARTS), "path")
             .select(*FILE_PARTS, F.lit("Successful").alias("scan_status"), "n_keywords_found",
                     F.size("_cats").cast("long").alias("n_keyword_categories"),
                     F.array_join(labels, "").alias("keyword_details"),
                     render(F.col("_cats")).alias("category_details"),
                     "path", yes_no(relevant).alias("relevant")))
    unknown = files.where(F.col("status") == "unknown").select(
        "file_name", "index_number", "folder", F.lit(UNKNOWN).alias("file_type"),
        F.lit("Unsuccessful").alias("scan_status"), F.lit(0).cast("long").alias("n_keywords_found"),
        F.lit(0).cast("long").alias("n_keyword_categories"), F.lit("").alias("keyword_details"),
        F.lit("").alias("category_details"), F.lit("").alias("path"), F.lit("").alias("relevant"))
    out = found.unionByName(unknown)
    return out.orderBy("file_name", "folder") if sort else out


def keyword_report(files: DataFrame, hits: DataFrame, by: str = "path", lists: bool = False) -> DataFrame:
    """R3 (A6-A12, W1): one row per distinct (keyword, category) with the
    keyword's totals over all its categories.

    ``by="path"`` counts files by path; ``by="name"`` reproduces the reference,
    which counts distinct file names (same-named files merge).

    By default the columns are numbers only (``n_files, total_hits, max_hits``),
    all from partial aggregates; which files those are is
    :func:`keyword_files`, one row per keyword and file. ``lists=True`` adds the
    spreadsheet's list columns: one value per keyword that names every file, for
    rooms whose lists fit in a cell."""
    # One chain of aggregates, so the hits are matched once: a keyword's categories
    # (no more than the dictionary has) travel with its files' sums.
    per_file = (hits.groupBy("keyword", "category", "path").agg(F.sum("hits").alias("n"))
                    .groupBy("keyword", "path").agg(F.sum("n").alias("n"), F.sort_array(F.collect_set(F.struct("category"))).alias("_c")))
    if by == "name" or lists:
        per_file = per_file.join(files.select("path", "file_name", "index_number"), "path")
    if not lists:
        n_files = F.count(F.lit(1)) if by == "path" else F.countDistinct("file_name")
        return per_file.groupBy("keyword").agg(
            n_files.cast("long").alias("n_files"), F.sum("n").cast("long").alias("total_hits"), F.max("n").cast("long").alias("max_hits"),
            F.array_distinct(F.flatten(F.collect_set("_c"))).alias("_c")).select(
            "keyword", F.explode("_c.category").alias("keyword_category"), "n_files", "total_hits", "max_hits")
    per_kw = per_file.groupBy("keyword").agg(
        F.sum("n").cast("long").alias("total_hits"), F.max("n").alias("_max"),
        F.array_distinct(F.flatten(F.collect_set("_c"))).alias("_c"),
        F.array_sort(F.collect_list(F.struct("path", "file_name", "index_number", "n"))).alias("_f"))
    names = F.array_distinct(F.transform("_f", lambda x: x["file_name"]))
    tops = F.array_sort(F.transform(F.filter("_f", lambda x: x["n"] == F.col("_max")),
                                    lambda x: F.struct(x["file_name"].alias("file_name"), x["path"].alias("path"))))
    n_files = F.size("_f") if by == "path" else F.size(names)
    return (per_kw.select("*", F.explode("_c.category").alias("keyword_category"))
                 .select("keyword", "keyword_category", n_files.cast("long").alias("n_files"), "total_hits",
                         F.col("_max").cast("long").alias("max_hits"),
                         render(F.transform(tops, lambda x: x["file_name"])).alias("max_file_names"),
                         render(F.transform(tops, lambda x: x["path"])).alias("max_file_paths"),
                         render(names).alias("all_file_names"),
                         render(F.array_distinct(F.transform("_f", lambda x: x["index_number"])))
                         .alias("index_numbers"),
                         render(F.transform("_f", lambda x: x["path"])).alias("paths")))


def unmatched_files(files: DataFrame, hits: DataFrame) -> DataFrame:
    """R5 (J7, U3, U4): scanned files with no hit (skipped files excluded), by
    path rather than by name."""
    matched = hits.select("path").distinct()
    return (files.where(F.col("status") == "scanned").join(matched, "path", "left_anti")
                 .select("file_name", "path"))


def skipped_files(files: DataFrame) -> DataFrame:
    """R6 (U6): files with no handler or a failed extraction, with the reason."""
    return (files.where(F.col("status").isin("unknown", "failed"))
                 .select("file_name", "path", F.col("status").alias("reason")))


def run_summary(files: DataFrame, hits: DataFrame | None, warnings: DataFrame | None = None, total_hits: int | None = None) -> DataFrame:
    """R9 (A19, K9): one row with the skip count, totals and the warning
    message (``|`` + each warning, in order). ``total_hits``, observed while the
    hit table was written, saves another pass over ``hits``."""
    f = files.agg(F.count(F.lit(1)).alias("n_files"),
                  F.count(F.when(F.col("status").isin("unknown", "failed"), 1)).alias("number_of_file_skipped"))
    if total_hits is not None:
        row = f.withColumn("total_hits", F.lit(total_hits).cast("long")).withColumn("_k", F.lit(1))
    else:
        h = hits.agg(F.coalesce(F.sum("hits"), F.lit(0)).cast("long").alias("total_hits"))
        row = f.withColumn("_k", F.lit(1)).join(h.withColumn("_k", F.lit(1)), "_k")
    if warnings is None:
        row = row.withColumn("message", F.lit(""))
    else:
        w = warnings.agg(F.coalesce(F.array_join(ordered_values(F.col("ord"), F.concat(F.lit("|"), F.col("warning"))), ""),
                                    F.lit("")).alias("message")).withColumn("_k", F.lit(1))
        row = row.join(w, "_k")
    return row.select(F.col("n_files").cast("long").alias("n_files"),
                      F.col("number_of_file_skipped").cast("long").alias("number_of_file_skipped"),
                      "total_hits", "message")


# Kinds whose text is searched line by line; other files are searched as one text.
LINE_KINDS = ("Microsoft Word", "Text File")


def scope_first_hits(segments: DataFrame, dictionary: DataFrame, documents: DataFrame | None = None) -> DataFrame:
    """R7's matches (M4/M5): the first match of each category in every line of a
    text or word file, and in the whole document of any other; files of no known
    kind are not searched. Returns ``path, first_match``.

    A file's kind is read off its path, in the row. ``documents`` (``path,
    text``): the other files' whole texts, read whole (S7); without it they are
    put together from their segments, the one exchange of text here."""
    if "edge" in segments.columns:  # windows of a file end with a line; edge rows repeat text
        segments = segments.where("edge is null or edge < 0")
    of = kind(file_name("path"))
    lined = of.isin(*LINE_KINDS)
    lines = segments.where(lined).select("path", F.explode(F.split("text", "\n")).alias("text"))
    other = ~lined & (of != UNKNOWN)
    if documents is not None:
        whole = documents.where(other).select("path", "text")
    else:
        # One file's segments, bounded by the file.
        whole = (segments.where(other).groupBy("path").agg(F.array_sort(F.collect_list(F.struct("seg_ord", "text"))).alias("_s"))
                         .select("path", F.array_join(F.transform("_s", lambda x: x["text"]), " ").alias("text")))
    return first_hit_per_category(lines.unionByName(whole), dictionary, key=("path",)).select("path", "first_match")


def scope_index(entries: DataFrame, first_hits: DataFrame) -> DataFrame:
    """R7 (S2, M4/M5, A15, P14): one row per folder and file.

    ``entries``: ``path, file_name, entry`` (``File``/``Folder``) from
    ``sources.inventory.with_folders``; ``first_hits``: ``path, first_match``
    (first match of each category per segment). Files of a known kind are In
    Scope when any match was found, with the unique matches (sorted; the
    reference prints a set in arbitrary order), an apostrophe in a match escaped."""
    matches = first_hits.groupBy("path").agg(F.array_sort(F.collect_set("first_match")).alias("_m"))
    files = entries.where(F.col("entry") == "File").join(matches, "path", "left")
    k = kind(F.col("file_name"))
    in_scope = (k != UNKNOWN) & F.col("_m").isNotNull() & (F.size("_m") > 0)
    notes = F.concat(F.lit("Matches: ["),
                     F.array_join(F.transform("_m", lambda s: F.concat(F.lit("'"), F.regexp_replace(s, r"(['\\])", r"\\$1"), F.lit("'"))), ", "),
                     F.lit("]"))
    file_rows = files.select(
        k.alias("kind"), F.col("file_name").alias("title"), F.col("path").alias("folder_path"),
        F.lit("Scanned").alias("reviewed"), F.lit("On File System").alias("status"),
        F.when(in_scope, F.lit("In Scope")).otherwise(F.lit("Out of Scope")).alias("scope"),
        F.when(in_scope, notes).otherwise(F.lit("")).alias("notes"))
    folder_rows = entries.where(F.col("entry") == "Folder").select(
        F.lit("Folder").alias("kind"), F.col("file_name").alias("title"), F.col("path").alias("folder_path"),
        F.lit("").alias("reviewed"), F.lit("").alias("status"), F.lit("").alias("scope"),
        F.lit("").alias("notes"))
    return file_rows.unionByName(folder_rows)


def keyword_files(files: DataFrame, hits: DataFrame) -> DataFrame:
    """Long form of R3's list columns (A8-A11): one row per keyword and file
    with the file's hits of the keyword and whether it holds the keyword's
    maximum. For rooms where a keyword's rendered file list would be too big
    for one value, this is the table to write; every aggregate in it is
    partial before its shuffle."""
    per_file = (hits.groupBy("keyword", "path").agg(F.sum("hits").alias("n"))
                    .join(files.select("path", "file_name", "index_number"), "path"))
    mx = per_file.groupBy("keyword").agg(F.max("n").alias("_max"))
    return (per_file.join(mx, "keyword")
                    .select("keyword", "path", "file_name", "index_number", F.col("n").cast("long").alias("hits"),
                            (F.col("n") == F.col("_max")).alias("is_max")))


# Files that a chunk of a list spans.
CHUNK_FILES = 10_000


def keyword_lists(files: DataFrame, hits: DataFrame, size: int = CHUNK_FILES) -> DataFrame:
    """R3's list columns (A8-A11, W1) for collections of any size: ``keyword,
    list, chunk, n_values, items``, every list in chunks of at most ``size``
    files. ``paths``, ``file_names`` and ``index_numbers`` (each value once, by
    its first path) follow the paths, ``max_file_names`` and ``max_file_paths``
    (the files with the keyword's largest count) names, then paths. The chunks
    of a list, joined, are the list that ``keyword_report(lists=True)`` renders."""
    per = keyword_files(files, hits)
    by_path = sequential_row_number(files.select("path"), "path", "no")
    by_name = sequential_row_number(files.select("path", F.struct("file_name", "path").alias("_o")), "_o", "no").select("path", "no")

    def of(rows: DataFrame, name: str, value: str) -> DataFrame:
        return rows.select("keyword", F.lit(name).alias("list"), "path", F.col(value).alias("value"))

    def firsts(value: str) -> DataFrame:
        return per.groupBy("keyword", value).agg(F.min("path").alias("path"))

    ordered = of(per, "paths", "path").unionByName(of(firsts("file_name"), "file_names", "file_name")).unionByName(
        of(firsts("index_number"), "index_numbers", "index_number")).join(by_path, "path")
    tops = per.where("is_max")
    top = of(tops, "max_file_names", "file_name").unionByName(of(tops, "max_file_paths", "path")).join(by_name, "path")
    return chunked_lists(ordered.unionByName(top).select("keyword", "list", "no", "value"), ["keyword", "list"], size)
