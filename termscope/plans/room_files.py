"""Registered queries over real files: rows of the driver's tables are written
to the checkpoint folder, scanned by the readers, and the sinks are written and
read back. Each entry comes with its DuckDB twin over the same tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.paths import path_id_matches
from ..functions.text import is_nan
from ..operators.match import category_hits, keyword_hits
from ..session import ensure_checkpoint_dir
from ..sinks import writers
from ..sources import testbed as tb
from ..sources.dictionary import extra_dictionary, from_table, unpivot_wide
from ..sources.inventory import last_file, list_files, select_prefix, with_folders
from ..sources.csv_files import CsvFiles
from ..sources.scans import line_segments, read_lines_latin1, read_whole_text
from . import room
from .folder import read_request_sheet, scan_folder

# What the room's files and sinks hold of a text: line feeds stay, other line ends do not occur in it.
DOC_OF = r"doc_id=([0-9]+)"


def _folder(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"


def _doc_id(path: str = "path"):
    return F.regexp_extract(path, DOC_OF, 1).cast("long")


def _text_files(spark: SparkSession, sf_dir: str, own_folder: bool = False) -> str:
    """Every document as a text file of its own (the writer ends it with a line feed)."""
    folder = _folder(spark, "texts")
    writers.write_file_each(tb.read(spark, sf_dir, "documents").select("doc_id", "text"), folder, "doc_id", own_folder=own_folder)
    return folder


def q_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The files of a folder with sizes and path parts."""
    files = list_files(spark, _text_files(spark, sf_dir, own_folder=True), glob="*.txt")
    return files.select(_doc_id().alias("doc_id"), F.col("length").cast("long").alias("length"), "file_type", "index_number",
                        F.regexp_extract("folder", "/(doc_id=[0-9]+)/$", 1).alias("folder"))


def q_whole_text_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S7 from storage: one segment per file."""
    seg = read_whole_text(spark, _text_files(spark, sf_dir))
    return seg.select(_doc_id().alias("doc_id"), "seg_ord", "location", "page_count", "text")


def q_latin1_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S8 from storage: bytes read as ISO-8859-1, by line; the lines' byte lengths."""
    seg = read_lines_latin1(spark, _text_files(spark, sf_dir))
    return seg.select(_doc_id().alias("doc_id"), "seg_ord", F.length("text").cast("long").alias("n_bytes"))


# Rows of a CSV file of the room: a source's rows lie in as many files as they need.
CSV_ROWS = 100_000


def q_csv_cells(spark: SparkSession, sf_dir: str, file_rows: int = CSV_ROWS) -> DataFrame:
    """Each source's documents as CSV files in order (quotes and line feeds in
    cells), scanned by cell; rows are numbered on from file to file."""
    folder = _folder(spark, "csv")
    quoted = F.concat(F.lit('say "'), F.col("lang"), F.lit('", then'))
    docs = tb.read(spark, sf_dir, "documents").select("source", F.col("doc_id").cast("string").alias("id"), quoted.alias("q"), "text", "doc_id")
    (docs.repartitionByRange("source", "doc_id").sortWithinPartitions("source", "doc_id").drop("doc_id").write.partitionBy("source")
         .option("maxRecordsPerFile", file_rows).options(**writers.CSV_OPTIONS).csv(folder))
    files = CsvFiles(spark, folder)
    place = [F.regexp_extract("path", r"/part-([0-9]+)-[^/]*$", 1).cast("int"), F.regexp_extract("path", r"\.c([0-9]+)\.csv$", 1).cast("int")]
    source = F.regexp_extract("path", "source=([^/]+)/", 1)
    before = Window.partitionBy("source").orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    counts = files.row_counts().withColumn("source", source).select("path", "source", F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("before"))
    return files.cells().join(counts, "path").select("source", (F.col("row") + F.col("before")).alias("row"), "col", "value")


def q_folder_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + P13 + S4/S7/U1 + status: a folder of text, CSV and unknown files, matched; per file its status and hits."""
    root = _folder(spark, "room")
    docs = tb.read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    for where, place, fmt, options in (("lang = 'en'", "t", "text", {}), ("lang = 'fr'", "c", "csv", writers.CSV_OPTIONS),
                                       ("lang not in ('en', 'fr')", "u", "json", {})):
        writers.write_file_each(docs.where(where).drop("lang"), f"{root}/{place}", "doc_id", fmt, **options)
    scan = scan_folder(spark, root, glob="part-*")
    hits = keyword_hits(scan.segments, room.room_dictionary(spark), key=room.HIT_KEY, prepared=True)
    per = hits.groupBy("path").agg(F.sum("hits").alias("n"))
    return scan.files.join(per, "path", "left").select(
        _doc_id().alias("doc_id"), "handler", "status", F.coalesce("n", F.lit(0)).cast("long").alias("n_hits"))


def q_prefix_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: object keys under a prefix, folder markers dropped."""
    docs = tb.room_documents(spark, sf_dir)
    marks = tb.read(spark, sf_dir, "documents").select(F.concat(F.lit("room/"), F.col("source"), F.lit("/")).alias("key")).distinct()
    keys = docs.select(F.expr("substring(path, 2, length(path))").alias("key")).unionByName(marks)
    return select_prefix(keys, "room/src1")


def q_stored_dictionary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dictionary of one team."""
    return from_table(tb.team_keywords(spark, sf_dir), "BUILDING")


def q_extra_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second table without numbers, one category of it appended; hits of
    every entry are its own although both tables count from 1."""
    p = tb.read(spark, sf_dir, "part")
    extra = p.select(F.substring_index("p_name", " ", 1).alias("keyword"), F.lit("User_Input").alias("category")).distinct()
    d = extra_dictionary(tb.dict_from_rows(spark, tb.CELL_DICTIONARY), extra)
    names = p.select(F.col("p_partkey").cast("string").alias("path"), F.col("p_name").alias("text"))
    return keyword_hits(names, d, key=("path",)).select("path", "category", "keyword", "hits")


def q_request_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last file of a request folder, columns 2, 6 and 7 in row order."""
    folder = _folder(spark, "requests")
    b = tb.read(spark, sf_dir, "benchmark")
    blank = F.lit("")
    sheet = b.select(blank.alias("a"), F.concat(F.col("item_id"), F.lit(".0")).alias("b"), blank.alias("c"), blank.alias("d"), blank.alias("e"),
                     F.when(F.col("item_id") % 2 == 0, " IT ").otherwise("HR").alias("f"), F.col("text").alias("g"), "item_id")
    for part, rows in (("1 old", sheet.limit(1)), ("2 new", sheet)):
        (rows.coalesce(1).sortWithinPartitions("item_id").drop("item_id").write.options(**writers.CSV_OPTIONS).csv(f"{folder}/{part}"))
    files = list_files(spark, folder, glob="part-*")
    sheet = read_request_sheet(spark, last_file(files).first()["path"])
    return sheet.select("request_no", "area", "sentence", F.col("row_ord").cast("long").alias("row_ord"))


def _written_and_read(spark: SparkSession, name: str, write, read) -> DataFrame:
    folder = _folder(spark, name)
    write(folder)
    return read(folder)


def q_sink_raw_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K1: raw details written by category and read back; Unknown rows keep their ''."""
    raw = room.q_raw_details(spark, sf_dir)
    back = _written_and_read(spark, "raw", lambda p: writers.write_hits(raw, p), spark.read.parquet)
    return back.groupBy("category", "category_part").agg(F.count(F.lit(1)).alias("n_rows"))


def q_sink_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report as parquet and as CSV with a header, read back."""
    report = room.q_file_report(spark, sf_dir)
    columns = ["file_name", "path", "relevant", "keyword_details"]
    a = _written_and_read(spark, "report", lambda p: writers.write_report(report, p), spark.read.parquet)
    b = _written_and_read(spark, "report", lambda p: writers.write_report(report, p, fmt="csv"),
                          lambda p: spark.read.options(header=True, escape='"').csv(p))
    return (a.select(F.lit("parquet").alias("fmt"), *columns)
             .unionByName(b.select(F.lit("csv").alias("fmt"), *[F.coalesce(c, F.lit("")).alias(c) for c in columns])))


def q_sink_quoted_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K8: a sheet exported fully quoted; its lines as text."""
    part = tb.read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand")
    return _written_and_read(spark, "sheet", lambda p: writers.export_quoted_csv(part, p), spark.read.text).select(F.col("value").alias("line"))


def q_sink_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K9: the run summary as JSON, read back."""
    summary = room.q_run_summary(spark, sf_dir)
    back = _written_and_read(spark, "summary", lambda p: writers.write_summary_json(summary, p), spark.read.json)
    return back.select("n_files", "number_of_file_skipped", "total_hits", "message")


def q_nan_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null and NaN values."""
    e = tb.read(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).when(
        F.col("event_id") % 7 == 0, F.lit(None)).otherwise(F.col("value")).alias("v"))
    return e.select("event_id", is_nan("v").alias("is_nan"))


def q_path_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P20: roots whose last folder but one is the user's id."""
    users = tb.room_users(spark, sf_dir)
    root = F.concat(F.lit("s3://b/u/"), F.when(F.col("guid").endswith("3"), "other").otherwise(F.col("guid")), F.lit("/room/"))
    return users.select("guid", path_id_matches(root, F.concat(F.lit("s3://b/u/"), F.col("guid"), F.lit("/req")), F.col("guid")).alias("ok"))


def q_empty_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """no segments, no dictionary entries, and all of both."""
    seg, d = line_segments(tb.read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("path"), "text")), room.room_dictionary(spark)
    none = d.where("false")
    cases = {"no segments": keyword_hits(seg.where("false"), d, prepared=True), "no entries": keyword_hits(seg, none, prepared=True),
             "both": keyword_hits(seg, d, prepared=True)}
    out = None
    for name, hits in cases.items():
        one = hits.agg(F.lit(name).alias("input"), F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum("hits"), F.lit(0)).cast("long").alias("hits"))
        out = one if out is None else out.unionByName(one)
    return out


def q_bookkeeping_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folder rows below a root, one file name left out."""
    files = tb.room_files(spark, sf_dir).select("path", "file_name")
    return with_folders(files, root="/room", exclude_suffix="0.txt").select("path", "entry")


def q_row_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O3: the first rows of a wide sheet only."""
    return unpivot_wide(room._wide_sheet(spark, sf_dir), ["p_name", "p_brand"], max_row=50)


# Unescaped terms whose regex characters stay live (P10b), and terms escaped.
LIVE_TERMS = [("Live", "th.s?"), ("Live", "a[nr]d?"), ("Live", "(?:of|to)"), ("Other", "e.")]


def q_live_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10b unescaped: matches of terms with live metacharacters over every line."""
    hits = category_hits(tb.all_segments(spark, sf_dir), tb.dict_from_rows(spark, LIVE_TERMS))
    return hits.groupBy("category", F.lower("keyword").alias("keyword")).agg(F.sum("hits").cast("long").alias("hits"))


QUERIES = {
    "inventory": q_inventory, "whole_text_files": q_whole_text_files, "latin1_lines": q_latin1_lines, "csv_cells": q_csv_cells,
    "folder_scan": q_folder_scan, "prefix_keys": q_prefix_keys, "stored_dictionary": q_stored_dictionary, "extra_terms": q_extra_terms,
    "request_sheet": q_request_sheet, "sink_raw_hits": q_sink_raw_hits, "sink_reports": q_sink_reports,
    "sink_quoted_csv": q_sink_quoted_csv, "sink_summary": q_sink_summary, "nan_test": q_nan_test, "path_ids": q_path_ids,
    "empty_input": q_empty_input, "bookkeeping_file": q_bookkeeping_file, "row_window": q_row_window, "live_patterns": q_live_patterns,
}
