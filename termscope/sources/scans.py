"""Turning files into text segments.

Every scan produces the same ``segments`` schema::

    path STRING, seg_ord BIGINT, location STRING, page_count INT, text STRING

``seg_ord`` orders the segments of a file (it drives "first appearance"
orderings in the reports); ``location`` is what the reports print (line, page,
slide, ``A1`` or ``Sheet: A1``).

Plain text and CSV are read with Spark's own readers. Formats that need a
parser library (word, slides, workbooks, mail, PDF) enter through the extractor
hook (``operators.extract``) as ``cells`` or ``pages`` tables, and the helpers
here shape those tables into segments.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.cells import cell_address, qualified_location
from ..functions.paths import plain_path
from ..operators.extract import COLUMN_BITS
from .csv_files import csv_cells  # noqa: F401
from .inventory import few_tasks
from .walk import bodies, walked

SEGMENT_COLS = ["path", "seg_ord", "location", "page_count", "text"]


def line_segments(df: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """One segment per line; location = line number, page_count = lines."""
    lines = df.select(F.col(path).alias("path"), F.split(F.col(text), "\n").alias("_lines"))
    return (lines.select("path", F.size("_lines").cast("int").alias("page_count"),
                         F.posexplode("_lines").alias("_pos", "text"))
                 .select("path", (F.col("_pos") + 1).cast("long").alias("seg_ord"),
                         (F.col("_pos") + 1).cast("string").alias("location"),
                         "page_count", "text"))


def whole_text_segments(df: DataFrame, path: str = "path", text: str = "text") -> DataFrame:
    """One segment per file, location 1, one page."""
    return df.select(F.col(path).alias("path"), F.lit(1).cast("long").alias("seg_ord"),
                     F.lit("1").alias("location"), F.lit(1).alias("page_count"),
                     F.col(text).alias("text"))


def _bodies_table(files: DataFrame, decoded: bool = False) -> DataFrame | None:
    """``sources.walk.bodies`` as a written table: the tasks read the files in
    Python, what is made of them is Spark's alone."""
    from ..plans.materialize import materialize
    df = bodies(files, decoded)
    return None if df is None else materialize(df, "bodies", compression="zstd")


def read_whole_text(spark: SparkSession, root: str, glob: str = "*.txt") -> DataFrame:
    """S7 from storage: ``text`` files read whole, by the tasks that see the
    folder, else by Spark's reader (path from file metadata)."""
    found = walked(spark, root, glob)
    df = _bodies_table(found[0], decoded=True) if found else None
    if df is None:
        df = few_tasks(spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(root, wholetext=True)
                       .select(plain_path(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("content")))
    return whole_text_segments(df.select("path", F.regexp_replace(F.col("content").cast("string"), "\r\n?", "\n").alias("text")))


def read_lines_latin1(spark: SparkSession, root: str, glob: str = "*.txt") -> DataFrame:
    """S8 from storage: bytes decoded as ISO-8859-1, one segment per line.

    The reference deletes its input afterwards; this does not."""
    found = walked(spark, root, glob)
    raw = _bodies_table(found[0]) if found else few_tasks(
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
             .select(plain_path(F.col("_metadata.file_path")).alias("path"), "content"))
    return line_segments(raw.select("path", F.decode("content", "ISO-8859-1").alias("text")))


# A file's bytes are one value of a row: Spark's own bound for such a value.
MAX_FILE_BYTES = (1 << 31) - 16


def read_binary(spark: SparkSession, root: str, glob: str | None = None, max_bytes: int = MAX_FILE_BYTES, *,
                files: DataFrame | None = None) -> DataFrame:
    """Files with their bytes, for parsers that need a whole file (the extractor
    hook): ``path, content``. The length filter is pushed to the listing, so a
    larger file is not opened (``scan_folder`` reports it as failed). Text and
    CSV files are read in chunks instead and may have any size. ``files``: those
    to be read, from ``sources.walk.walked``."""
    if files is not None:
        return bodies(files.where(F.col("length") <= max_bytes))
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).where(F.col("length") <= max_bytes).select(
        plain_path(F.col("_metadata.file_path")).alias("path"), "content")


def csv_cell_segments(cells: DataFrame) -> DataFrame:
    """S4 -> segments: location ``A1``, one page."""
    return cells.select(
        "path",
        (F.shiftleft(F.col("row").cast("long"), COLUMN_BITS) + F.col("col")).alias("seg_ord"),
        cell_address(F.col("col"), F.col("row")).alias("location"),
        F.lit(1).alias("page_count"),
        F.col("value").alias("text"))


# Bits of a workbook cell's segment number: rows reach 2**20, columns 2**14.
ROW_BITS, COL_BITS = 24, 16


def cell_segments(cells: DataFrame, skip_falsy: bool = False) -> DataFrame:
    """S5/S6 without the sheet count: one segment per string cell (F1; numeric
    cells carry a null ``value``). ``skip_falsy`` (S6, binary workbooks) also
    drops '' cells; a text "0" is true in Python and stays (F2)."""
    c = cells.where(F.col("value").isNotNull())
    if skip_falsy:
        c = c.where(F.col("value") != "")
    return c.select(
        "path",
        (F.shiftleft(F.col("sheet_ord").cast("long"), ROW_BITS + COL_BITS)
         + F.shiftleft(F.col("row").cast("long"), COL_BITS) + F.col("col")).alias("seg_ord"),
        qualified_location(F.col("sheet"), F.col("col"), F.col("row")).alias("location"),
        F.col("value").alias("text"))


def sheet_counts(cells: DataFrame) -> DataFrame:
    return cells.groupBy("path").agg(F.countDistinct("sheet").cast("int").alias("page_count"))


def with_page_count(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """Add a file's ``page_count`` to rows of its hits (join it to hits, which
    are few, rather than to the text)."""
    return rows.join(counts.select("path", "page_count"), "path")


def workbook_segments(cells: DataFrame, skip_falsy: bool = False) -> DataFrame:
    """``cells(path, sheet, sheet_ord, row, col, value, number)`` ->
    segments with location ``Sheet: A1`` and page_count = sheets in the file."""
    return with_page_count(cell_segments(cells, skip_falsy), sheet_counts(cells)).select(*SEGMENT_COLS)


def workbook_as_document(cells: DataFrame, first_sheet_only: bool = True) -> DataFrame:
    """All cells of the first sheet, column-major, as one text."""
    c = cells
    if first_sheet_only:
        first = cells.groupBy("path").agg(F.min("sheet_ord").alias("sheet_ord"))
        c = cells.join(first, ["path", "sheet_ord"])
    value = F.coalesce(F.col("value"), F.col("number").cast("string"))
    agg = c.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("col", "row", value.alias("v")))).alias("_c"))
    return whole_text_segments(agg.select("path", F.array_join(F.transform("_c", lambda s: s["v"]), " ")
                                          .alias("text")))


def page_counts(pages: DataFrame) -> DataFrame:
    return pages.groupBy("path").agg(F.count(F.lit(1)).cast("int").alias("page_count"))


def page_texts(pages: DataFrame) -> DataFrame:
    """``pages(path, page, text)`` -> one segment per page; the page count
    joins the hits (``with_page_count(hits, page_counts(pages))``)."""
    return pages.select("path", F.col("page").cast("long").alias("seg_ord"),
                        F.col("page").cast("string").alias("location"), "text")


def slide_counts(runs: DataFrame) -> DataFrame:
    """Slides of a deck, those without readable text included."""
    return runs.groupBy("path").agg(F.max("slide").cast("int").alias("page_count"))


def slide_texts(runs: DataFrame) -> DataFrame:
    """``runs(path, slide, run_ord, text)`` -> one segment per text run,
    location = slide number; a run without text (a failed or empty shape) has
    none. ``slide_counts`` of all runs joins the hits."""
    return (runs.where(F.col("text").isNotNull())
                .select("path", (F.shiftleft(F.col("slide").cast("long"), 32) + F.col("run_ord")).alias("seg_ord"),
                        F.col("slide").cast("string").alias("location"), "text"))


def paragraph_segments(docs: DataFrame, path: str = "path", paragraphs: str = "paragraphs") -> DataFrame:
    """An array of paragraphs per file -> one segment per paragraph,
    location 1 and one page (as the deployed word handler reports)."""
    return (docs.select(F.col(path).alias("path"), F.posexplode(paragraphs).alias("_pos", "text"))
                .select("path", (F.col("_pos") + 1).cast("long").alias("seg_ord"),
                        F.lit("1").alias("location"), F.lit(1).alias("page_count"), "text"))


def message_segments(msgs: DataFrame) -> DataFrame:
    """``msgs(path, body, subject)`` -> two segments, both location 1."""
    return (msgs.select("path", F.posexplode(F.array("body", "subject")).alias("_pos", "text"))
                .select("path", (F.col("_pos") + 1).cast("long").alias("seg_ord"),
                        F.lit("1").alias("location"), F.lit(1).alias("page_count"), "text"))
