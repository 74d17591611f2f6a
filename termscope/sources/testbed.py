"""The test room: the driver's tables mapped onto the engine's inputs.

* ``documents`` -> one file per document under ``/room/<source>/``; the name
  carries an index prefix, the language and an extension chosen by language, so
  that some files are routed as Unknown and same-named files sit in different
  folders. Lines are the text segments.
* ``conversations`` -> paged files (page = turn + 1) for density routing.
* ``benchmark`` -> the request list.
* ``part`` / ``supplier`` -> spreadsheet cells and a wide dictionary sheet.
* ``customer`` -> user/team table.

Every mapping is a plain projection of the driver table, so each query's work
grows with the tables. The DuckDB twin of each view is in ``plans/oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import with_path_parts

# The test dictionary (team ``alpha``); category, keyword in
# dictionary order. "que" and "la" sit in two categories on purpose.
TEST_DICTIONARY: list[tuple[str, str]] = [
    ("English", "the"), ("English", "of"), ("English", "and"), ("English", "to"),
    ("English", "in"), ("English", "is"), ("English", "that"), ("English", "for"),
    ("English", "was"), ("English", "on"), ("English", "with"),
    ("French", "la"), ("French", "les"), ("French", "des"), ("French", "que"),
    ("German", "der"), ("German", "die"), ("German", "und"), ("German", "für"),
    ("Spanish", "los"), ("Spanish", "que"), ("Spanish", "la"),
    ("Phrases", "on the"), ("Phrases", "of the"), ("Phrases", "in der"),
    ("Licensing", "license"), ("Licensing", "apache"), ("Licensing", "token"),
    ("Licensing", "MIT License"),
]

# The user's extra terms for a run (comma list, category "User Input").
TEST_USER_KEYWORDS = "the, Apache, , On the"

# For the reports, a file whose text is shorter than this counts as failed; the
# match-mode queries read every document.
MIN_EXTRACTABLE_CHARS = 40


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def room_path(doc_id, source, lang):
    """Path of a document in the test room (see module doc)."""
    k = F.floor(doc_id / 20).cast("long")
    a = (k % 9 + 1).cast("string")
    b = (k % 4).cast("string")
    c = (k % 3).cast("string")
    prefix = (F.when(k % 5 == 0, F.lit(""))
               .when(k % 5 == 1, F.concat(a, F.lit("."), b, F.lit("_")))
               .when(k % 5 == 2, F.concat(a, F.lit("."), b, F.lit(" ")))
               .when(k % 5 == 3, F.concat(a, F.lit(". ")))
               .otherwise(F.concat(a, F.lit("."), b, F.lit("."), c, F.lit(" "))))
    word = F.when(k % 2 == 0, F.upper(lang)).otherwise(lang)
    ext = (F.when(lang == "en", F.lit("txt")).when(lang == "fr", F.lit("csv"))
            .when(lang == "de", F.lit("docx")).otherwise(F.lit("md")))
    name = F.concat(prefix, word, F.lit(" doc "), k.cast("string"), F.lit("."), ext)
    return F.concat(F.lit("/room/"), source, F.lit("/"), name)


def room_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, path, n_chars, handler`` for every document (no text read)."""
    from ..functions.paths import handler
    d = read(spark, sf_dir, "documents")
    return (d.select("doc_id", room_path(F.col("doc_id"), F.col("source"), F.col("lang")).alias("path"),
                     "n_chars")
             .withColumn("handler", handler(F.col("path"))))


def room_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File inventory with path parts, handler route and extraction status.

    ``status``: ``unknown`` (no handler), ``failed`` (extraction error; in the
    room, files shorter than ``MIN_EXTRACTABLE_CHARS``) or ``scanned``. Only
    metadata columns are read, never the text."""
    docs = room_documents(spark, sf_dir)
    status = (F.when(F.col("handler") == "unknown", F.lit("unknown"))
               .when(F.col("n_chars") < MIN_EXTRACTABLE_CHARS, F.lit("failed"))
               .otherwise(F.lit("scanned")))
    return with_path_parts(docs).withColumn("status", status).drop("n_chars")


def _documents(spark: SparkSession, sf_dir: str, keep=None) -> DataFrame:
    """``path, text`` of the documents, spread over the cores: the driver's small
    tables are single files with one row group, which one task would read."""
    d = read(spark, sf_dir, "documents")
    if keep is not None:
        d = d.where(keep)
    d = d.select("doc_id", room_path(F.col("doc_id"), F.col("source"), F.col("lang")).alias("path"), "text")
    want = spark.sparkContext.defaultParallelism
    if d.rdd.getNumPartitions() < want:
        d = d.repartition(want, "doc_id")
    return d.select("path", "text")


def room_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line segments of the scanned files (S8): ``path, seg_ord, location,
    page_count, text``. Unknown and failed files have none (the reports' rule);
    the filter is on metadata and runs before the text is spread."""
    from ..functions.paths import handler
    from .scans import line_segments
    path = room_path(F.col("doc_id"), F.col("source"), F.col("lang"))
    return line_segments(_documents(spark, sf_dir, (handler(path) != "unknown") & (F.col("n_chars") >= MIN_EXTRACTABLE_CHARS)))


def all_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line segments of every document."""
    from .scans import line_segments
    return line_segments(_documents(spark, sf_dir))


def all_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as one segment."""
    from .scans import whole_text_segments
    return whole_text_segments(_documents(spark, sf_dir))


def room_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``path, text`` of the scanned files, each whole."""
    from ..functions.paths import handler
    path = room_path(F.col("doc_id"), F.col("source"), F.col("lang"))
    return _documents(spark, sf_dir, (handler(path) != "unknown") & (F.col("n_chars") >= MIN_EXTRACTABLE_CHARS))


def room_dictionary(spark: SparkSession, with_user: bool = True) -> DataFrame:
    """Team dictionary, de-duplicated by keyword (first wins), plus the user's
    terms, as ``category, keyword, row_ord``."""
    from .dictionary import dedup_keywords, user_keywords
    rows = [(c, k, i + 1) for i, (c, k) in enumerate(TEST_DICTIONARY)]
    d = dedup_keywords(spark.createDataFrame(rows, "category string, keyword string, row_ord long"))
    return d.unionByName(user_keywords(spark, TEST_USER_KEYWORDS)) if with_user else d


def room_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Request sheet rows (S19): ``request_no, area, sentence, row_ord``; two
    rows share each number."""
    b = read(spark, sf_dir, "benchmark")
    area = (F.when(b.item_id % 3 == 0, F.lit("IT")).when(b.item_id % 3 == 1, F.lit(" it\t"))
             .otherwise(F.lit("HR")))
    return b.select(F.floor(F.col("item_id") / 2).cast("string").alias("request_no"), area.alias("area"),
                    F.col("text").alias("sentence"), F.col("item_id").cast("int").alias("row_ord"))


# Extensions given to the routing test paths (includes spellings
# outside the routing list and two dot-less endings).
TEST_EXTENSIONS = ["csv", "xlsb", "msg", "txt", "rtf", "docx", "DOCX", "doc", "DOC", "odt",
                   "pptx", "ppt", "PPTX", "PPT", "PNG", "png", "JPEG", "jpeg", "JPG", "jpg",
                   "gif", "pnm", "PNM", "xlsx", "xlsm", "xls", "XLS", "XLSX", "pdf", "PDF",
                   "tiff", "tif", "jfif", "bmp", "md", "Csv", "Txt", "zip", "appt", "bXLSX"]

# The cell dictionary (category, keyword) used on the part sheets.
CELL_DICTIONARY: list[tuple[str, str]] = [
    ("Colors", "red"), ("Colors", "blue"),
    ("Temperature", "hot"), ("Temperature", "cold"),
    ("Shapes", "ring"), ("Shapes", "rod"), ("Shapes", "plate"),
    ("Things", "widget"), ("Things", "gizmo"), ("Things", "gear"), ("Things", "bolt"), ("Things", "anvil"),
]

# Market segments, used as teams.
TEAMS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

# The run's user in the team-dictionary query.
TEST_GUID = "Customer#000000007"

# For the skip rule, slide text runs shorter than this count as failed shapes.
MIN_SHAPE_CHARS = 25


def routing_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One path per part with an extension from ``TEST_EXTENSIONS``."""
    p = read(spark, sf_dir, "part")
    exts = F.array(*[F.lit(e) for e in TEST_EXTENSIONS])
    ext = F.element_at(exts, (F.col("p_partkey") % len(TEST_EXTENSIONS) + 1).cast("int"))
    path = F.concat(F.lit("/room/mixed/"), F.replace(F.col("p_name"), F.lit(" "), F.lit("_")), F.lit("_"),
                    F.col("p_partkey").cast("string"), F.lit("."), ext)
    return p.select(path.alias("path"))


def room_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbook cells from ``part``: one workbook per part type, one sheet per
    brand, one row per part. Columns: name, brand, type (text), size and price
    (numbers), size as text, ``#`` + key (text that looks numeric), a text "0"
    in every third row; every seventh row lies beyond row 100,000.

    ``path, sheet, sheet_ord, row, col, value, number``: ``value`` is the text
    of a string cell (null for numbers), ``number`` the numeric value."""
    p = read(spark, sf_dir, "part")

    def cell(col, value, number):
        return F.struct(F.lit(col).alias("col"), value.cast("string").alias("value"),
                        number.cast("double").alias("number"))
    none_s, none_d = F.lit(None).cast("string"), F.lit(None).cast("double")
    cells = F.array(cell(1, F.col("p_name"), none_d), cell(2, F.col("p_brand"), none_d),
                    cell(3, F.col("p_type"), none_d), cell(4, none_s, F.col("p_size")),
                    cell(5, none_s, F.col("p_retailprice")), cell(6, F.col("p_size").cast("string"), none_d),
                    cell(7, F.concat(F.lit("#"), F.col("p_partkey").cast("string")), none_d),
                    cell(8, F.when(F.col("p_partkey") % 3 == 0, "0"), none_d))
    return (p.select(F.concat(F.lit("/room/sheets/"), F.col("p_type"), F.lit(".xlsx")).alias("path"),
                     F.col("p_brand").alias("sheet"),
                     F.try_element_at(F.split("p_brand", "#"), F.lit(2)).try_cast("int").alias("sheet_ord"),
                     (F.col("p_partkey") + F.when(F.col("p_partkey") % 7 == 0, 100_000).otherwise(0) + 1).cast("int").alias("row"), F.explode(cells).alias("c"))
             .select("path", "sheet", "sheet_ord", "row", "c.col", "c.value", "c.number"))


def room_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paged files from ``conversations``: one file per conversation (``.doc``
    for every fourth, else ``.pdf``), page = turn + 1; odd turns have white
    space around their text and a literal debris sequence before it."""
    c = read(spark, sf_dir, "conversations")
    ext = F.when(F.col("conv_id") % 4 == 0, F.lit(".doc")).otherwise(F.lit(".pdf"))
    return c.select(F.concat(F.lit("/room/chats/conv "), F.col("conv_id").cast("string"), ext).alias("path"),
                    (F.col("turn") + 1).cast("int").alias("page"),
                    F.when(F.col("turn") % 2 == 1, F.concat(F.lit("\n\t "), F.lit("\\n"), F.col("text"), F.lit(" \n\n")))
                     .otherwise(F.col("text")).alias("text"))


def room_slides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slide decks from ``conversations``: slide = turn + 1, one text run per
    slide; every third deck has a hundred slides more, without text. ``failed``
    (a run shorter than ``MIN_SHAPE_CHARS``) serves the skip rule only."""
    c = read(spark, sf_dir, "conversations")
    slide = (F.col("turn") + 1).cast("int")
    blank = F.struct((slide + 100).alias("slide"), F.lit(None).cast("string").alias("text"))
    one = F.struct(slide.alias("slide"), F.col("text").alias("text"))
    runs = F.when(F.col("conv_id") % 3 == 0, F.array(one, blank)).otherwise(F.array(one))
    return (c.select(F.concat(F.lit("/room/decks/conv "), F.col("conv_id").cast("string"), F.lit(".pptx")).alias("path"),
                     F.explode(runs).alias("r"))
             .select("path", "r.slide", F.lit(1).alias("run_ord"), "r.text",
                     (F.length(F.trim("r.text")) < MIN_SHAPE_CHARS).alias("failed")))


def dict_from_rows(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    """A fixed dictionary as a DataFrame."""
    return spark.createDataFrame([(c, kw, i + 1) for i, (c, kw) in enumerate(rows)],
                                 "category string, keyword string, row_ord long")


def room_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user_details(guid, team)`` from ``customer``."""
    return read(spark, sf_dir, "customer").select(F.col("c_name").alias("guid"), F.col("c_mktsegment").alias("team"))


def team_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored multi-team dictionary from ``part``: team by size, category =
    type, keyword = name, row_ord = key."""
    p = read(spark, sf_dir, "part")
    teams = F.array(*[F.lit(t) for t in TEAMS])
    return p.select(F.element_at(teams, (F.col("p_size") % len(TEAMS) + 1).cast("int")).alias("team"),
                    F.col("p_type").alias("category"), F.col("p_name").alias("keyword"),
                    F.col("p_partkey").cast("long").alias("row_ord"))
