"""Per-file page statistics and routing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import letter_count

# Fixed value: letters per page below which a document's text layer is
# considered unusable and the file goes to OCR.
MIN_LETTERS_PER_PAGE = 150

# Old word formats whose text is always used.
ALWAYS_TEXT_SUFFIXES = (".doc", ".DOC")


def pages_per_file(pages: DataFrame) -> DataFrame:
    """Pages (highest page number) and page rows per file."""
    return pages.groupBy("path").agg(F.max("page").cast("long").alias("pages"),
                                     F.count(F.lit(1)).alias("page_rows"))


def density_route(pages: DataFrame, min_letters: int = MIN_LETTERS_PER_PAGE) -> DataFrame:
    """Sum the letters of all pages (after extraction cleanup, P19); a
    file is routed to ``text`` when letters >= min_letters x pages, else to
    ``ocr``. Old word files always use their text."""
    per = pages.groupBy("path").agg(F.sum(letter_count(F.col("text"))).cast("long").alias("letters"),
                                    F.count(F.lit(1)).cast("long").alias("pages"))
    always = None
    for s in ALWAYS_TEXT_SUFFIXES:
        c = F.col("path").endswith(s)
        always = c if always is None else (always | c)
    usable = always | (F.col("letters") >= F.col("pages") * min_letters)
    return per.withColumn("route", F.when(usable, F.lit("text")).otherwise(F.lit("ocr")))


def slide_skip(runs: DataFrame) -> DataFrame:
    """A deck is skipped when all its shapes failed. The reference
    compared the failed count with the slide count (so an empty deck was
    skipped too); both flags are returned."""
    per = runs.groupBy("path").agg(F.count(F.lit(1)).cast("long").alias("shapes"),
                                   F.count(F.when(F.col("failed"), 1)).cast("long").alias("failed_shapes"),
                                   F.max("slide").cast("long").alias("slides"))
    return (per.withColumn("skipped", (F.col("failed_shapes") > 0) & (F.col("failed_shapes") == F.col("shapes")))
               .withColumn("skipped_by_slide_count", F.col("failed_shapes") == F.col("slides")))
