"""Operator 5: line de-duplication by overlapping three-line windows.

Every three consecutive lines of a text form a window, known by the MD5 of the
three lines. Over all documents, a window's first occurrence (by document id,
then position) stays; every later one, in the same document too, covers its
three lines. The covered positions of a document are merged, and those lines go.
Windows are judged on the input, not on what is left.

Windows leave the texts as (hash, document, position) rows. A window's first
place and number are a partial aggregate, so a window that a third of all
documents hold leaves each task as one row; only repeated windows meet the rows
again, in a join over as many salts as the window has rows per ``SALT_ROWS``,
and the text is shuffled once, to meet the positions to remove.

Cases: a null text stays null; texts of fewer than three lines have no window
and stay; empty lines are lines; a null id sorts before all others; rows that
share an id are told apart by the MD5 of their text (and take that order); of
rows equal in id and text one counts as the first, and in the others every
window is a later one; an empty table gives an empty result; other columns are
kept, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import packed, written

WINDOW = 3
SALT_ROWS = 20_000  # rows of one window that a task joins, on average


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def window_hashes(lines: Column, size: int = WINDOW) -> Column:
    """(hash, pos) of every window of an array of lines; lines hold no line feed, so joining is unambiguous."""
    starts = F.sequence(F.lit(1), F.size(lines) - (size - 1))
    return F.when(F.size(lines) >= size, F.transform(starts, lambda i: F.struct(
        F.unhex(F.md5(F.array_join(F.slice(lines, i, size), "\n").cast("binary"))).alias("hash"), (i - 1).alias("pos"))))


def later_windows(df: DataFrame, id_col: str, text_col: str, size: int = WINDOW) -> DataFrame:
    """``id``, ``digest`` and ``starts``: per document, where windows start that occurred before."""
    lined = df.filter(F.col(text_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.unhex(F.md5(F.col(text_col).cast("binary"))).alias("digest"),
        split_lines(F.col(text_col)).alias("lines"))
    wins = written(lined.select("id", "digest", F.explode(window_hashes(F.col("lines"), size)).alias("w"))
                        .select("id", "digest", "w.hash", "w.pos").distinct(), "windows")
    place = F.struct("id", "digest", "pos")
    first = written(wins.groupBy("hash").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1"), "firsts")
    salts = F.ceil(F.col("n") / F.lit(float(SALT_ROWS))).cast("int")
    # Windows of few rows have the salt 0 alone. The others are few; as a table of
    # its own their size is known to the planner, which broadcasts it where it is small.
    hot = written(first.filter(salts > 1).select("hash", salts.alias("salts")), "hot")
    first = first.select("hash", "first", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    salted = wins.join(hot, "hash", "left").withColumn(
        "salt", F.coalesce(F.pmod(F.xxhash64("id", "digest", "pos"), F.col("salts")).cast("int"), F.lit(0))).drop("salts")
    later = salted.join(first, ["hash", "salt"]).filter(~place.eqNullSafe(F.col("first")))
    # Bounded by the lines of one document.
    return later.groupBy("id", "digest").agg(F.sort_array(F.collect_list("pos")).alias("starts"))


def place_key(id_: Column, digest: Column) -> Column:
    """A document's id and the MD5 of its text, either of them null or not, as one value."""
    return F.md5(F.concat_ws("|", F.when(id_.isNull(), "-").otherwise("+"), id_.cast("string"), F.hex(digest)).cast("binary"))


def deduplicated(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW) -> DataFrame:
    """Every row of ``df`` as ``row``, with the new ``text``, ``n_lines`` and ``n_removed``."""
    later = later_windows(df, id_col, text_col, size)
    text = F.col(f"row.{text_col}")
    rows = packed(df).select("row", F.col(f"row.{id_col}").alias("id"))
    # One null-free key for the join and for numbering copies: one exchange of the text serves both.
    rows = rows.withColumn("key", place_key(F.col("id"), F.unhex(F.md5(text.cast("binary")))))
    met = rows.join(later.select(place_key(F.col("id"), F.col("digest")).alias("key"), "starts"), "key", "left")
    # Rows equal in id and text: all but one are later occurrences.
    met = met.withColumn("copy", F.row_number().over(Window.partitionBy("key").orderBy(F.lit(0))))
    met = met.withColumn("old", text).withColumn("lines", split_lines(text)).withColumn("n_lines", F.coalesce(F.size("lines"), F.lit(0)))
    met = met.withColumn("starts", F.when((F.col("copy") > 1) & (F.col("n_lines") >= size),
                                          F.sequence(F.lit(0), F.col("n_lines") - size)).otherwise(F.col("starts")))
    gone = F.array_distinct(F.flatten(F.transform("starts", lambda s: F.sequence(s, s + (size - 1)))))
    met = met.withColumn("gone", F.when(F.col("starts").isNotNull(), gone))
    left = F.array_except(F.sequence(F.lit(0), F.col("n_lines") - 1), F.col("gone"))
    kept = F.array_join(F.transform(left, lambda i: F.get("lines", i)), "\n")
    return met.select("row", "id", F.when(F.col("gone").isNull(), F.col("old")).otherwise(kept).alias("text"),
                      F.when(F.col("old").isNull(), 0).otherwise(F.col("n_lines")).cast("long").alias("n_lines"),
                      F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"))


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: id, lines, lines removed and the text that is left."""
    return deduplicated(df, id_col, text_col).select(F.col("id").alias(id_col), "n_lines", "n_removed", "text")


def clean(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = "n_chars") -> DataFrame:
    """``df`` with the text cut, and ``chars_col`` (if it is there) counted anew where the text has changed."""
    cut = deduplicated(df, id_col, text_col)
    chars = F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col(f"row.{chars_col}")) if chars_col in df.columns else None
    return cut.select(*[F.col("text").alias(c) if c == text_col
                        else chars.cast(df.schema[c].dataType).alias(c) if c == chars_col
                        else F.col(f"row.`{c}`").alias(c) for c in df.columns])
