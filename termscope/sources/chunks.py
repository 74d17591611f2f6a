"""Text files of any size, read by many tasks.

A file is read in splits that begin and end at line ends, by the tasks
themselves in a folder that they see (``sources.walk``), else by Spark; a task
packs the lines of a split into chunks of about ``CHUNK_BYTES``. A chunk is named by file,
split (its first byte) and number, which depend on nothing but the file and the
split size, so it may be made again in a later job and met by its name: small
tables about chunks are joined to chunks, and the text itself is not shuffled
while those tables are small.

A line is one value of a row, as in Spark's reader; a file may have any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.paths import plain_path
from .inventory import few_tasks
from .walk import line_chunks, walked

CHUNK_BYTES = 1 << 20
CHUNK = "path string, block long, seq int, body binary"
PLACE = ["path", "block", "seq"]


def file_chunks(spark: SparkSession, root: str, glob: str | None = None, keep: Column | None = None,
                size: int = CHUNK_BYTES, *, files: DataFrame | None = None) -> DataFrame:
    """``path, block, seq, body``: the lines of the files under ``root``, each with
    a line feed (other line ends are read as such, as ``open()`` does), in chunks.
    ``keep`` is a condition on ``path``; files that it excludes are not opened.
    ``files``: the listing of ``sources.walk.walked``, if there is one already."""
    if files is None and (found := walked(spark, root, glob)):
        files = found[0]
    chunks = None if files is None else line_chunks(files, size, keep)
    if chunks is not None:
        return chunks
    reader = spark.read.option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    lines = reader.text(root).select(plain_path(F.col("_metadata.file_path")).alias("path"),
                                     F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("line"))
    lines = few_tasks(lines if keep is None else lines.where(keep))
    schema = pa.schema([("path", pa.string()), ("block", pa.int64()), ("seq", pa.int32()), ("body", pa.binary())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, seq, held, parts = None, 0, 0, []

        def sent() -> pa.RecordBatch:
            row = [place[0]], [place[1]], [seq], [b"\n".join(parts) + b"\n"]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for path, block, line in zip(*batch.columns):
                here = (path.as_py(), block.as_py())
                if here != place:
                    if parts:
                        yield sent()
                    place, seq, held, parts = here, 0, 0, []
                parts.append(line.as_py())
                held += len(parts[-1]) + 1
                if held >= size:
                    yield sent()
                    seq, held, parts = seq + 1, 0, []
        if parts:
            yield sent()

    return lines.mapInArrow(pack, CHUNK)


def text_windows(chunks: DataFrame) -> DataFrame:
    """``path, block, seq, text, error``: chunks decoded as UTF-8. A chunk that
    is not UTF-8 has an error instead of a text."""
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, errors = [], []
            for body in batch.column(3):
                try:
                    texts.append(body.as_py().decode("utf-8"))
                    errors.append(None)
                except UnicodeDecodeError as exc:
                    texts.append(None)
                    errors.append(f"{type(exc).__name__}: {exc.reason}")
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(texts, pa.string()), pa.array(errors, pa.string())],
                                             names=["path", "block", "seq", "text", "error"])

    return chunks.mapInArrow(decode, "path string, block long, seq int, text string, error string")


def window_edges(windows: DataFrame, reach: int) -> DataFrame:
    """``path, block, seq, text, edge``: for each window that another one of its
    file follows, its last ``reach`` characters and the ``reach`` characters after
    them, of which there are ``edge``. The ends of windows are all that moves."""
    ends = windows.where("text is not null").select(*PLACE, F.left("text", F.lit(reach)).alias("head"), F.right("text", F.lit(reach)).alias("tail"))
    # Every window has a character at least, so that many windows hold what follows.
    after = Window.partitionBy("path").orderBy("block", "seq").rowsBetween(1, reach)
    ends = ends.withColumn("next", F.left(F.array_join(F.collect_list("head").over(after), ""), F.lit(reach)))
    return ends.where("next <> ''").select(*PLACE, F.concat("tail", "next").alias("text"), F.length("next").alias("edge"))


#: The value of ``edge`` for a window that another one follows.
OPEN = -1


def text_segments(windows: DataFrame, reach: int) -> DataFrame:
    """S7 for files of any size: ``path, seg_ord, location, page_count, text,
    edge``, all windows of a file as parts of its one segment. A keyword is
    counted in the window that holds it (and, unless the window ends the file, a
    character after it) or else in the edge row that it crosses: once.
    ``reach``: length of the longest keyword."""
    edges = window_edges(windows, reach)
    inner = edges.select(*PLACE).withColumn("edge", F.lit(OPEN))
    parts = windows.where("text is not null").join(inner, PLACE, "left").select("path", "text", "edge")
    return parts.unionByName(edges.select("path", "text", "edge")).select(
        "path", F.lit(1).cast("long").alias("seg_ord"), F.lit("1").alias("location"), F.lit(1).alias("page_count"), "text", "edge")
