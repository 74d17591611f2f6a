"""Folders that every task sees (``file:``), listed and read by the tasks.

Spark's own listing holds each file of a folder on the driver, once for every
frame that reads it, and opens a file through several objects of its own. Here
the tasks walk the folder into a table, round by round, and read the files that
the table names, so the driver holds neither. Which files there are follows
Spark's readers: names that begin with ``_`` or ``.`` and empty files are left
out. Any other store is listed and read by Spark."""

from __future__ import annotations

import itertools
import os
import re
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folders that a task walks before it leaves those that it finds to the next round.
FOLDERS = 100_000
#: Files of a task that reads them; rows and bytes of a batch.
TASK_FILES, BATCH_ROWS, BATCH_BYTES = 10_000, 1_000, 4 << 20
#: Suffixes of files that Spark's text reader decompresses.
COMPRESSED = r"\.(gz|bz2|deflate|snappy|lz4|zst)$"

_LISTED = pa.schema([("path", pa.string()), ("length", pa.int64()), ("modified", pa.int64()), ("pending", pa.bool_())])


def local_folder(spark: SparkSession, root: str) -> str | None:
    """The path of ``root``, if it names a folder of the local file system without wildcards."""
    if re.search(r"[][{}*?\\]", root):
        return None
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() != "file":
        return None
    folder = fs.makeQualified(path).toUri().getPath()
    return folder if os.path.isdir(folder) else None


def _walk(most: int, pattern: str):
    """Rows of the files under the folders that arrive; folders found after ``most`` of them are rows to be walked yet (``pending``)."""
    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        named, listed, rows = re.compile(pattern, re.S), 0, []
        for batch in batches:
            todo = deque(batch.column(0).to_pylist())
            while todo:
                folder = todo.popleft()
                listed += 1
                with os.scandir(folder) as entries:
                    for e in entries:
                        name = e.name
                        if name.startswith(".") or name.endswith("._COPYING_") or (name.startswith("_") and "=" not in name):
                            continue
                        if e.is_dir():
                            if listed + len(todo) < most:
                                todo.append(e.path)
                            else:
                                rows.append((e.path, 0, 0, True))
                        elif named.fullmatch(name):
                            try:
                                is_ = e.stat()
                            except FileNotFoundError:  # a link to nothing, or gone meanwhile
                                continue
                            if is_.st_size:
                                rows.append((e.path, is_.st_size, is_.st_mtime_ns // 1_000_000, False))
                        if len(rows) >= 10_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _LISTED)], schema=_LISTED)
                            rows = []
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _LISTED)], schema=_LISTED)

    return walk


def walked(spark: SparkSession, root: str, glob: str | None = None) -> tuple[DataFrame, list[DataFrame]] | None:
    """(``path, length, modification_time`` of every file under ``root``, the
    tables that it reads), or None where Spark has to list it. ``root`` itself is
    listed here if it has few entries; each round of tasks walks the folders that
    were found before it and left."""
    from ..plans.materialize import materialize
    folder = local_folder(spark, root)
    if folder is None:
        return None
    pattern = spark._jvm.org.apache.hadoop.fs.GlobPattern(glob).compiled().pattern() if glob else ".*"
    cores = spark.sparkContext.defaultParallelism
    schema = "path string, length long, modified long, pending boolean"
    top = list(itertools.islice(_walk(1, pattern)(iter([pa.RecordBatch.from_pydict({"path": [folder]})])), 2))
    if len(top) < 2:
        rows = [tuple(r.values()) for b in top for r in b.to_pylist()]
        found, n = [spark.createDataFrame(rows, schema)], sum(r[3] for r in rows)
    else:
        rows, found, n = [(folder, 0, 0, True)], [], 1
    todo, most, tables = spark.createDataFrame(rows, schema), FOLDERS if found else 1, []
    while n:
        todo = todo.where("pending").select("path").repartition(min(n, max(8 * cores, n // TASK_FILES)), "path")
        todo = materialize(todo.mapInArrow(_walk(most, pattern), schema), "listing")
        tables.append(todo)
        n, most = todo.where("pending").count(), FOLDERS
    files, *more = [*found, *tables]
    for t in more:
        files = files.unionByName(t)
    return files.where("not pending").select("path", "length", F.timestamp_millis("modified").alias("modification_time")), tables


def _dealt(files: DataFrame, n: int, size: int, split: int, *by: str) -> DataFrame:
    """Files in tasks of about ``split`` bytes and no more than about ``TASK_FILES`` files."""
    cores = files.sparkSession.sparkContext.defaultParallelism
    return files.repartition(max(1, min(n, cores), size // split, n // TASK_FILES), *by)


def _split_bytes(spark: SparkSession) -> int:
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get("spark.sql.files.maxPartitionBytes"))


def _counted(files: DataFrame, compressed: bool) -> tuple[int, int] | None:
    """Number and bytes of the files; None where some are compressed and the reader would have to decode them."""
    packed = F.col("path").rlike(COMPRESSED) if compressed else F.lit(False)
    n, size, packed = files.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0)), F.count_if(packed)).first()
    return None if packed else (n, size)


class _Batches:
    """Rows that end in bytes, sent on in batches."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.held = schema, [], 0

    def add(self, *row) -> bool:
        """Whether the batch is full."""
        self.rows.append(row)
        self.held += len(row[-1])
        return self.held >= BATCH_BYTES or len(self.rows) >= BATCH_ROWS

    def sent(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*self.rows), self.schema)], schema=self.schema)
        self.rows, self.held = [], 0
        return out


def bodies(files: DataFrame, decoded: bool = False) -> DataFrame | None:
    """``path, content`` (the bytes) of the files; with ``decoded`` None if any is compressed."""
    counted = _counted(files, decoded)
    if counted is None:
        return None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Batches(pa.schema([("path", pa.string()), ("content", pa.binary())]))
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open(path, "rb") as f:
                    full = out.add(path, f.read())
                if full:
                    yield out.sent()
        if out.rows:
            yield out.sent()

    return _dealt(files, *counted, _split_bytes(files.sparkSession), "path").select("path").mapInArrow(read, "path string, content binary")


def _line_bytes(f, start: int, end: int) -> Iterator[bytes]:
    """The bytes of the lines that begin in ``[start, end)`` of an open file. Lines end with a line feed, a carriage return or both."""
    block = 1 << 20
    if start:
        f.seek(start - 1)
        before, here = f.read(1), f.read(1)
        at = start
        if before == b"\r" and here == b"\n":
            at = start + 1
        elif before not in (b"\r", b"\n"):  # within a line: on to the next
            f.seek(start)
            while True:
                body = f.read(block)
                if not body:
                    return
                found = [i for i in (body.find(b"\n"), body.find(b"\r")) if i >= 0]
                if found:
                    at += min(found) + 1
                    if body[min(found):min(found) + 1] == b"\r":
                        f.seek(at)
                        at += f.read(1) == b"\n"
                    break
                at += len(body)
        if at >= end:
            return
        start = at
    f.seek(start)
    last = b""
    while start < end:
        body = f.read(min(block, end - start))
        if not body:
            return
        start, last = start + len(body), body[-1:]
        yield body
    if last == b"\n":
        return
    if last == b"\r":  # its line feed, if that follows
        if f.read(1) == b"\n":
            yield b"\n"
        return
    while body := f.read(block):  # the rest of the last line
        found = [i for i in (body.find(b"\n"), body.find(b"\r")) if i >= 0]
        if found:
            yield body[:min(found)] + b"\n"
            return
        yield body


def _line_chunks(path: str, start: int, end: int, size: int) -> Iterator[bytes]:
    """Those lines, each with a line feed, in chunks of ``size`` bytes or up to the line end after them."""
    held, seen, cut = bytearray(), 0, b""  # ``cut``: a carriage return that a line feed may follow
    with open(path, "rb") as f:
        first, ends = not start, True
        for body in _line_bytes(f, start, end):
            body = cut + body
            if first and body.startswith(b"\xef\xbb\xbf"):  # as Spark's reader
                body = body[3:]
                ends = len(body) > 0
            first, cut = False, b"\r" if body.endswith(b"\r") else b""
            body = body[:-1] if cut else body
            held += body.replace(b"\r\n", b"\n").replace(b"\r", b"\n") if b"\r" in body else body
            while (i := held.find(b"\n", max(size - 1, seen))) >= 0:
                yield bytes(held[:i + 1])
                del held[:i + 1]
                seen = 0
            seen = len(held)
        if cut or (held and held[-1] != 10) or not ends:
            held += b"\n"
        # A carriage return that was held back may have filled a chunk.
        while (i := held.find(b"\n", max(size - 1, 0))) >= 0:
            yield bytes(held[:i + 1])
            del held[:i + 1]
        if held:
            yield bytes(held)


def line_chunks(files: DataFrame, size: int, keep: Column | None = None) -> DataFrame | None:
    """``path, block, seq, body``: the files' lines in chunks, a file of more than
    a split's bytes in several splits; None if any file is compressed."""
    files = files if keep is None else files.where(keep)
    counted = _counted(files, True)
    if counted is None:
        return None
    split = _split_bytes(files.sparkSession)
    step = F.lit(split).cast("long")
    pieces = files.select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, step)).alias("block"))
    pieces = pieces.select("path", "block", F.least(F.col("block") + step, F.col("length")).alias("end"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Batches(pa.schema([("path", pa.string()), ("block", pa.int64()), ("seq", pa.int32()), ("body", pa.binary())]))
        for batch in batches:
            for path, block, end in zip(*(c.to_pylist() for c in batch.columns)):
                for seq, body in enumerate(_line_chunks(path, block, end, size)):
                    if out.add(path, block, seq, body):
                        yield out.sent()
        if out.rows:
            yield out.sent()

    n, total = counted
    return _dealt(pieces, n + total // split, total, split, "path", "block").mapInArrow(read, "path string, block long, seq int, body binary")
