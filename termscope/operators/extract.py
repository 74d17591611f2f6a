"""The extractor hook.

Formats that need a parser library are turned into segments by a user
function run per file inside Spark tasks (``mapInArrow``): Spark spreads the
files over the cluster (U7) and a file whose parser raises, dies or takes longer
than its time limit becomes an error row instead of failing the job (U6), as the
reference skips such files.

A task's parser runs in a child process, so that one which hangs (in native
code, too) can be ended; the next file gets a new child. Segments come in parts
while the parser runs, so no file's segments are held as one list.
"""

from __future__ import annotations

import itertools
import multiprocessing
import os
import signal
import time
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

OUT_SCHEMA = ("path string, seg_ord long, location string, page_count int, text string, "
              "error string")
_OUT = pa.schema([("path", pa.string()), ("seg_ord", pa.int64()), ("location", pa.string()), ("page_count", pa.int32()),
                  ("text", pa.string()), ("error", pa.string())])

Extractor = Callable[[str, object], Iterable[tuple[int, str, int, str]]]

# Bits of a cell's segment number left for its column.
COLUMN_BITS = 24


PART_ROWS = 5_000      # segments that a child hands over at a time
TIME_LIMIT = 300.0     # seconds for a file, as the reference gives its parsers


def _serve(fn: Extractor, pipe) -> None:
    """The child: parse each (path, body) that arrives, hand its segments over in parts, then ("end", error)."""
    signal.signal(signal.SIGINT, signal.SIG_IGN)
    while True:
        try:
            path, body = pipe.recv()
        except EOFError:
            os._exit(0)
        error = None
        try:
            rows = ((int(o), str(loc), int(n), text) for o, loc, n, text in fn(path, body))
            while part := list(itertools.islice(rows, PART_ROWS)):
                pipe.send(("rows", part))
        except Exception as exc:  # one bad file must not stop the run
            error = f"{type(exc).__name__}: {exc}"
        pipe.send(("end", error))


class _Parser:
    """A child process that runs ``fn`` on one file after the other."""

    def __init__(self, fn: Extractor, seconds: float):
        self.fn, self.seconds, self.child, self.pipe = fn, seconds, None, None

    def _start(self) -> None:
        context = multiprocessing.get_context("fork")
        self.pipe, theirs = context.Pipe()
        self.child = context.Process(target=_serve, args=(self.fn, theirs), daemon=True)
        self.child.start()
        theirs.close()

    def stop(self) -> None:
        if self.child is not None:
            self.child.kill()
            self.child.join()
            self.pipe.close()
            self.child = None

    def parse(self, path: str, body: object) -> Iterator[tuple[list, str | None]]:
        """(segments, None) parts, then ([], error) if the file failed."""
        if self.child is None:
            self._start()
        until = time.monotonic() + self.seconds
        try:
            self.pipe.send((path, body))
            while True:
                if not self.pipe.poll(max(0.0, until - time.monotonic())):
                    self.stop()
                    yield [], f"TimeoutError: more than {self.seconds:g} s"
                    return
                kind, what = self.pipe.recv()
                if kind == "end":
                    if what:
                        yield [], what
                    return
                yield what, None
        except (EOFError, OSError):
            self.stop()
            yield [], "RuntimeError: the parser ended its process"


def extract(files: DataFrame, fn: Extractor, content: str = "content",
            partitions: int | None = None, key: str = "path", seconds: float = TIME_LIMIT) -> DataFrame:
    """Apply ``fn(path, content) -> [(seg_ord, location, page_count, text)]``
    to every file. Returns segments plus an ``error`` column: a file that fails
    (``Type: message``), ends its process or takes more than ``seconds`` has an
    error row, after the segments it had given by then; ``segments_of`` leaves
    those out.

    Spark cuts the input into batches by ``spark.sql.execution.arrow.maxBytesPerBatch``.
    ``partitions`` spreads the files first (by path hash) when the listing
    arrives in too few partitions. ``key`` may name another column handed to
    ``fn`` and returned as ``path``."""
    src = files.select(key, content)
    if partitions:
        src = src.repartition(partitions, key)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _Parser(fn, seconds)
        try:
            for batch in batches:
                for path, body in zip(batch.column(0), batch.column(1)):
                    path = path.as_py()
                    for rows, error in parser.parse(path, body.as_py()):
                        rows = [(path, *r, None) for r in rows] or [(path, None, None, None, None, error)]
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _OUT)], schema=_OUT)
        finally:
            parser.stop()

    return src.mapInArrow(run, OUT_SCHEMA)


def segments_of(extracted: DataFrame) -> DataFrame:
    """The segments of files without an error. Write ``extracted`` first where
    parsing is costly: it is read twice."""
    bad = errors_of(extracted).select("path").distinct()
    return extracted.where("error IS NULL").drop("error").join(bad, "path", "left_anti")


def errors_of(extracted: DataFrame) -> DataFrame:
    """Failed files with their error."""
    return extracted.where("error IS NOT NULL").select("path", "error")
