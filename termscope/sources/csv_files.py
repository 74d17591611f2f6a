"""CSV files of any size, each parsed by many tasks.

A line feed inside quotes does not end a record, so whether a line begins a
record depends on all that comes before it. A chunk of lines is therefore
scanned under both assumptions, that it begins a record and that it begins
within quotes: each gives the number of records that end in it and how it ends.
These are the two values of a small function; composing the functions of a
file's chunks in order tells how each chunk really begins and how many records
ended before it. Every chunk is then parsed by itself. What a chunk holds of a
record that it does not hold whole is put together with the other chunks' parts
of the record, by file and row.

Parsing is the csv library's own (doubled quotes, quotes within unquoted cells,
any number of columns, cells of any length; a blank line is a row without cells).
"""

from __future__ import annotations

import csv
import itertools
import operator
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .chunks import CHUNK_BYTES, PLACE, file_chunks

CELLS_SCHEMA = "path string, row long, col int, value string"
_CELLS = pa.schema([("path", pa.string()), ("row", pa.int64()), ("col", pa.int32()), ("value", pa.string())])
# A batch of cells is sent on at so many cells or characters.
BATCH_CELLS, BATCH_CHARS = 50_000, 4 << 20


def records(lines: list[str], quoted: bool) -> Iterator[tuple[list[str], int, int, bool]]:
    """(cells, first line, line after it, whether it ends here) of each record of
    ``lines``, of which the first begins within quotes if ``quoted``."""
    csv.field_size_limit(sys.maxsize)
    used_up = False

    def fed() -> Iterator[str]:
        nonlocal used_up
        for k, line in enumerate(lines):
            yield ('"' if quoted and k == 0 else "") + line + "\n"
        used_up = True  # asked for more: the record goes on

    reader, at = csv.reader(fed()), 0
    for cells in reader:
        yield cells, at, reader.line_num, not used_up
        at = reader.line_num


def scan(lines: list[str], quoted: bool) -> tuple[int, bool, int, int]:
    """(records that end here, whether the last line is within quotes, lines of
    the first record here, first line of the record that goes on)."""
    ends, goes_on, head, tail = 0, False, len(lines), len(lines)
    for k, (_, first, after, ended) in enumerate(records(lines, quoted)):
        if k == 0:
            head = after
        if ended:
            ends += 1
        else:
            goes_on, tail = True, first
    return ends, goes_on, head, tail


_SIDES = [f"{name}_{side}" for side in ("new", "quoted") for name in ("ends", "open", "head", "tail")]
SCANNED = "path string, block long, seq int, error string, " + ", ".join(
    f"{c} {'boolean' if c.startswith('open') else 'long'}" for c in _SIDES)
STATES = "path string, block long, seq int, quoted boolean, before long, ends long, open boolean, head long, tail long, error string"


def _lines(body: bytes) -> list[str]:
    return body.decode("utf-8").split("\n")[:-1]


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        errors, sides = [], []
        for body in batch.column(3):
            body, error = body.as_py(), None
            n = body.count(b"\n")
            both = (n, False, min(n, 1), n, 0, True, n, 0)  # without a quote
            try:
                if b'"' in body:
                    lines = _lines(body)
                    both = (*scan(lines, False), *scan(lines, True))
                else:
                    body.decode("utf-8")
            except (UnicodeDecodeError, csv.Error) as exc:
                error = f"{type(exc).__name__}: {getattr(exc, 'reason', exc)}"
            errors.append(error)
            sides.append(both)
        columns = [pa.array(c, pa.bool_() if name.startswith("open") else pa.int64()) for name, c in zip(_SIDES, zip(*sides))] if sides else [
            pa.array([], pa.bool_() if name.startswith("open") else pa.int64()) for name in _SIDES]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(errors, pa.string()), *columns], names=[*PLACE, "error", *_SIDES])


_STATES = pa.schema([
    ("path", pa.string()), ("block", pa.int64()), ("seq", pa.int32()), ("quoted", pa.bool_()), ("before", pa.int64()), ("ends", pa.int64()),
    ("open", pa.bool_()), ("head", pa.int64()), ("tail", pa.int64()), ("error", pa.string())])


def _composed(rows: list[dict]) -> list[dict]:
    """The chunks of one file in order: how each begins, and the records before it."""
    out, quoted, before = [], False, 0
    error = next((r["error"] for r in rows if r["error"]), None)
    for r in rows[:1] if error else rows:
        side = "quoted" if quoted else "new"
        out.append({**{c: r[c] for c in PLACE}, "quoted": quoted, "before": before, "error": error,
                    **{c: r[f"{c}_{side}"] for c in ("ends", "open", "head", "tail")}})
        quoted, before = r[f"open_{side}"], before + r[f"ends_{side}"]
    return out


def _states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The chunks of files that arrive one after the other, each in order."""
    out = []
    rows = (r for batch in batches for r in batch.to_pylist())
    for _, own in itertools.groupby(rows, operator.itemgetter("path")):
        out += _composed(list(own))
        if len(out) >= BATCH_CELLS:
            yield pa.RecordBatch.from_pylist(out, schema=_STATES)
            out = []
    if out:
        yield pa.RecordBatch.from_pylist(out, schema=_STATES)


class CsvFiles:
    """The CSV files under ``root``. ``states`` has a row per chunk (a written
    table); a file that cannot be parsed has one row, with an ``error``, and no cells."""

    def __init__(self, spark: SparkSession, root: str, glob: str | None = "*.csv", keep: Column | None = None, size: int = CHUNK_BYTES,
                 *, files: DataFrame | None = None):
        from ..plans.materialize import materialize
        self.chunks = file_chunks(spark, root, glob, keep, size, files=files)
        scanned = self.chunks.mapInArrow(_scanned, SCANNED).repartition("path").sortWithinPartitions("path", "block", "seq")
        self.states = materialize(scanned.mapInArrow(_states, STATES), "csv-states")

    def errors(self) -> DataFrame:
        return self.states.where("error is not null").select("path", "error")

    def row_counts(self) -> DataFrame:
        """``path, n_rows``; a record open at the end of a file is its last row."""
        last = F.max(F.struct("block", "seq", (F.col("before") + F.col("ends") + F.col("open").cast("long")).alias("n")))
        return self.states.where("error is null").groupBy("path").agg(last.alias("l")).select("path", F.col("l.n").alias("n_rows"))

    def cells(self) -> DataFrame:
        """``path, row, col, value`` (1-based) of every cell."""
        good = self.states.where("error is null").drop("error")
        own = self.chunks.join(good, PLACE)
        # A record is in parts where a chunk begins within quotes or ends so.
        parted = own.where("quoted or open").select("path", "block", "seq", "body", "quoted", "before", "ends", "open", "head", "tail")
        parts = parted.mapInArrow(_parts, "path string, row long, block long, seq int, body binary")
        joined = parts.repartition("path", "row").sortWithinPartitions("path", "row", "block", "seq").select("path", "row", "body")
        whole = own.select("path", "body", "quoted", "before", "ends", "head", "tail").mapInArrow(_whole, CELLS_SCHEMA)
        return whole.unionByName(joined.mapInArrow(_joined, CELLS_SCHEMA))


def _sent(cells: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*cells), _CELLS)], schema=_CELLS)


def _batched(cells: Iterator[tuple]) -> Iterator[pa.RecordBatch]:
    out, chars = [], 0
    for cell in cells:
        out.append(cell)
        chars += len(cell[3])
        if len(out) >= BATCH_CELLS or chars >= BATCH_CHARS:
            yield _sent(out)
            out, chars = [], 0
    if out:
        yield _sent(out)


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of the records that lie within one chunk."""
    def cells() -> Iterator[tuple]:
        for batch in batches:
            for r in zip(*batch.columns):
                path, body, quoted, before, ends, head, tail = (x.as_py() for x in r)
                if quoted and not ends:
                    continue
                first = head if quoted else 0
                row = before + quoted
                for k, (values, *_) in enumerate(records(_lines(body)[first:tail], False), row + 1):
                    for col, value in enumerate(values, 1):
                        yield path, k, col, value

    yield from _batched(cells())


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What chunks hold of records that reach beyond them, by file and row."""
    for batch in batches:
        out = []
        for r in zip(*batch.columns):
            path, block, seq, body, quoted, before, ends, goes_on, head, tail = (x.as_py() for x in r)
            lines = body.split(b"\n")[:-1]
            if quoted:
                out.append((path, before + 1, block, seq, b"\n".join(lines[:head]) + b"\n"))
            if goes_on and (ends or not quoted):
                out.append((path, before + ends + 1, block, seq, b"\n".join(lines[tail:]) + b"\n"))
        if out:
            types = [pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=["path", "row", "block", "seq", "body"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cells of records whose parts arrive one after the other."""
    def parts() -> Iterator[tuple]:
        for batch in batches:
            for r in zip(*batch.columns):
                yield tuple(x.as_py() for x in r)

    def cells() -> Iterator[tuple]:
        for (path, row), group in itertools.groupby(parts(), operator.itemgetter(0, 1)):
            lines = _lines(b"".join(body for *_, body in group))
            for values, *_ in records(lines, False):
                for col, value in enumerate(values, 1):
                    yield path, row, col, value

    yield from _batched(cells())


def csv_cells(spark: SparkSession, root: str, glob: str = "*.csv") -> DataFrame:
    """Every CSV cell under ``root``, ``path, row, col, value`` (1-based). The
    files are scanned at once for where records begin; one that cannot be parsed
    raises an error (``scan_folder`` lists such files instead)."""
    files = CsvFiles(spark, root, glob)
    bad = files.errors().first()
    if bad:
        raise ValueError(f"{bad.path}: {bad.error}")
    return files.cells()
