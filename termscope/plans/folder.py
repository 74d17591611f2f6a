"""From a folder of files and a dictionary to every report.

``scan_folder`` lists a folder (S1), routes each file by its suffix (P13) and
scans it: text (S7) and CSV (S4) files of any size in chunks by many tasks,
other formats by the parser passed in for their handler (U1), a file at a time.
It gives the inventory with each file's status next to the segments.
``run_folder`` does the whole run: the request sheet of a second folder (S21,
S19), all reports, and the warnings.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import handler
from ..operators.extract import TIME_LIMIT, Extractor, errors_of, extract, segments_of
from ..sources.chunks import file_chunks, text_segments, text_windows
from ..sources.csv_files import CsvFiles, csv_cells
from ..sources.dictionary import user_keywords
from ..sources.inventory import last_file, list_files
from ..sources.scans import MAX_FILE_BYTES, csv_cell_segments, read_binary
from ..sources.walk import walked
from .materialize import materialize, release
from .requests import quarantined_requests
from .run import Results, run

BUILT_IN = ("txt", "csv")
#: Length of the longest keyword that a scan allows for, where the caller does not say.
REACH = 1000


@dataclass
class Scan:
    """``files``: path parts, ``handler``, ``status`` (scanned, failed, unknown)
    and ``reason``; ``segments`` of the scanned ones (with ``edge``, see
    ``sources.chunks.text_segments``); ``owned``: the tables they read."""
    files: DataFrame
    segments: DataFrame
    owned: list[DataFrame] = field(default_factory=list)

    def close(self) -> None:
        for df in self.owned:
            release(df)
        self.owned.clear()


def _one_reason(errors: DataFrame) -> DataFrame:
    """A file may fail in many chunks; it has one reason."""
    return errors.groupBy("path").agg(F.min("error").alias("error"))


def scan_folder(spark: SparkSession, root: str, extractors: dict[str, Extractor] | None = None, glob: str | None = None,
                max_bytes: int = MAX_FILE_BYTES, seconds: float = TIME_LIMIT, reach: int = REACH) -> Scan:
    """S1 + P13 + S4/S7/U1 + U6. A file whose handler has no parser, whose parser
    fails or takes more than ``seconds``, or that is larger than ``max_bytes``
    and goes to a parser that needs it whole, is ``failed`` with that reason; a
    file without a handler is ``unknown``. ``reach``: length of the longest
    keyword to be matched. A handler in ``extractors`` takes the place of a
    built-in one."""
    extractors = dict(extractors or {})
    known = [*extractors, *(h for h in BUILT_IN if h not in extractors)]
    owned, segments, errors = [], [], []
    # The folder is walked once; every reader takes its files from that table.
    listed, tables = walked(spark, root, glob) or (None, [])
    owned += tables
    none = F.lit(None).cast("int").alias("edge")

    def of(name: str) -> Column:
        return handler(F.col("path")) == name

    if "txt" not in extractors:
        windows = materialize(text_windows(file_chunks(spark, root, glob, of("txt"), files=listed)), "windows")
        owned.append(windows)
        bad = windows.where("error is not null").select("path", "error")
        errors.append(bad)
        segments.append(text_segments(windows.join(bad.select("path").distinct(), "path", "left_anti"), reach))
    if "csv" not in extractors:
        files = CsvFiles(spark, root, glob, of("csv"), files=listed)
        cells = materialize(files.cells(), "cells")
        owned += [files.states, cells]
        errors.append(files.errors())
        segments.append(csv_cell_segments(cells).withColumn("edge", none))
    if extractors:
        def routed(key: str, body: object):
            name, path = key.split(":", 1)
            return extractors[name](path, body)

        taken = None if listed is None else listed.where(handler(F.col("path")).isin(*extractors))
        bodies = read_binary(spark, root, glob, max_bytes, files=taken).withColumn("_handler", handler(F.col("path")))
        bodies = bodies.where(F.col("_handler").isin(*extractors)).select(F.concat_ws(":", "_handler", "path").alias("_route"), "content")
        extracted = extract(bodies, routed, key="_route", seconds=seconds).withColumn("path", F.regexp_replace("path", "^[^:]*:", ""))
        extracted = materialize(extracted, "segments")
        owned.append(extracted)
        errors.append(errors_of(extracted))
        segments.append(segments_of(extracted).withColumn("edge", none))

    listing = list_files(spark, root, glob, files=listed).withColumn("handler", handler(F.col("path")))
    failed = errors[0]
    for e in errors[1:]:
        failed = failed.unionByName(e)
    files = listing.join(_one_reason(failed), "path", "left")
    reason = F.when(F.col("handler") == "unknown", F.lit("unknown")).when(
        ~F.col("handler").isin(*known), F.concat(F.lit("no extractor for "), F.col("handler"))).when(
        F.col("handler").isin(*extractors) & (F.col("length") > max_bytes), F.lit(f"larger than {max_bytes} bytes")).otherwise(F.col("error"))
    status = F.when(F.col("handler") == "unknown", "unknown").when(F.col("reason").isNotNull(), "failed").otherwise("scanned")
    files = files.withColumn("reason", reason).withColumn("status", status).drop("error")
    found = segments[0]
    for s in segments[1:]:
        found = found.unionByName(s)
    return Scan(files, found, owned)


def read_request_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A request sheet saved as CSV: second column the number, sixth the
    area, seventh the sentence, in row order (the header row, if there is one,
    carries no area ``it`` and drops out with the other areas)."""
    cells = csv_cells(spark, path, glob="*")

    def at(col):
        return F.max(F.when(F.col("col") == col, F.col("value")))
    return cells.groupBy("row").agg(at(2).alias("request_no"), at(6).alias("area"), at(7).alias("sentence")).select(
        "request_no", "area", F.coalesce("sentence", F.lit("")).alias("sentence"), F.col("row").alias("row_ord"))


def request_sheet_of(spark: SparkSession, root: str) -> DataFrame | None:
    """S21 + S19: the requests of the folder's last file, None for an empty folder."""
    try:
        files = list_files(spark, root)
    except FileNotFoundError:
        return None
    return read_request_sheet(spark, last_file(files).first()["path"])


def run_folder(spark: SparkSession, root: str, dictionary: DataFrame, request_root: str | None = None,
               user_terms: str | None = None, extractors: dict[str, Extractor] | None = None, lists: bool = False,
               **options) -> Results:
    """The whole run. The results read tables in the checkpoint folder until ``close()``."""
    terms = dictionary.select("category", "keyword", F.col("row_ord").cast("long").alias("row_ord"))
    terms = terms.unionByName(user_keywords(spark, user_terms))
    reach = terms.agg(F.coalesce(F.max(F.length("keyword")), F.lit(1))).first()[0]
    scan = scan_folder(spark, root, extractors, reach=max(1, reach))
    requests = request_sheet_of(spark, request_root) if request_root else None
    warnings = []
    if request_root and requests is None:
        warnings.append("request folder is empty")
    if requests is not None and not quarantined_requests(requests).isEmpty():
        warnings.append("request list has rows without a valid number")
    out = run(scan.files, scan.segments, terms, requests, root=root, warnings=warnings, lists=lists, **options)
    out.owned += scan.owned
    return out
