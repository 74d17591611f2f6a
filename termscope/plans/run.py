"""One run: inventory + segments + dictionary -> hit table -> every report.

The hit table is computed once and written to the checkpoint folder (the
reference writes its raw sheet and re-reads it for every report); the reports
are independent aggregations over it and can be written in any order. Hits
carry location and page count, so no report reads the text again. Closing the
results deletes the tables.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.match import keyword_hits, matchable
from ..operators.ordering import sequential_row_number
from ..sinks.writers import write_hits, write_report, write_summary_json
from ..sources.inventory import with_folders
from . import reports
from .materialize import materialize, release
from .requests import request_matches, request_report, request_report_weighted

HIT_KEY = ("path", "seg_ord", "location", "page_count")


class Results(dict):
    """Reports by name; ``owned`` are the tables they read."""

    def __init__(self, *args, **kw):
        super().__init__(*args, **kw)
        self.owned: list[DataFrame] = []

    def close(self) -> None:
        for df in self.owned:
            release(df)
        self.owned.clear()


def run(files: DataFrame, segments: DataFrame, dictionary: DataFrame,
        requests: DataFrame | None = None, relevance_threshold: int = 5,
        request_min_keywords: int = 5, root: str = "", warnings: Sequence[str] = (),
        lists: bool = False) -> Results:
    """All reports of a run as DataFrames (nothing but the hit table is
    written). ``lists`` renders the spreadsheet's list columns; without it the
    long forms (``keyword_files``, ``request_files``) say which files."""
    spark = segments.sparkSession
    d = materialize(matchable(dictionary), "dictionary")
    seen = Observation("hits")
    found = keyword_hits(segments, d, key=HIT_KEY, prepared=True).observe(seen, F.coalesce(F.sum("hits"), F.lit(0)).alias("total"))
    hits = materialize(found, "hits")
    scope = reports.scope_index(with_folders(files.select("path", "file_name"), root),
                                reports.scope_first_hits(segments, d.withColumnRenamed("kw_ord", "row_ord")))
    told = spark.createDataFrame(list(enumerate(warnings, 1)), "ord int, warning string") if warnings else None
    numbered = sequential_row_number(scope, "folder_path")
    out = Results({
        "raw_details": reports.raw_details(files, hits),
        "file_report": reports.file_report(files, hits, threshold=relevance_threshold, sort=True),
        "keyword_report": reports.keyword_report(files, hits, lists=lists),
        "keyword_files": reports.keyword_files(files, hits),
        "unmatched_files": reports.unmatched_files(files, hits),
        "skipped_files": reports.skipped_files(files),
        "scope_index": numbered,
        "run_summary": reports.run_summary(files, None, told, total_hits=int(seen.get["total"])),
    })
    if requests is not None:
        out["request_report"] = request_report(files, hits, requests, d, request_min_keywords, lists=lists)
        out["request_files"] = request_matches(files, hits, requests, d, request_min_keywords)
        out["request_report_weighted"] = request_report_weighted(files, hits, requests, d, lists=lists)
    out.owned += [d, hits]
    return out


def write_run(results: dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> None:
    for name, df in results.items():
        if name == "raw_details":
            write_hits(df, f"{out_dir}/{name}")
        elif name == "run_summary":
            write_summary_json(df, f"{out_dir}/{name}")
        else:
            write_report(df, f"{out_dir}/{name}", fmt)


def main(argv: list[str] | None = None) -> None:
    """Scan a folder against a dictionary table and write the reports."""
    from ..session import local_session
    from .folder import run_folder
    ap = argparse.ArgumentParser(description="keyword reports over a folder")
    ap.add_argument("--root", required=True, help="folder to scan")
    ap.add_argument("--dictionary", required=True, help="parquet table: category, keyword, row_ord")
    ap.add_argument("--requests", help="folder with the request sheet (CSV)")
    ap.add_argument("--keywords", help="the user's terms, comma-separated")
    ap.add_argument("--lists", action="store_true", help="render list columns")
    ap.add_argument("--out", required=True)
    ap.add_argument("--format", default="parquet")
    a = ap.parse_args(argv)
    spark: SparkSession = local_session()
    res = run_folder(spark, a.root, spark.read.parquet(a.dictionary), a.requests, a.keywords, lists=a.lists)
    write_run(res, a.out, a.format)
    res.close()
    print(json.dumps({"out": a.out, "reports": sorted(res)}))


if __name__ == "__main__":
    main()
