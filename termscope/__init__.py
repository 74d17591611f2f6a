"""termscope: find dictionary terms in large document collections and report
them, on Spark.

Typical run::

    from termscope import run_folder, write_run
    results = run_folder(spark, "s3://bucket/room", dictionary, "s3://bucket/requests")
    write_run(results, "s3://bucket/out")
    results.close()
"""

from .operators.density import density_route as route_by_density
from .operators.match import find_hits, keyword_hits, prepare_dictionary
from .plans.folder import run_folder, scan_folder
from .plans.reports import (file_report, keyword_files, keyword_report, raw_details, run_summary,
                            scope_index, skipped_files, unmatched_files)
from .plans.requests import request_matches, request_report, request_report_any, request_report_weighted
from .plans.run import run, write_run

__all__ = ["find_hits", "keyword_hits", "prepare_dictionary", "route_by_density", "file_report",
           "keyword_files", "keyword_report", "raw_details", "run_summary", "scope_index", "skipped_files",
           "unmatched_files", "request_matches", "request_report", "request_report_any",
           "request_report_weighted", "run", "run_folder", "scan_folder", "write_run"]
