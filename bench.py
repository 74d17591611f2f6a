"""Bench: run the headline queries over $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value", "unit", "queries", "sf"}. Each query
(planning included) is executed in full with the ``noop`` sink (no driver
collect); a query's time is the best of $BENCH_REPEAT runs (default 2) after
one warm-up run of the flagship query, and the value is their sum.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["keyword_hits", "raw_details", "file_report", "keyword_report", "request_report",
            "request_report_weighted", "unmatched_files", "category_hits", "scope_index",
            "cell_hits", "density_route"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from termscope.session import local_session
    from termscope.plans import catalog
    spark = local_session(cpus, int(cpus) if cpus.isdigit() else 8, app="termscope-bench")
    qs = catalog.QUERIES
    names = [n for n in HEADLINE if n in qs]
    # Warm-up (JVM, codegen caches) on the flagship.
    qs["file_report"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    times: dict[str, float] = {}
    for n in names:
        best = None
        for _ in range(repeat):
            t0 = time.time()
            qs[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            t = time.time() - t0
            best = t if best is None else min(best, t)
        times[n] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
