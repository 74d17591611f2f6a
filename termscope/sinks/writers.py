"""Writing hits and reports.

All writers are plain ``DataFrameWriter`` calls (but for many small files in a
local folder): every task writes its own part files, nothing is funnelled
through one task or the driver.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_hits(raw: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: raw hits, partitioned by category (a category's files are then
    read without scanning the others). The partition column is a copy,
    ``category_part``, with a label for rows without a category (Unknown files):
    a partition value of '' would read back as null. A task sorts its rows by
    category, so the rows are dealt into tasks of bounded size before."""
    part = F.when(F.coalesce(F.col("category"), F.lit("")) == "", F.lit("(none)")).otherwise(F.col("category"))
    raw.withColumn("category_part", part).hint("rebalance", "category_part", "path").write.mode(mode).partitionBy("category_part").parquet(path)


# Values are written as they are: blanks at their ends kept, quotes doubled.
CSV_OPTIONS = {"quoteAll": True, "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_report(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """One report. ``fmt`` ``parquet`` (default) or ``csv``
    (header row, every value quoted as the spreadsheet export does)."""
    w = df.write.mode(mode)
    if fmt == "csv":
        w.options(header=True, **CSV_OPTIONS).csv(path)
    else:
        w.format(fmt).save(path)


def export_quoted_csv(df: DataFrame, path: str) -> None:
    """K8: a sheet exported as fully quoted CSV."""
    df.write.mode("overwrite").options(header=False, **CSV_OPTIONS).csv(path)


def write_summary_json(summary: DataFrame, path: str) -> None:
    """K9: the one-row run summary as JSON lines."""
    summary.coalesce(1).write.mode("overwrite").json(path)


# Folders over the files' own folders: a reader lists each of them in a task of its own.
FILE_GROUPS = 240


def write_file_each(rows: DataFrame, root: str, key: str, fmt: str = "text", *, own_folder: bool = True, **options) -> None:
    """A file per value of ``key`` (an integer), with its rows in ``fmt`` (text,
    csv, json): ``<root>/group=<g>/<key>=<value>/part-...``, the group being a hash.
    A folder costs more than its file; where no one looks at it, without
    ``own_folder`` a local file is ``<root>/group=<g>/<key>=<value>.<suffix>``.

    Spark's local file system starts two processes (``chmod``) for every file it
    creates, so in a local folder (shared by the executors, as the checkpoint
    folder is) the tasks write the files themselves, lines rendered by Spark; a
    file is complete when it gets its name, so a task may be run again. Any
    other store gets the files from Spark's writer."""
    spark = rows.sparkSession
    values = [c for c in rows.columns if c != key]
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    here = path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() == "file"
    grouped = rows.withColumn("group", F.pmod(F.xxhash64(key), F.lit(FILE_GROUPS)).cast("int"))
    tasks = max(spark.sparkContext.defaultParallelism, 4 * rows.rdd.getNumPartitions())
    if not here:
        grouped.repartition(tasks, key).write.partitionBy("group", key).options(**options).format(fmt).save(root)
        return
    texts = {k: str(v).lower() if isinstance(v, bool) else str(v) for k, v in options.items()}
    line = {"text": lambda: F.col(values[0]), "csv": lambda: F.to_csv(F.struct(*values), texts),
            "json": lambda: F.to_json(F.struct(*values), texts)}[fmt]()
    lines = grouped.select("group", F.col(key).cast("string").alias("key"), line.cast("binary").alias("line"))
    folder, suffix = path.toUri().getPath(), {"text": "txt"}.get(fmt, fmt)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        n, made = 0, None
        for (group, value), own in groupby(each, lambda r: r[:2]):
            value = "__HIVE_DEFAULT_PARTITION__" if value is None else value
            to = f"{folder}/group={group}" + (f"/{key}={value}" if own_folder else "")
            if to != made:
                os.makedirs(to, exist_ok=True)
                made = to
            with open(f"{to}/.{uuid.uuid4().hex}", "wb") as f:
                f.writelines(x for _, _, text in own for x in (text or b"", b"\n"))
            os.replace(f.name, f"{to}/part-0.{suffix}" if own_folder else f"{to}/{key}={value}.{suffix}")
            n += 1
        yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64())})

    os.makedirs(folder, exist_ok=True)
    lines.repartition(tasks, "key").sortWithinPartitions("group", "key").mapInArrow(write, "n long").agg(F.sum("n")).collect()


def append_dictionary_jdbc(dictionary: DataFrame, url: str, table: str, properties: dict) -> None:
    """K7: append a long dictionary to a database table (batched inserts by
    the JDBC writer, not row by row). Credentials come from ``properties``."""
    (dictionary.select("category", "keyword", F.col("row_ord").cast("long"))
     .write.jdbc(url=url, table=table, mode="append", properties=properties))
