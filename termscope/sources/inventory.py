"""File inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import plain_path, with_path_parts
from .walk import walked


def few_tasks(files: DataFrame) -> DataFrame:
    """A scan of many small files in fewer tasks: Spark counts a file's opening as
    megabytes and makes a task of a few files. A task still takes its files one
    after the other; a scan without so many tasks stays as it is."""
    n = files.rdd.getNumPartitions()
    most = max(32 * files.sparkSession.sparkContext.defaultParallelism, n // 64)
    return files.coalesce(most) if n > most else files


def list_files(spark: SparkSession, root: str, glob: str | None = None, *, files: DataFrame | None = None) -> DataFrame:
    """Every file under ``root`` (recursive) with ``path, length,
    modification_time`` and the path parts. The tasks walk a folder that they
    see into a table (``sources.walk``; ``files``, if that was done before); in
    another store Spark's listing is read, the content column pruned. No file
    body is read. An empty root is an error, as in the reference."""
    if files is None and (found := walked(spark, root, glob)):
        files = found[0]
    df = _listed(spark, root, glob) if files is None else files
    if not df.head(1):  # one task; isEmpty() runs them all
        raise FileNotFoundError(f"no files under {root}")
    return with_path_parts(df)


def _listed(spark: SparkSession, root: str, glob: str | None) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(root).select(
        plain_path(F.col("_metadata.file_path")).alias("path"), "length",
        F.col("modificationTime").alias("modification_time"))
    return few_tasks(df)


def with_folders(files: DataFrame, root: str = "", exclude_suffix: str | None = None) -> DataFrame:
    """One row per file and one per directory between ``root`` and the
    file (``entry`` = ``Folder`` or ``File``), as the scope index lists them.
    Without a root, every directory below ``/`` (or below an object store's
    ``scheme://bucket``) is listed; files outside ``root`` have none.
    ``exclude_suffix`` drops a bookkeeping file by name (F10)."""
    if exclude_suffix:
        files = files.where(~F.col("path").endswith(exclude_suffix))
    base = root.rstrip("/")
    top = F.lit(base) if base else F.regexp_extract("path", r"^([A-Za-z][A-Za-z0-9+.-]*://[^/]*)?", 0)
    below = F.substring(F.col("path"), F.length(top) + 1, F.length("path"))
    parts = F.split(below, "/")  # "", dir, ..., file
    inside = below.startswith("/") & (F.col("path").startswith(top)) & (F.size(parts) > 2)
    prefixes = F.when(inside, F.transform(F.sequence(F.lit(2), F.greatest(F.size(parts) - 1, F.lit(2))),
                                          lambda i: F.concat(top, F.array_join(F.slice(parts, 1, i), "/"))))
    dirs = files.select(F.explode(prefixes).alias("path")).distinct()
    dirs = dirs.select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"),
                       F.lit("Folder").alias("entry"))
    return files.select("path", "file_name", F.lit("File").alias("entry")).unionByName(dirs)


def select_prefix(keys: DataFrame, prefix: str, key: str = "key") -> DataFrame:
    """S3: object keys under a prefix; keys ending in ``/`` (folder markers,
    empty names) are dropped."""
    k = F.col(key)
    return keys.where(k.startswith(prefix) & ~k.endswith("/") & (F.length(k) > len(prefix)))


def last_file(files: DataFrame) -> DataFrame:
    """The reference keeps the last file its walk meets in the request
    folder; with no defined walk order, the greatest path is kept."""
    return files.agg(F.max("path").alias("path"))
