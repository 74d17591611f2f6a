"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.materialize import delete_table
from ..session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, by the path Spark reads it at."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the executors (once per application), so
    that tasks can import it where it is not installed."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="termscope-"), "termscope_package.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(package):
            for n in sorted(names):
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


_TABLES: ContextVar[list[str] | None] = ContextVar("tables", default=None)


def written(df: DataFrame, name: str, kept: bool = False) -> DataFrame:
    """Write ``df`` under the session's checkpoint folder and read it back: what
    several jobs read is computed once, and a lost executor costs a re-read.
    The folder is shared storage on a cluster (``spark.checkpoint.dir``).
    ``kept``: the table outlives a ``scratch`` block it is written in."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    tables = _TABLES.get()
    if tables is not None and not kept:
        tables.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._table_path = path
    return out


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that ``written`` makes within this block are deleted at its end, for
    a caller who has written the block's result elsewhere by then."""
    token = _TABLES.set([])
    try:
        yield
    finally:
        tables = _TABLES.get()
        _TABLES.reset(token)
        for path in tables:
            delete_table(spark, path)


def release(df: DataFrame) -> None:
    """Delete the table behind a frame from ``written`` (nothing else)."""
    path = getattr(df, "_table_path", None)
    if path:
        delete_table(df.sparkSession, path)


def give_back() -> None:
    """At the end of a task over texts: return the memory it has freed to the
    system, because the worker process stays for other operators' tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_of(col: str | Column) -> Column:
    """A text column with null taken as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def packed(df: DataFrame, name: str = "row") -> DataFrame:
    """The whole row as one struct column, so that no column an operator adds
    can clash with one the caller has; ``select("row.*")`` restores it."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name))


def ranked(df: DataFrame, group: list[str], coarse: str, order: list[str], name: str,
           rows_per_bucket: int = 100_000, counted: DataFrame | None = None) -> DataFrame:
    """Number the rows of each group 0, 1, 2, ... without a window over a group.

    Rows are numbered by ``coarse`` first (an integer column of few values,
    null-free), then by a hash sub-bucket, then by ``order``. Each (group,
    coarse) cell is cut into ceil(rows / rows_per_bucket) sub-buckets by the
    hash of ``order``, so a group or a cell may hold any share of all rows: the
    windows run over sub-buckets, and only the sub-bucket counts are summed up
    per group. ``order`` should identify a row; equal rows are interchangeable.
    ``counted``: the same rows in slim form, to count without reading wide ones."""
    keys = [*group, coarse]
    counted = df if counted is None else counted
    cell = counted.groupBy(*keys).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(float(rows_per_bucket))).cast("long").alias("__subs"))
    cell = cell.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__subs")
    same = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    on = same[0]
    for c in same[1:]:
        on = on & c
    cut, slim = (d.join(cell, on).drop(*[f"__k{i}" for i in range(len(keys))])
                  .withColumn("__sub", F.pmod(F.xxhash64(*order), F.col("__subs"))).drop("__subs")
                 for d in (df, counted))
    per = slim.groupBy(*keys, "__sub").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*group).orderBy(coarse, "__sub").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                     F.col("__sub").alias("__s"),
                     F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    within = Window.partitionBy(*keys, "__sub").orderBy(*order)
    cut = cut.withColumn("__rn", F.row_number().over(within))
    return (cut.join(per, on & (F.col("__sub") == F.col("__s")))
               .withColumn(name, (F.col("__rn") - 1 + F.col("__off")).cast("long"))
               .drop("__sub", "__s", "__off", "__rn", *[f"__k{i}" for i in range(len(keys))]))
