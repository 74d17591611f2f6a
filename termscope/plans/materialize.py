"""Cutting lineage for plans with several consumers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir


def materialize(df: DataFrame, name: str = "table", **options) -> DataFrame:
    """Write ``df`` as a parquet table in the cluster's checkpoint folder and
    read it back.

    Used for what several plans read: it is computed once (a reliable
    ``checkpoint()`` would run the plan a second time to write it), and a lost
    executor costs a re-read of the table rather than a re-scan of the corpus.
    The folder is the session's ``spark.checkpoint.dir`` (shared storage on a
    cluster); only a bare local session gets a scratch one. :func:`release`
    deletes the table again."""
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tables/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").options(**options).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._table_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete the table behind a frame from :func:`materialize` (nothing else)."""
    path = getattr(df, "_table_path", None)
    if path:
        delete_table(df.sparkSession, path)


def delete_table(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
