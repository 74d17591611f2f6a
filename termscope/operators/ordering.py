"""Running row numbers over a total order (W2, W3) without a global window.

``row_number() OVER (ORDER BY x)`` moves every row into one task. Here the
rows are range-partitioned on the order column, sorted inside each partition
and written once with their partition and place; a row's number is its place
plus the number of rows in all earlier partitions (a table with one row per
partition). Both sides read the one written table: a second range exchange
would sample other bounds."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.materialize import materialize


def sequential_row_number(df: DataFrame, order_col: str, name: str = "row_no",
                          partitions: int | None = None,
                          save: Callable[[DataFrame, str], DataFrame] = materialize) -> DataFrame:
    """Number the rows 1..n by ``order_col`` (which should be unique, so the
    numbering is deterministic when a task is re-run). ``save`` writes the
    ranges and reads them back, for a caller who keeps track of its tables."""
    n = partitions or df.sparkSession.sparkContext.defaultParallelism
    ranged = save(df.repartitionByRange(n, order_col).sortWithinPartitions(order_col)
                    .withColumn("_pid", F.spark_partition_id())
                    .withColumn("_id", F.monotonically_increasing_id()), "ranges")
    per = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_first"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per.select("_pid", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return (ranged.join(F.broadcast(offsets), "_pid")
                  .withColumn(name, (F.col("_id") - F.col("_first") + F.col("_off") + 1).cast("long"))
                  .drop("_pid", "_id", "_first", "_off"))
