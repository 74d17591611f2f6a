"""Incremental scan of a drop folder with Structured Streaming.

Files that arrive in a folder are read whole, matched with the same batch
operator and their hits appended to a table; the reports then run as batch
jobs over that table. Matching is per file, so every micro-batch holds whole
files and no state is kept between batches; the checkpoint location makes the
stream restart where it stopped; a replayed batch overwrites its own output.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.paths import plain_path
from ..operators.match import keyword_hits, prepare_dictionary
from ..sources.scans import whole_text_segments


def start(spark: SparkSession, incoming: str, dictionary: DataFrame, hits_table: str,
          checkpoint: str, trigger_seconds: int | None = None, max_files_per_trigger: int = 1000):
    """Start the stream; returns the ``StreamingQuery``."""
    d = prepare_dictionary(dictionary).cache()
    stream = (spark.readStream.format("text").option("wholetext", True)
              .option("maxFilesPerTrigger", max_files_per_trigger).load(incoming)
              .select(plain_path(F.col("_metadata.file_path")).alias("path"), F.col("value").alias("text")))

    def per_batch(batch: DataFrame, batch_id: int) -> None:
        # Each micro-batch overwrites its own folder, so a batch replayed after
        # a failure replaces its earlier output instead of duplicating it.
        segs = whole_text_segments(batch)
        (keyword_hits(segs, d, prepared=True)
         .write.mode("overwrite").parquet(f"{hits_table}/batch_id={batch_id}"))

    w = stream.writeStream.foreachBatch(per_batch).option("checkpointLocation", checkpoint)
    if trigger_seconds:
        w = w.trigger(processingTime=f"{trigger_seconds} seconds")
    else:
        w = w.trigger(availableNow=True)
    return w.start()
