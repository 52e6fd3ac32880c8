"""Incremental ingest (K4/K5) as a Structured Streaming job.

The source ingests documents one statement per document, all at once or one
after another.  Here new JSON Lines files landing in a folder are picked up by
a file stream, parsed and classified (stateless, per micro-batch: no state
store, no watermark needed) and appended to the staged table through the
file sink, partitioned by ``kind`` exactly like :func:`kindred.operators.stage.stage`.

The file sink commits each micro-batch atomically through its metadata log,
and the checkpoint records which source files were consumed, so a restarted
or failed run neither loses nor duplicates documents.  Batch jobs then read
the staged table with :func:`read_stage` and run unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from kindred.operators.stage import STAGE_COLUMNS, classify


def document_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None
                    ) -> DataFrame:
    """Streaming DataFrame of ``data STRING`` from JSON Lines files."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (reader.load(source_dir)
            .select(F.col("value").alias("data"))
            .where(F.trim("data") != ""))


def stream_stage(spark: SparkSession, source_dir: str, stage_dir: str,
                 checkpoint: str | None = None, available_now: bool = True,
                 processing_time: str | None = None, max_files_per_trigger: int | None = None,
                 **classify_options) -> StreamingQuery:
    """Start the ingest stream: ``source_dir`` (JSON Lines) -> ``stage_dir``.

    ``available_now`` processes everything present and stops (a scheduled
    incremental load); otherwise give ``processing_time`` (e.g. ``"1 minute"``)
    for a continuously running ingest.  The checkpoint belongs to the staged
    table: it defaults to ``<stage_dir>_checkpoint``, so every later start of
    the same ingest goes on where the last one stopped.  (With a new checkpoint
    over an old table the sink would skip batches it has already committed.)
    """
    staged = classify(document_stream(spark, source_dir, max_files_per_trigger), **classify_options)
    w = (staged.writeStream.format("parquet")
         .option("path", stage_dir)
         .option("checkpointLocation", checkpoint or stage_dir.rstrip("/") + "_checkpoint")
         .partitionBy("kind")
         .outputMode("append"))
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def read_stage(spark: SparkSession, stage_dir: str) -> DataFrame:
    """The staged table written by :func:`stream_stage` (committed files
    only, via the sink's metadata log), columns in stage order."""
    return spark.read.parquet(stage_dir).select(*STAGE_COLUMNS)
