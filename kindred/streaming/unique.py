"""Unique keys checked while documents arrive (K5 with I2 and I3).

The source's raw table refuses a second document without ``score`` under a key
(I2) and a second document with the same key and value (I3).  Here the keys of
arriving documents are grouped, and a counter per rule and key is kept in the
stream's state: what comes beyond the first is reported in the batch it arrives
in, across batches and restarts.  The state holds one number per key, and a batch
gives one row per repeated key, however often it comes.

The documents themselves go to the stage through :func:`stream_stage`; as in the
batch checks, repeated ones are reported, not dropped.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from kindred.operators.integrity import stored_documents
from kindred.operators.stage import classify
from kindred.session import ship_package
from kindred.streaming.ingest import document_stream

REPEATS = "rule string, _key string, value string, n_repeated long"


def rule_keys(st: DataFrame) -> DataFrame:
    """``rule, _key, value``: the keys by which the rules want each staged document to be unique."""
    key, value = F.col("_key"), F.col("value")
    plain = F.when(~F.col("has_score") & key.isNotNull(),
                   F.struct(F.lit("I2").alias("rule"), key.alias("_key"), F.lit(None).cast("string").alias("value")))
    pair = F.when(key.isNotNull() & value.isNotNull(), F.struct(F.lit("I3").alias("rule"), key.alias("_key"), value.alias("value")))
    return stored_documents(st).select(F.explode(F.array_compact(F.array(plain, pair))).alias("k")).select("k.*")


def _beyond_first(key: tuple, frames: Iterator, state: GroupState):
    import pandas as pd
    seen = state.get[0] if state.exists else 0
    n = sum(len(f) for f in frames)
    state.update((seen + n,))
    repeated = n if seen else n - 1
    if repeated:
        yield pd.DataFrame({"rule": [key[0]], "_key": [key[1]], "value": [key[2]], "n_repeated": [repeated]})


def stream_repeats(spark: SparkSession, source_dir: str, report_dir: str, checkpoint: str | None = None,
                   available_now: bool = True, processing_time: str | None = None,
                   max_files_per_trigger: int | None = None, **classify_options) -> StreamingQuery:
    """Start the check: JSON Lines in ``source_dir`` -> rows of :data:`REPEATS` in
    ``report_dir``, one per batch and repeated key.  The checkpoint, which holds
    the counters, defaults to ``<report_dir>_checkpoint``."""
    ship_package(spark)
    staged = classify(document_stream(spark, source_dir, max_files_per_trigger), **classify_options)
    repeats = rule_keys(staged).groupBy("rule", "_key", "value").applyInPandasWithState(
        _beyond_first, REPEATS, "n long", "append", GroupStateTimeout.NoTimeout)
    w = (repeats.writeStream.format("parquet").option("path", report_dir)
         .option("checkpointLocation", checkpoint or report_dir.rstrip("/") + "_checkpoint").outputMode("append"))
    if processing_time:
        w = w.trigger(processingTime=processing_time)
    elif available_now:
        w = w.trigger(availableNow=True)
    return w.start()


def read_repeats(spark: SparkSession, report_dir: str) -> DataFrame:
    """``rule, _key, value, n_repeated`` over all batches so far."""
    return (spark.read.schema(REPEATS).parquet(report_dir).groupBy("rule", "_key", "value")
            .agg(F.sum("n_repeated").alias("n_repeated")))
