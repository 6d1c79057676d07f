"""Structured Streaming trigger for the pipeline.

A ``binaryFile`` stream over the landing folder yields one row per newly
arrived file (path and modification time; the file bodies are pruned). Each
micro-batch hands those rows to :meth:`Pipeline.run` as its listing, so the
batch is loaded with the same operators and the same replace-by-key sinks.
The stream's checkpoint remembers which files it has seen.

Spark's file source ignores a file rewritten under a name it has already
seen, so this trigger suits landing zones whose file names are never reused;
re-delivered files under the same name need the batch run, which compares
modification times. A replayed micro-batch (after a failure) only replaces
the same files' rows again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeline.plans.pipeline import Pipeline, RunSummary

# the binaryFile source's fixed schema (streaming sources need it spelled out)
BINARY_FILE_SCHEMA = T.StructType([
    T.StructField("path", T.StringType(), False),
    T.StructField("modificationTime", T.TimestampType(), False),
    T.StructField("length", T.LongType(), False),
    T.StructField("content", T.BinaryType(), True),
])


def landing_files_stream(pipeline: Pipeline, folder: str) -> DataFrame:
    """New landing files as a stream of ``(_source_file, _source_modified_at)``."""
    return (
        pipeline.spark.readStream.format("binaryFile")
        .schema(BINARY_FILE_SCHEMA)
        .option("pathGlobFilter", "*.parquet")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select(
            F.col("path").alias("_source_file"),
            F.col("modificationTime").cast("timestamp").alias("_source_modified_at"),
        )
    )


def start(pipeline: Pipeline, folder: str, checkpoint: str, available_now: bool = True,
          processing_time: str = "1 minute", summaries: list | None = None) -> StreamingQuery:
    """Start the trigger; ``available_now`` processes what is there and stops."""

    def load(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        summary: RunSummary = pipeline.run(listing=batch)
        if summaries is not None:
            summaries.append((epoch_id, summary))

    writer = landing_files_stream(pipeline, folder).writeStream.foreachBatch(load) \
        .option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time)
    return writer.start()
