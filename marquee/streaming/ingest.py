"""Incremental ingestion: new CSV files in a folder, cleaned by the same functions, appended to Parquet.

The reference has no streams; this is its load-and-clean step run as a Structured Streaming job, so files that
keep arriving are cleaned once each. Cleaning is row-local (null drops and casts), so it needs no state and no
watermark; the checkpoint folder gives exactly-once output across restarts and lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from marquee.operators.clean import clean_movies, clean_ratings, clean_tags
from marquee.schemas import CSV_OPTIONS
from marquee.sources.files import _RAW

_CLEAN = {"ratings": clean_ratings, "movies": clean_movies, "tags": clean_tags}


def read_raw_stream(spark: SparkSession, path: str, table: str, max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(_RAW[table]).options(**CSV_OPTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path)


def clean_stream(spark: SparkSession, path: str, table: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """A streaming frame of the cleaned table; same columns and rules as the batch cleaning."""
    return _CLEAN[table](read_raw_stream(spark, path, table, max_files_per_trigger))


def ingest(
    spark: SparkSession,
    source_path: str,
    table: str,
    target_path: str,
    checkpoint_path: str | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the job; with ``available_now`` it processes what is there and stops (a scheduled batch run).

    The checkpoint belongs to the target: by default it is the folder ``<target>-checkpoint`` beside it, the same at
    every start, so a later run takes up the files that came since. A fresh checkpoint over an old target would
    number its batches anew, and the target's log would skip them as already written.
    """
    checkpoint = checkpoint_path or f"{target_path.rstrip('/')}-checkpoint"
    writer = (
        clean_stream(spark, source_path, table)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start(target_path)
