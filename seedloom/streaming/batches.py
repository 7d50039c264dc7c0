"""Rate-limited batches as a file stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from seedloom import fixed
from seedloom.operators import sampling


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    files_per_batch: int = 1,
    file_format: str = "json",
    name_filter: str | None = None,
) -> DataFrame:
    """Rows of the files in a folder, at most ``files_per_batch`` files per batch."""
    reader = (
        spark.readStream.format(file_format)
        .schema(schema)
        .option("maxFilesPerTrigger", files_per_batch)
    )
    if file_format == "json":
        reader = reader.option("mode", "FAILFAST")
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.load(path)


def write_batches(rows: DataFrame, path: str, size: int = fixed.BATCH_SIZE, key: str = "ex_id", seed: int = 42) -> None:
    """The rows as JSON files of ``size`` shuffled rows each, the last with the rest.

    A stream of one file per batch then takes so many rows at a time; ``batch_idx`` is a column of
    them. Batches are dealt to tasks by number. A task writes its batches one after the other into one
    folder and starts a file every ``size`` rows: all batches are full but the last of all, which
    comes last in its task.
    """
    numbered = sampling.assign_batches(rows, size, key, seed)
    parts = numbered.repartition("batch_idx").sortWithinPartitions("batch_idx")
    parts.write.option("ignoreNullFields", "false").option("maxRecordsPerFile", size).json(path)


def dealt(rows: DataFrame, key: str = "ex_id") -> DataFrame:
    """Rows of a stream dealt to all cores by key, for steps that cost more than the shuffle: a batch of few files has few tasks."""
    return rows.repartition(rows.sparkSession.sparkContext.defaultParallelism, key)


def run_batches(
    rows: DataFrame,
    step: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    pause_seconds: int | None = fixed.BATCH_PAUSE_SECONDS,
    file_format: str = "parquet",
) -> StreamingQuery:
    """Apply ``step`` to every batch and append to a folder of files, each row once.

    Batches start ``pause_seconds`` apart; with ``None`` all files there are now
    are worked off without a pause and the query ends.
    """
    writer = (
        step(rows).writeStream.format(file_format).option("path", out).option("checkpointLocation", checkpoint)
    )
    if file_format == "parquet":
        writer = writer.option("compression", "zstd")
    if pause_seconds is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{pause_seconds} seconds").start()
