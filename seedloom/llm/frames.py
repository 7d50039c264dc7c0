"""What the operators share: reading tables, free column names, stored steps."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from seedloom.session import scratch


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, in the partitions its files make."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(df: DataFrame, wanted: str) -> str:
    """``wanted``, lengthened until no column of the frame has that name in any case."""
    taken = {column.lower() for column in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def with_new(df: DataFrame, wanted: str, column) -> tuple[DataFrame, str]:
    """The frame with ``column`` under a name it did not have before, and that name."""
    name = free_name(df, wanted)
    return df.withColumn(name, column), name


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared scratch folder and read back: later steps start from files."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bytes of texts that Spark hands to a Python worker at once, where a step bounds them.
BATCH_BYTES = 4 << 20


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Within it, steps that run hand their texts to Python in small Arrow batches; the caller's setting comes back.

    By default a batch has up to 64 MB: the executor holds one, the Python worker that and the next.
    """
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def quoted(columns: Iterable[str]) -> list[str]:
    """Names as column references, whatever characters they hold."""
    return ["`" + column.replace("`", "``") + "`" for column in columns]


#: Bytes of results a task gathers before it hands them on.
PART_BYTES = 4 << 20


def in_parts(batches: Iterator[pa.Array], result: Callable, kind: pa.DataType) -> Iterator[pa.Array]:
    """The results of an Arrow function of one column, in arrays of a few megabytes.

    ``result`` gives text, bytes or None for one value. Input batches may be much larger,
    and so would be the results of one.
    """
    for batch in batches:
        part, size = [], 0
        for value in batch:
            found = result(value.as_py())
            part.append(found)
            size += len(found or "")
            if size >= PART_BYTES:
                yield pa.array(part, kind)
                part, size = [], 0
        if part:
            yield pa.array(part, kind)
