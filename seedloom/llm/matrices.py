"""Sums of matrices that tasks make, added up in the cluster."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedloom.llm.frames import stored

#: Matrices added in one step.
FAN = 64
MATRIX = "part long, row int, entries array<double>"


def numbers(column: pa.Array, size: int) -> np.ndarray:
    """The vectors of an Arrow column as rows."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), size)


def matrix_rows(total: np.ndarray) -> pa.RecordBatch:
    """A task's matrix as rows of :data:`MATRIX`."""
    columns = [
        pa.array([TaskContext.get().partitionId()] * len(total), pa.int64()), pa.array(range(len(total)), pa.int32()),
        pa.array(list(total), pa.list_(pa.float64())),
    ]
    return pa.record_batch(columns, names=["part", "row", "entries"])


def added(parts: DataFrame, wide: int) -> np.ndarray:
    """The sum of matrices given as rows ``part, row, entries``; ``part`` numbers the matrices from 0.

    Added in the order of their numbers, so the same parts give the same sum to the last bit.
    """

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        total = np.zeros(wide)
        for entries in numbers(table.column("entries").combine_chunks(), wide):
            total += entries
        return table.slice(0, 1).set_column(2, "entries", pa.array([total], pa.list_(pa.float64())))

    parts = stored(parts, "matrices")
    while (last := parts.agg(F.max("part")).head()[0] or 0) > 0:
        grouped = parts.withColumn("block", F.floor(F.col("part") / FAN)).groupBy("block", "row")
        parts = grouped.applyInArrow(lambda table: add(table.select(["part", "row", "entries"])), MATRIX)
        parts = stored(parts.withColumn("part", F.floor(F.col("part") / FAN)), "matrices")
        if last < FAN:
            break
    rows = sorted(parts.collect(), key=lambda row: row["row"])
    return np.array([row["entries"] for row in rows]).reshape(-1, wide)
