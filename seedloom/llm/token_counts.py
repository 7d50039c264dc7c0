"""Token counts of whole texts by a two-tier lookup on the map side.

Text is cut at single spaces between other characters; such a unit is one pre-token
or a few whole ones, and its number of tokens does not depend on its neighbours. The
first tier is a table of the corpus's most frequent units and their lengths, broadcast
to every task. Units outside it go through the second tier, a cache in each worker that
encodes what it has not seen. No unit is shuffled: the frequent units come from a
heavy-hitter sketch over all texts, of which each task sends one of fixed size; sketches are
merged by 64 at a time until one is left. The table changes only the time, never a count.
Very long texts are cut at their spaces like all others.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedloom.llm.bpe import Unsafe, codec
from seedloom.llm.frames import stored, with_new

#: Units in the broadcast table, and counters in a task's sketch (about 16 bytes of text each).
FREQUENT, TRACKED = 4096, 16384
#: Longest unit in the table, in characters; sketches merged in one step.
LONGEST, FAN = 64, 64


def frequent_units(df: DataFrame, text: str = "text", n: int = FREQUENT, tracked: int = TRACKED) -> list[str]:
    """The most frequent units of all texts, at most ``n``, each at most 64 characters."""
    units = df.select(F.explode(F.split(F.col(text).cast("string"), " ")).alias("unit"))
    units = units.where((F.length("unit") > 0) & (F.length("unit") <= LONGEST))
    sketches = units.groupBy(F.spark_partition_id().cast("long").alias("part")).agg(
        F.expr(f"approx_top_k_accumulate(unit, {tracked})").alias("sketch")
    )
    sketches = stored(sketches, "sketches")
    while (sketches.agg(F.max("part")).head()[0] or 0) > 0:
        merged = F.expr(f"approx_top_k_combine(sketch, {tracked})").alias("sketch")
        sketches = stored(sketches.groupBy(F.floor(F.col("part") / FAN).alias("part")).agg(merged), "sketches")
    found = sketches.select(F.expr(f"approx_top_k_estimate(sketch, {n})").alias("top")).head()
    return [row["item"] for row in found["top"] or []] if found else []


def pack_table(lengths: dict[str, int]) -> tuple[bytes, bytes]:
    """Units and lengths as two buffers: a hash table of it is built once per worker."""
    return "\n".join(lengths).encode("utf-8"), bytes(lengths.values())


def unpack_table(table: tuple[bytes, bytes]) -> dict[str, int]:
    units, lengths = table
    return dict(zip(units.decode("utf-8").split("\n"), lengths)) if lengths else {}


class TokenCounter:
    """Counts by the broadcast table first and by the worker's codec otherwise."""

    def __init__(self, path: str, table: tuple[bytes, bytes]):
        self.codec = codec(path)
        self.table = unpack_table(table)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        own, frequent = self.codec, self.table.get
        if own.has_special(text):
            return len(own.encode(text)) // 4
        units = text.split(" ")
        try:
            total = len(own.first[units[0]])
            lengths = list(map(frequent, units))
            lengths[0] = 0
            missed = [unit for unit, length in zip(units, lengths) if length is None]
            total += sum(map(len, map(own.spaced.__getitem__, missed)))
            return total // 4 + sum(filter(None, lengths))
        except Unsafe:
            return len(own.encode(text)) // 4


def count_tokens(df: DataFrame, path: str, text: str = "text", out: str = "n_tokens") -> DataFrame:
    """The rows with the number of tokens of their text.

    A null or empty text has none; special strings count as one token each; repeated
    rows stay; an empty frame gives an empty frame. A column named like ``out`` is
    replaced, others pass unchanged.
    """
    spark, own = df.sparkSession, codec(path)
    lengths = {}
    for unit in frequent_units(df, text):
        try:
            size = len(own.spaced[unit]) // 4
        except Unsafe:
            continue
        if "\n" not in unit and size < 256 and not own.has_special(unit):
            lengths[unit] = size
    table = spark.sparkContext.broadcast(pack_table(lengths))

    @F.arrow_udf("long")
    def counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        counter = TokenCounter(path, table.value)
        for texts in batches:
            yield pa.array([counter.count(text.as_py()) for text in texts], pa.int64())

    found, name = with_new(df, "counted", counted(F.col(text).cast("string")))
    return found.withColumn(out, F.col(name)).drop(name)
