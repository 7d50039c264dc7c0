"""Answers that arrive while requests still go out: a stream joined with a stream."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What makes two answers the same delivery: a service, or the reader of its log, may send one twice.
SLOT = ("ex_id", "stage", "choice_idx")


@dataclass(frozen=True)
class Waiting:
    """How long answers may take, and how much out of order rows may come; state is kept that long."""

    timeout: str = "1 hour"
    disorder: str = "10 minutes"


def answered(sent: Column, came: Column, timeout: str) -> Column:
    """Whether an answer came after its request and in time."""
    return (came >= sent) & (came <= sent + F.expr(f"INTERVAL {timeout}"))


def first_deliveries(answers: DataFrame, waiting: Waiting = Waiting(), slot: tuple[str, ...] = SLOT) -> DataFrame:
    """A stream of answers without further deliveries of the same slot; of several one stays.

    Deliveries of a slot more than a timeout apart are two answers, in a stream as in a table.
    """
    return answers.withWatermark("came_at", waiting.disorder).dropDuplicatesWithinWatermark(list(slot))


def join_answers(requests: DataFrame, answers: DataFrame, waiting: Waiting = Waiting(), key: str = "ex_id") -> DataFrame:
    """Requests ``(key, stage, sent_at, …)`` with their answers ``(key, stage, choice_idx, content, came_at)``.

    One row per request and answer in time; a request without any has one row with null answer
    columns, which a stream gives out once no answer in time can come any more. Both frames are
    streams, or both tables: the rows are the same, as long as no row comes later than
    ``waiting.disorder`` behind the latest before it. State holds requests and answers of the last
    ``timeout`` and ``disorder`` only. Rows without a key, a stage or a time match nothing.
    """
    if requests.isStreaming:
        requests = requests.withWatermark("sent_at", waiting.disorder)
        if "came_at" not in _watermarked(answers):
            answers = answers.withWatermark("came_at", waiting.disorder)
    found = answers.select(F.col(key).alias("_of"), F.col("stage").alias("_stage"), "choice_idx", "content", "came_at")
    same = (F.col(key) == F.col("_of")) & (F.col("stage") == F.col("_stage"))
    joined = requests.join(found, same & answered(F.col("sent_at"), F.col("came_at"), waiting.timeout), "left_outer")
    return joined.drop("_of", "_stage")


def _watermarked(df: DataFrame) -> set[str]:
    """The columns that have a watermark already: a second one on top would be an error."""
    return {field.name for field in df.schema.fields if "spark.watermarkDelayMs" in (field.metadata or {})}
