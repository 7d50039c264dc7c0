"""Response bodies as a model service writes them: JSON texts read as VARIANT."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedloom.session import scratch
from seedloom.sources.files import store

#: Why a body or one of its choices gives no answer.
NOT_JSON, FAILED, NO_CHOICES, NO_CONTENT = "not JSON", "service error", "no choices", "no content"


def at(value: Column | str, path: str, kind: str = "string") -> Column:
    """What a variant holds at a path; null where the path or the type does not fit."""
    return F.try_variant_get(F.col(value) if isinstance(value, str) else value, path, kind)


def kind_of(value: Column) -> Column:
    """``STRING``, ``ARRAY<…>``, ``OBJECT<…>`` and so on; null for an absent value, ``VOID`` for a JSON null."""
    return F.schema_of_variant(value)


def content_text(content: Column) -> Column:
    """The text of a message's content: a string, or the texts of a list of parts one after another."""
    parts = F.transform(at(content, "$", "array<variant>"), lambda part: F.coalesce(at(part, "$.text"), F.lit("")))
    return F.when(kind_of(content) == "STRING", at(content, "$")).when(
        kind_of(content).startswith("ARRAY") & (F.size(parts) > 0), F.array_join(parts, "")
    )


def read_bodies(bodies: DataFrame, body: str = "body") -> DataFrame:
    """One row per choice of each body, and one per body without any: one narrow pass.

    The other columns stay; new are ``choice_idx``, ``content``, ``finish_reason`` and ``error``,
    null unless there is no answer. A body is a chat completion; it may lie in the ``response.body`` of
    a batch result line. ``choice_idx`` is the choice's ``index``, else its place in the list. Content
    is a string or a list of text parts; a completion without chat has it in ``text``. A list of
    choices may hold good and empty ones.

    A null or empty body, one that is no JSON object, and one too large for a variant (128 MB) are
    ``not JSON``. An ``error`` object is a service error, with its message after a colon.
    """
    kept = [name for name in bodies.columns if name != body]
    # In brackets, as the parser stops after the first value: text after it then is an error, or a second element.
    inside = F.try_parse_json(F.concat(F.lit("["), body, F.lit("]")))
    alone = F.size(F.try_variant_get(inside, "$", "array<variant>")) == 1
    parsed = bodies.withColumn("_line", F.when(alone, at(inside, "$[0]", "variant")))
    whole = F.coalesce(at("_line", "$.response.body", "variant"), F.col("_line"))
    parsed = parsed.withColumn("_body", whole).withColumn(
        "_object", F.coalesce(kind_of(F.col("_body")).startswith("OBJECT"), F.lit(False))
    )
    failure = F.coalesce(at("_body", "$.error", "variant"), at("_line", "$.error", "variant"))
    failed = F.coalesce(kind_of(failure) != "VOID", F.lit(False))
    message = F.coalesce(at(failure, "$.message"), at(failure, "$"), F.lit(""))
    choices = at("_body", "$.choices", "array<variant>")
    staged = parsed.select(
        *kept,
        F.when(~F.col("_object"), F.lit(NOT_JSON))
        .when(failed, F.concat(F.lit(f"{FAILED}: "), message))
        .when(F.coalesce(F.size(choices), F.lit(0)) < 1, F.lit(NO_CHOICES)).alias("_error"),
        choices.alias("_choices"),
    )
    exploded = staged.select(
        *kept, "_error", F.posexplode_outer(F.when(F.col("_error").isNull(), F.col("_choices"))).alias("_place", "_choice")
    )
    chat = content_text(at("_choice", "$.message.content", "variant"))
    content = F.coalesce(chat, at("_choice", "$.text"))
    read = exploded.withColumn("content", content)
    return read.select(
        *kept,
        F.coalesce(at("_choice", "$.index", "int"), F.col("_place")).alias("choice_idx"),
        "content",
        at("_choice", "$.finish_reason").alias("finish_reason"),
        F.coalesce("_error", F.when(F.col("content").isNull(), F.lit(NO_CONTENT))).alias("error"),
    )


class Responses(NamedTuple):
    """Answers for :func:`enrich.attach_completions`, and what gave none."""

    completions: DataFrame
    errors: DataFrame


def read_responses(bodies: DataFrame, key: str = "ex_id", body: str = "body", cut_off: bool = True) -> Responses:
    """Bodies ``(key, stage, body)`` as completions and errors, parsed once and stored.

    ``cut_off=False`` takes answers that stopped at the token limit (``finish_reason`` is ``length``)
    for errors as well.
    """
    rows = read_bodies(bodies.select(key, "stage", body), body)
    if not cut_off:
        cut = F.col("error").isNull() & (F.col("finish_reason") == "length")
        rows = rows.withColumn("error", F.when(cut, F.lit("cut off")).otherwise(F.col("error")))
    rows = store(rows, scratch(bodies.sparkSession, "responses"))
    good = rows.where(F.col("error").isNull()).select(key, "stage", "choice_idx", "content")
    return Responses(good, rows.where(F.col("error").isNotNull()).select(key, "stage", "choice_idx", "error"))
