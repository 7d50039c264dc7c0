"""Training examples: expansion of enriched rows, final form of seed rows, chat rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedloom import fixed
from seedloom.functions import chat
from seedloom.functions.text import as_column, default, strip, text

COLUMNS = (
    "example_id", "question", "schema", "sql", "thinking",
    "complexity", "domain", "source", "quality_score",
)


def _example(
    source: str, keep: Column, question: str, schema: str, sql: str, thinking: Column, complexity: str
) -> Column:
    return F.struct(
        keep.alias("keep"),
        text(question).alias("question"),
        text(schema).alias("schema"),
        text(sql).alias("sql"),
        thinking.alias("thinking"),
        default(complexity, fixed.UNKNOWN).alias("complexity"),
        default("domain", fixed.UNKNOWN).alias("domain"),
        F.lit(source).alias("source"),
    )


def _some(*names: str) -> Column:
    condition = text(names[0]) != ""
    for name in names[1:]:
        condition = condition & (text(name) != "")
    return condition


def expand_enriched(enriched: DataFrame, key: str = "ex_id") -> DataFrame:
    """Up to three training examples per enriched row.

    The row itself with its reasoning, the harder version on the same schema, and
    the version on a new schema; rejected rows (negative score) give none. One
    narrow pass: the candidates are inlined from an array and the void ones dropped.
    The quality test is part of ``keep``: as a filter it would be pushed below the
    projection that computes the score and compute it twice.
    """
    quality = default("quality_score", fixed.DEFAULT_QUALITY)
    accepted = quality >= 0
    mocked = lambda name: text(name).startswith(fixed.MOCK_PREFIX)
    candidates = F.array(
        _example(
            fixed.WITH_REASONING, accepted & _some("question", "sql"),
            "question", "schema", "sql", text("reasoning_trace"), "complexity",
        ),
        _example(
            fixed.UPGRADED,
            accepted & _some("upgraded_question", "upgraded_sql") & ~mocked("upgraded_sql"),
            "upgraded_question", "schema", "upgraded_sql", F.lit(""), "upgraded_complexity",
        ),
        _example(
            fixed.VARIANT,
            accepted
            & _some("variant_question", "variant_sql", "variant_schema")
            & ~mocked("variant_sql"),
            "variant_question", "variant_schema", "variant_sql", F.lit(""), "complexity",
        ),
    )
    keys = [F.col(key).cast("string")]
    if "choice_idx" in enriched.columns:
        keys.append(F.col("choice_idx").cast("string"))
    expanded = enriched.select(
        F.concat_ws("/", *keys).alias("_row"), quality.alias("quality_score"), F.inline(candidates)
    )
    return expanded.where("keep").withColumn("example_id", F.concat_ws("/", "source", "_row")).select(*COLUMNS)


def seed_examples(seed_rows: DataFrame, key: str = "ex_id") -> DataFrame:
    """Seed rows in the form of training examples."""
    have = set(seed_rows.columns)

    def column(name: str) -> Column:
        return F.col(name) if name in have else F.lit(None)

    return seed_rows.select(
        F.concat(F.lit("seed/"), F.col(key).cast("string")).alias("example_id"),
        *[strip(column(name)).alias(name) for name in ("question", "schema", "sql", "thinking")],
        *[default(column(name), fixed.UNKNOWN).alias(name) for name in ("complexity", "domain", "source")],
        default(column("quality_score"), fixed.DEFAULT_QUALITY).cast("double").alias("quality_score"),
    )


#: The texts of an example that chat rows are made of, and their names once they are stripped.
STRIPPED = {name: f"_stripped_{name}" for name in ("question", "schema", "sql", "thinking")}
_QUESTION, _SCHEMA, _SQL, _THINKING = STRIPPED.values()


def stripped(examples: DataFrame) -> DataFrame:
    """Examples with their texts stripped in columns of their own: each is named many times further on, and made once."""
    return examples.withColumns({made: strip(name) for name, made in STRIPPED.items()})


def valid_messages(examples: DataFrame) -> DataFrame:
    """Examples with their ``messages``, null where an example is not valid."""
    messages = chat.chat_messages(*STRIPPED.values(), clean=as_column)
    made = F.when(chat.chat_valid(_QUESTION, _SCHEMA, _SQL, clean=as_column), messages)
    return stripped(examples).withColumn("messages", made).drop(*STRIPPED.values())


def flag_chat(examples: DataFrame) -> DataFrame:
    """Examples with ``valid`` and ``has_thinking``, as the format report counts them."""
    return examples.withColumns(
        {"valid": chat.chat_valid(), "has_thinking": chat.has_thinking("thinking")}
    )


def chat_rows(examples: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Valid examples as ``messages`` and ``_meta``; ``keep`` names columns to carry along."""
    messages = chat.chat_messages(*STRIPPED.values(), clean=as_column)
    meta = chat.chat_meta(thinking=_THINKING, clean=as_column)
    valid = stripped(examples).where(chat.chat_valid(_QUESTION, _SCHEMA, _SQL, clean=as_column))
    return valid.select(*keep, messages.alias("messages"), meta.alias("_meta"))
