"""Chat messages, prompts, request bodies and training texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from seedloom import fixed
from seedloom.functions.text import as_column, default, fill_prompt, fill_template, strip

Clean = Callable[[Column | str], Column]


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def user_turn(question: Column | str, schema: Column | str) -> Column:
    return fill_template(fixed.USER_TURN, schema=schema, question=question)


def has_thinking(thinking: Column | str, clean: Clean = strip) -> Column:
    return F.length(clean(thinking)) > fixed.THINKING_MIN_LEN


def assistant_turn(sql: Column | str, thinking: Column | str, clean: Clean = strip) -> Column:
    """The SQL, after its reasoning block where that is long enough to show."""
    reasoned = fill_template(fixed.THINK_TURN, thinking=clean(thinking), sql=clean(sql))
    return F.when(has_thinking(thinking, clean), reasoned).otherwise(clean(sql))


def chat_messages(
    question: Column | str = "question",
    schema: Column | str = "schema",
    sql: Column | str = "sql",
    thinking: Column | str = "thinking",
    clean: Clean = strip,
) -> Column:
    """System, user and assistant message of one training example.

    ``clean=as_column`` is for texts that are stripped already (``examples.stripped``).
    """
    system = F.when(has_thinking(thinking, clean), F.lit(fixed.CHAT_SYSTEM_THINKING)).otherwise(
        F.lit(fixed.CHAT_SYSTEM)
    )
    return F.array(
        message("system", system),
        message("user", user_turn(clean(question), clean(schema))),
        message("assistant", assistant_turn(sql, thinking, clean)),
    )


def chat_meta(
    complexity: Column | str = "complexity",
    domain: Column | str = "domain",
    source: Column | str = "source",
    thinking: Column | str = "thinking",
    clean: Clean = strip,
) -> Column:
    return F.struct(
        default(complexity, fixed.UNKNOWN).alias("complexity"),
        default(domain, fixed.UNKNOWN).alias("domain"),
        default(source, fixed.UNKNOWN).alias("source"),
        has_thinking(thinking, clean).alias("has_thinking"),
    )


def chat_valid(
    question: Column | str = "question",
    schema: Column | str = "schema",
    sql: Column | str = "sql",
    clean: Clean = strip,
) -> Column:
    """Question, schema and SQL are there, and the SQL is not a stub."""
    return (
        (clean(question) != "")
        & (clean(schema) != "")
        & (F.length(clean(sql)) >= fixed.CHAT_MIN_SQL_LEN)
    )


def inference_messages(
    question: Column | str = "question",
    schema: Column | str = "schema",
    system: str = fixed.EVAL_SYSTEM,
) -> Column:
    return F.array(
        message("system", F.lit(system)),
        message("user", user_turn(question, schema)),
    )


def serve_request(
    question: Column | str = "question",
    schema: Column | str = "schema",
    model: str = fixed.SERVE_MODEL,
    max_tokens: int = fixed.SERVE_MAX_TOKENS,
    temperature: float = fixed.SERVE_TEMPERATURE,
) -> Column:
    """JSON body of one completion request, ready for a batch inference file."""
    return F.to_json(
        F.struct(
            F.lit(model).alias("model"),
            inference_messages(question, schema, fixed.SERVE_SYSTEM).alias("messages"),
            F.lit(max_tokens).alias("max_tokens"),
            F.lit(temperature).alias("temperature"),
        )
    )


def stage_prompt(stage: str, columns: dict[str, Column | str] | None = None) -> Column:
    """Message array of one enrichment stage; ``columns`` renames its slots."""
    renamed = columns or {}
    slots = {name: renamed.get(name, name) for name in fixed.STAGES[stage][2]}
    return F.array(
        *[message(role, fill_prompt(body, **slots)) for role, body in fixed.PROMPTS[stage]]
    )


def turn_text(role: Column | str, content: Column | str, template: str = fixed.TURN_TEXT) -> Column:
    """One message in a model's chat markup (the default is ChatML)."""
    return fill_template(template, role=role, content=content)


def messages_text(
    messages: Column | str,
    template: str = fixed.TURN_TEXT,
    opening: str = "",
) -> Column:
    """All messages in chat markup; ``opening`` starts the answer to be generated.

    Null where there are no messages, so that a fallback can take over.
    """
    turns = F.transform(as_column(messages), lambda m: turn_text(m["role"], m["content"], template))
    joined = F.array_join(turns, "")
    return F.concat(joined, F.lit(opening)) if opening else joined


def raw_training_text(
    question: Column | str = "question",
    schema: Column | str = "schema",
    sql: Column | str = "sql",
) -> Column:
    return fill_template(fixed.RAW_TRAINING_TEXT, schema=schema, question=question, sql=sql)


def training_text(
    messages: Column | str = "messages",
    question: Column | str = "question",
    schema: Column | str = "schema",
    sql: Column | str = "sql",
    template: str = fixed.TURN_TEXT,
) -> Column:
    """Chat markup of the messages, or the raw layout where there are none."""
    return F.coalesce(
        messages_text(messages, template), raw_training_text(question, schema, sql)
    )
