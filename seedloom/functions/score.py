"""Heuristic scores of SQL texts and reasoning traces."""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from seedloom import fixed
from seedloom.functions.numbers import round_exactly
from seedloom.functions.text import strip, text

# Python's \b and \d spelled out, so that the result does not depend on the Java
# version. The look ahead at the first letter is for speed only; ſ is what
# case-insensitive matching takes for an s as well.
_WORD = r"[\p{L}\p{N}_]"


def _whole_words(words: tuple[str, ...]) -> str:
    return rf"(?<!{_WORD})(?iu:{'|'.join(words)})(?!{_WORD})"


KEYWORD_PATTERN = rf"(?=[SsſWwJjGgHhOo]){_whole_words(fixed.TRACE_KEYWORDS)}"
STEP_PATTERN = rf"(?=[SsſFfNnTt\p{{Nd}}])(?:{_whole_words(fixed.TRACE_STEPS)}|\p{{Nd}}++\.)"


def any_of(tests: list[Column]) -> Column:
    return reduce(operator.or_, tests)


def feature_count(sql: Column | str) -> Column:
    """How many SQL feature groups leave a mark in the text (0 to 6)."""
    return upper_feature_count(F.upper(text(sql)))


def upper_feature_count(upper: Column) -> Column:
    """The same of a text in upper case; the tests name it once per mark."""
    groups = [marks for marks in fixed.SQL_MARKS.values() if marks]
    return reduce(
        operator.add,
        [any_of([upper.contains(mark) for mark in marks]).cast("int") for marks in groups],
    )


def plausible_sql(sql: Column | str) -> Column:
    """Long enough, opens like a statement, balanced parentheses, no placeholder."""
    whole, bare = text(sql), strip(sql)
    upper = F.upper(bare)
    without_open = F.length(F.replace(whole, F.lit("("), F.lit("")))
    without_close = F.length(F.replace(whole, F.lit(")"), F.lit("")))
    return (
        (F.length(bare) >= fixed.MIN_PLAUSIBLE_LEN)
        & any_of([upper.startswith(word) for word in fixed.SQL_OPENERS])
        & (without_open == without_close)
        & ~any_of([whole.contains(word) for word in fixed.SQL_PLACEHOLDERS])
    )


def keyword_count(trace: Column | str) -> Column:
    return F.regexp_count(text(trace), F.lit(KEYWORD_PATTERN))


def step_count(trace: Column | str) -> Column:
    return F.regexp_count(text(trace), F.lit(STEP_PATTERN))


def long_enough(trace: Column | str) -> Column:
    return F.length(strip(trace)) >= fixed.TRACE_MIN_LEN


def trace_score(trace: Column | str) -> Column:
    """Length, SQL words and step words of a trace, each capped; 0 to 1."""
    return trace_points(
        long_enough(trace), F.length(text(trace)), keyword_count(trace), step_count(trace)
    )


def trace_points(long_enough: Column, length: Column, keywords: Column, steps: Column) -> Column:
    """The trace score out of its counts."""
    total = (
        F.least(F.lit(fixed.LENGTH_CAP), length.cast("double") / F.lit(float(fixed.LENGTH_DIVISOR)))
        + F.least(F.lit(fixed.KEYWORD_CAP), keywords.cast("double") * F.lit(fixed.KEYWORD_GAIN))
        + F.least(F.lit(fixed.STEP_CAP), steps.cast("double") * F.lit(fixed.STEP_GAIN))
    )
    return F.when(long_enough, F.least(F.lit(1.0), total)).otherwise(F.lit(0.0))


def upgrade_part(ok: Column, gain: Column) -> Column:
    return (
        F.when(~ok, F.lit(fixed.IMPLAUSIBLE))
        .when(gain > 0, F.lit(fixed.HARDER))
        .when(gain == 0, F.lit(fixed.EQUAL))
        .otherwise(F.lit(fixed.SIMPLER))
    )


def _question_part(question: Column | str) -> Column:
    long_enough = F.length(text(question)) > fixed.QUESTION_MIN_LEN
    return F.when(long_enough, F.lit(fixed.QUESTION_GAIN)).otherwise(F.lit(0.0))


def score_parts(
    sql: Column | str = "sql",
    upgraded_sql: Column | str = "upgraded_sql",
    variant_sql: Column | str = "variant_sql",
    upgraded_question: Column | str = "upgraded_question",
    variant_question: Column | str = "variant_question",
    reasoning_trace: Column | str = "reasoning_trace",
) -> tuple[Column, Column, Column, Column]:
    """The four parts of the overall score: upgrade, variant, questions, trace."""
    gain = feature_count(upgraded_sql) - feature_count(sql)
    return (
        upgrade_part(plausible_sql(upgraded_sql), gain),
        F.when(plausible_sql(variant_sql), F.lit(fixed.VARIANT_OK)).otherwise(F.lit(fixed.VARIANT_BAD)),
        _question_part(upgraded_question) + _question_part(variant_question),
        trace_score(reasoning_trace),
    )


def weigh(parts: tuple[Column, ...]) -> Column:
    """Weighted sum in double arithmetic, rounded to three places as Python rounds."""
    weighted = [part * F.lit(weight) for part, weight in zip(parts, fixed.WEIGHTS)]
    return round_exactly(reduce(operator.add, weighted), 3)


def quality_score(**columns: Column | str) -> Column:
    """The overall score of an enriched row; arguments as in :func:`score_parts`."""
    return weigh(score_parts(**columns))


def _thousandths(value: float) -> int:
    return round(value * 1000)


def weigh_exactly(
    parts: tuple[Column, ...], long_enough: Column, length: Column, keywords: Column, steps: Column
) -> Column:
    """The same score in whole thousandths, halves up: free of double arithmetic.

    ``parts`` are those before the trace, which is given by its counts. It
    differs from :func:`weigh` by 0.001, and only on ties.
    """
    milli = [F.rint(part * F.lit(1000.0)).cast("long") for part in parts]
    trace_milli = F.when(
        long_enough,
        F.least(F.lit(_thousandths(fixed.LENGTH_CAP)), length)
        + F.least(F.lit(_thousandths(fixed.KEYWORD_CAP)), keywords * F.lit(_thousandths(fixed.KEYWORD_GAIN)))
        + F.least(F.lit(_thousandths(fixed.STEP_CAP)), steps * F.lit(_thousandths(fixed.STEP_GAIN))),
    ).otherwise(F.lit(0))
    weights = [round(weight * 100) for weight in fixed.WEIGHTS]
    total = reduce(
        operator.add,
        [part * F.lit(weight) for part, weight in zip([*milli, trace_milli], weights)],
    )
    return F.floor((total + F.lit(50)) / F.lit(100)) / F.lit(1000.0)


def mark_rejected(score: Column, threshold: float = fixed.MIN_SCORE) -> Column:
    """Scores below the threshold become the reject mark; the row stays."""
    return F.when(score < F.lit(threshold), F.lit(fixed.REJECTED)).otherwise(score)
