"""The functions under SQL names, for ``spark.sql`` users: scalar ones, and table functions for what makes rows.

They are temporary SQL functions: Catalyst puts their bodies in place, so a query
that uses them has the plan of the same expressions written out. Table functions are
joined laterally: ``FROM rows, LATERAL training_examples(…)``.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from seedloom import fixed
from seedloom.functions import score
from seedloom.functions.text import THINK_BLOCK, WHITESPACE, WHITESPACE_RUN, tag_pattern


def quoted(value: str) -> str:
    """A raw string literal of Spark SQL, in whichever quotes the value leaves free."""
    mark = "'" if "'" not in value else '"'
    if mark in value:
        raise ValueError("value holds both kinds of quotes")
    return f"r{mark}{value}{mark}"


def _mark_test(column: str, marks: tuple[str, ...]) -> str:
    return "(" + " OR ".join(f"contains({column}, {quoted(mark)})" for mark in marks) + ")"


def _trace_score() -> str:
    parts = " + ".join(
        (
            f"least({fixed.LENGTH_CAP}D, CAST(length(coalesce(trace, '')) AS DOUBLE) / {float(fixed.LENGTH_DIVISOR)}D)",
            f"least({fixed.KEYWORD_CAP}D, CAST(trace_keywords(trace) AS DOUBLE) * {fixed.KEYWORD_GAIN}D)",
            f"least({fixed.STEP_CAP}D, CAST(trace_steps(trace) AS DOUBLE) * {fixed.STEP_GAIN}D)",
        )
    )
    # A factor and not a branch: Spark evaluates a repeated expression once only where it stands outside of branches.
    return f"least(1.0D, {parts}) * CASE WHEN length(py_strip(trace)) >= {fixed.TRACE_MIN_LEN} THEN 1.0D ELSE 0.0D END"


def _weighted() -> str:
    """The four parts of the overall score with their weights, added from left to right."""

    def question(name: str) -> str:
        long_enough = f"length(coalesce({name}, '')) > {fixed.QUESTION_MIN_LEN}"
        return f"CASE WHEN {long_enough} THEN {fixed.QUESTION_GAIN}D ELSE 0.0D END"

    gain = "sql_feature_count(upgraded_sql) - sql_feature_count(sql_text)"
    # Looked up by the sign of the gain, which so is named once and outside of branches.
    upgrades = ", ".join(f"{value}D" for value in (fixed.IMPLAUSIBLE, fixed.SIMPLER, fixed.EQUAL, fixed.HARDER))
    parts = (
        f"element_at(array({upgrades}), 1 + CAST(plausible_sql(upgraded_sql) AS INT) * (2 + CAST(sign({gain}) AS INT)))",
        f"CASE WHEN plausible_sql(variant_sql) THEN {fixed.VARIANT_OK}D ELSE {fixed.VARIANT_BAD}D END",
        f"{question('upgraded_question')} + {question('variant_question')}",
        "trace_score(trace)",
    )
    return " + ".join(f"({part}) * {weight}D" for part, weight in zip(parts, fixed.WEIGHTS))


def definitions() -> dict[str, tuple[str, str, str]]:
    """name -> (parameters, return type, body)."""
    spaces = "concat(" + ", ".join(f"chr({ord(c)})" for c in WHITESPACE if ord(c) < 256) + ", " + ", ".join(
        f"'\\u{ord(c):04x}'" for c in WHITESPACE if ord(c) >= 256
    ) + ")"
    features = " + ".join(
        f"CAST({_mark_test('upper(coalesce(sql_text, ' + quoted('') + '))', marks)} AS INT)"
        for marks in fixed.SQL_MARKS.values()
        if marks
    )
    openers = " OR ".join(
        f"startswith(upper(py_strip(sql_text)), {quoted(word)})" for word in fixed.SQL_OPENERS
    )
    return {
        "py_strip": ("value STRING", "STRING", f"btrim(coalesce(value, ''), {spaces})"),
        "canonical_sql": (
            "sql_text STRING", "STRING",
            f"rtrim(';', regexp_replace(lower(py_strip(sql_text)), {quoted(WHITESPACE_RUN)}, ' '))",
        ),
        "drop_reasoning": (
            "answer STRING", "STRING",
            f"py_strip(regexp_replace(coalesce(answer, ''), {quoted(THINK_BLOCK)}, ''))",
        ),
        "tagged": (
            "content STRING, tag STRING", "STRING",
            "py_strip(regexp_extract(coalesce(content, ''), "
            r"concat(r'(?s)\[', tag, r'\](.*?)\[/', tag, r'\]'), 1))",
        ),
        "sql_feature_count": ("sql_text STRING", "INT", features),
        "plausible_sql": (
            "sql_text STRING", "BOOLEAN",
            f"length(py_strip(sql_text)) >= {fixed.MIN_PLAUSIBLE_LEN} AND ({openers}) "
            "AND length(replace(sql_text, '(', '')) = length(replace(sql_text, ')', '')) "
            f"AND NOT {_mark_test('sql_text', fixed.SQL_PLACEHOLDERS)}",
        ),
        "trace_keywords": (
            "trace STRING", "INT",
            f"regexp_count(coalesce(trace, ''), {quoted(score.KEYWORD_PATTERN)})",
        ),
        "trace_steps": (
            "trace STRING", "INT",
            f"regexp_count(coalesce(trace, ''), {quoted(score.STEP_PATTERN)})",
        ),
        "trace_score": ("trace STRING", "DOUBLE", _trace_score()),
        "quality_score": (
            "sql_text STRING, upgraded_sql STRING, variant_sql STRING, upgraded_question STRING, "
            "variant_question STRING, trace STRING", "DOUBLE",
            f"CAST(replace(format_number({_weighted()}, 3), ',', '') AS DOUBLE)",
        ),
    }


def _candidate(source: str, keep: str, question: str, schema: str, sql: str, thinking: str, complexity: str) -> str:
    values = {
        "keep": keep, "example_id": f"concat_ws('/', {quoted(source)}, row_key)", "question": f"coalesce({question}, '')", "schema": f"coalesce({schema}, '')", "sql": f"coalesce({sql}, '')",
        "thinking": thinking, "complexity": f"coalesce({complexity}, {quoted(fixed.UNKNOWN)})",
        "domain": f"coalesce(of_domain, {quoted(fixed.UNKNOWN)})", "source": quoted(source),
        "quality_score": f"coalesce(score, {fixed.DEFAULT_QUALITY}D)",
    }
    return f"named_struct({', '.join(f'{quoted(name)}, {value}' for name, value in values.items())})"


def _expansion() -> str:
    """Up to three examples of an enriched row, as :func:`seedloom.operators.examples.expand_enriched` makes them."""

    def some(*names: str) -> str:
        return " AND ".join(["accepted", *(f"coalesce({name}, '') <> ''" for name in names)])

    def real(name: str) -> str:
        return f" AND NOT startswith(coalesce({name}, ''), {quoted(fixed.MOCK_PREFIX)})"

    accepted = f"coalesce(score, {fixed.DEFAULT_QUALITY}D) >= 0"
    candidates = (
        _candidate(fixed.WITH_REASONING, some("of_question", "of_sql"), "of_question", "of_schema", "of_sql", "coalesce(trace, '')", "of_complexity"),
        _candidate(
            fixed.UPGRADED, some("upgraded_question", "upgraded_sql") + real("upgraded_sql"), "upgraded_question", "of_schema",
            "upgraded_sql", "''", "upgraded_complexity",
        ),
        _candidate(
            fixed.VARIANT, some("variant_question", "variant_sql", "variant_schema") + real("variant_sql"), "variant_question",
            "variant_schema", "variant_sql", "''", "of_complexity",
        ),
    )
    made = f"array({', '.join(candidates)})".replace("accepted", accepted)
    columns = "example_id, question, schema, sql, thinking, complexity, domain, source, quality_score"
    return f"SELECT {columns} FROM inline(filter({made}, made -> made.keep))"


def table_definitions() -> dict[str, tuple[str, str, str]]:
    """name -> (parameters, columns, query).

    A query is a projection of one generator, whose conditions lie in its array: Spark turns that into a
    generator over the joined rows, and anything more into a join with them.
    """
    fields = ", ".join(
        f"named_struct('name', {quoted(column)}, 'value', CASE WHEN stage = {quoted(stage)} "
        f"THEN regexp_extract(coalesce(content, ''), {quoted(tag_pattern(tag))}, 1) END)"
        for stage, (_, _, _, parsers) in fixed.STAGES.items()
        for column, tag in parsers.items()
    )
    return {
        "tagged_texts": (
            "content STRING, tag STRING", "pos INT, body STRING",
            "SELECT pos, py_strip(col) FROM posexplode(regexp_extract_all(coalesce(content, ''), "
            r"concat(r'(?s)\[', tag, r'\](.*?)\[/', tag, r'\]'), 1))",
        ),
        "answer_fields": (
            "stage STRING, content STRING", "field STRING, value STRING",
            f"SELECT name, py_strip(value) FROM inline(filter(array({fields}), f -> f.value IS NOT NULL))",
        ),
        "training_examples": (
            "row_key STRING, of_question STRING, of_schema STRING, of_sql STRING, of_complexity STRING, of_domain STRING, "
            "trace STRING, upgraded_question STRING, upgraded_sql STRING, upgraded_complexity STRING, variant_schema STRING, "
            "variant_question STRING, variant_sql STRING, score DOUBLE",
            "example_id STRING, question STRING, schema STRING, sql STRING, thinking STRING, complexity STRING, domain STRING, "
            "source STRING, quality_score DOUBLE",
            _expansion(),
        ),
    }


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create or replace the functions in the session; returns their names."""
    made = definitions() | {
        name: (parameters, f"TABLE ({columns})", query) for name, (parameters, columns, query) in table_definitions().items()
    }
    for name, (parameters, returns, body) in made.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {returns} RETURN {body}")
    return list(made)
