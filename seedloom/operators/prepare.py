"""Seed rows: quality filter, normal form, required columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedloom import fixed
from seedloom.functions.keys import value_key
from seedloom.functions.score import any_of
from seedloom.functions.text import default, strip, text
from seedloom.operators.ranking import value_rank
from seedloom.sources.files import store


def seed_quality(
    sql: str = "sql",
    context: str = "sql_context",
    prompt: str = "sql_prompt",
    sql_length: tuple[int, int] = (fixed.MIN_SQL_LEN, fixed.MAX_SQL_LEN),
    max_context: int = fixed.MAX_CONTEXT_LEN,
    min_prompt: int = fixed.MIN_PROMPT_LEN,
    context_mark: str = fixed.CONTEXT_MARK,
    bad_words: tuple[str, ...] = fixed.SEED_BAD_WORDS,
) -> Column:
    """Condition of a usable raw row; lengths are taken before stripping."""
    return (
        F.length(text(sql)).between(*sql_length)
        & (F.length(text(context)) <= max_context)
        & (F.length(text(prompt)) >= min_prompt)
        & F.upper(text(context)).contains(context_mark)
        & ~any_of([text(sql).contains(word) for word in bad_words])
    )


def seed_filter(raw: DataFrame, **bounds) -> DataFrame:
    return raw.where(seed_quality(**bounds))


def normalize_seed(raw: DataFrame, source: str = fixed.SEED_SOURCE, split: str = fixed.SEED_SPLIT) -> DataFrame:
    """Raw rows under the names and defaults the other operators use."""
    return raw.select(
        "ex_id",
        strip("sql_prompt").alias("question"),
        strip("sql_context").alias("schema"),
        strip("sql").alias("sql"),
        strip("sql_explanation").alias("explanation"),
        default("domain", fixed.UNKNOWN).alias("domain"),
        default("sql_complexity", fixed.UNKNOWN).alias("complexity"),
        default("sql_task_type", fixed.DEFAULT_TASK_TYPE).alias("task_type"),
        F.lit(source).alias("source"),
        F.lit(split).alias("split"),
    )


def check_contract(
    df: DataFrame,
    columns: tuple[str, ...] = fixed.REQUIRED_COLUMNS,
    min_samples: int = fixed.MIN_SAMPLES,
) -> DataFrame:
    """The frame itself, or ValueError where a column or too many rows are missing; see also :func:`check_keys`."""
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    if df.limit(min_samples).count() < min_samples:
        raise ValueError(f"fewer than {min_samples} rows")
    return df


def check_keys(df: DataFrame, key: str = "ex_id") -> DataFrame:
    """The frame itself, or ValueError where a key is null or given twice.

    Draws take the rows up to a key, so their sizes are exact only for unique keys. One
    pass over the key column.
    """
    counted = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    found = counted.agg(
        F.coalesce(F.sum(F.when(F.col(key).isNull(), F.col("n"))), F.lit(0)).alias("nulls"),
        F.count_if(F.col(key).isNotNull() & (F.col("n") > 1)).alias("repeated"),
    ).first()
    if found.nulls or found.repeated:
        raise ValueError(f"{key}: {found.nulls} rows without a key, {found.repeated} keys given more than once")
    return df


def with_row_keys(df: DataFrame, path: str, key: str = "ex_id") -> DataFrame:
    """The rows with keys 1, 2, … in the order of a hash of their values, stored at ``path``.

    The numbers depend on the values alone, not on files, partitions or the cluster: equal
    rows get neighbouring numbers, and which of them gets which makes no difference.
    """
    ranked = value_rank(df, value_key(*df.columns), "_key")
    return store(ranked.select(F.col("_key").alias(key), *df.columns), path)


def ensure_row_keys(df: DataFrame, path: str, key: str = "ex_id") -> DataFrame:
    """The rows as they are where all have a key, with new keys stored at ``path`` where none has.

    Input with keys in some rows only is refused: new ones could meet those given, and
    numbering anew would part rows from what was made for them.
    """
    if key not in df.columns:
        return with_row_keys(df, path, key)
    found = df.agg(F.count(F.lit(1)).alias("rows"), F.count(key).alias("keyed")).first()
    if found.keyed == found.rows:
        return df
    if found.keyed:
        raise ValueError(f"{found.rows - found.keyed} of {found.rows} rows have no {key}")
    kind = df.schema[key].dataType
    keyed = with_row_keys(df.drop(key), path, key)
    return keyed.withColumn(key, F.col(key).cast(kind))
