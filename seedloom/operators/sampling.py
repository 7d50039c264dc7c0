"""Exact samples, level quotas, ratio mixing, ordered splits and batches.

All draws are seeded hash orders: the same seed gives the same rows on any
cluster, for any number of partitions, and after any lost executor.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seedloom import fixed
from seedloom.functions.keys import order_key, value_key
from seedloom.functions.text import default
from seedloom.operators.ranking import (
    KeyOrder,
    TooManyLevels,
    global_rank,
    level_rank,
    up_to,
    with_cut,
)
from seedloom.session import scratch
from seedloom.sources.files import store

# A table of this many hashes (about 20 MB) may be broadcast; a longer one is not.
BROADCAST_ROWS = 200_000
# Spark's own bound (windowGroupLimitThreshold) for keeping the first rows of groups before a shuffle.
GROUP_LIMIT = 1000


def exact_sample(df: DataFrame, n: int, key: str = "ex_id", seed: int = 42, purpose: str = "sample") -> DataFrame:
    """``min(n, rows)`` rows, uniformly, without replacement."""
    order = order_key(key, seed, purpose)
    return df.where(up_to(order, KeyOrder(df, order).cut(n)))


def shuffled(df: DataFrame, key: str = "ex_id", seed: int = 42) -> DataFrame:
    """All rows in a seeded random order (a range-partitioned sort), as the files written from them keep it."""
    return df.orderBy(order_key(key, seed, "shuffle"), key)


def exclude(
    pool: DataFrame,
    drawn: DataFrame,
    key: str = "ex_id",
    by: str = "key",
    columns: list[str] | None = None,
    drawn_rows: int | None = None,
) -> DataFrame:
    """Rows of ``pool`` that were not drawn.

    ``by="value"`` also takes away copies: rows equal to a drawn one in
    ``columns``, by default all but the key. The drawn side is reduced to
    distinct hashes first, and broadcast only if ``drawn_rows`` says it is small.
    """
    small = drawn_rows is not None and drawn_rows <= BROADCAST_ROWS
    if by == "key":
        keys = drawn.select(key)
        return pool.join(F.broadcast(keys) if small else keys, key, "left_anti")
    columns = columns or [name for name in pool.columns if name != key]
    values = drawn.select(value_key(*columns).alias("_value")).distinct()
    values = F.broadcast(values) if small else values
    return pool.withColumn("_value", value_key(*columns)).join(values, "_value", "left_anti").drop("_value")


def first_of_levels(keyed: DataFrame, quota: int) -> DataFrame:
    """The first ``quota`` rows by ``_key`` of each ``_level``, of narrow rows and for any number of levels.

    Each task keeps its own first rows of a level before anything is shuffled, so a level that holds
    a third of all rows sends no more than others. That holds for quotas Spark limits groups for;
    larger ones are found by numbering all rows in buckets.
    """
    if quota < GROUP_LIMIT:
        order = Window.partitionBy("_level").orderBy("_key")
        ranked = keyed.withColumn("_rank", F.row_number().over(order))
    else:
        ranked = level_rank(keyed, F.col("_key"), F.col("_level"), "_rank")
    return ranked.where(F.col("_rank") <= quota).drop("_rank", "_key", "_level")


def stratified_sample(
    df: DataFrame,
    n: int,
    level: str = "complexity",
    key: str = "ex_id",
    seed: int = 42,
    top_up_by: str = "value",
) -> DataFrame:
    """``n`` rows with equal quotas per level.

    Each level gives ``max(1, n // levels)`` rows or all it has. What is missing
    to ``n`` is drawn uniformly from the rest (see :func:`exclude` for
    ``top_up_by``); with more levels than ``n`` the draw is cut back to ``n``.
    The three draws use unrelated orders, so neither the rest nor the cut favours
    big levels.
    """
    by = default(level, fixed.UNKNOWN)
    first = order_key(key, seed, "level")
    try:
        order = KeyOrder(df, first, by)
        quota = max(1, n // max(1, len(order.sizes)))
        base = with_cut(df, order.cuts({name: [quota] for name in order.sizes}), by)
        taken = first <= F.col("_cut")
        drawn = sum(min(quota, size) for size in order.sizes.values())
    except TooManyLevels:
        quota = max(1, n // df.agg(F.count_distinct(by)).first()[0])
        keys = store(first_of_levels(df.select(key, by.alias("_level"), first.alias("_key")), quota), scratch(df.sparkSession, "firsts"))
        base = df.join(keys.select(key, F.lit(True).alias("_taken")), key, "left")
        taken = F.coalesce("_taken", F.lit(False))
        drawn = keys.count()
    sampled = base.where(taken)
    if drawn > n:
        sampled = exact_sample(sampled, n, key, seed, "cut back")
    elif drawn < n:
        second = order_key(key, seed, "top up")
        rest = base.where(~taken)
        if top_up_by == "key":
            extra = up_to(second, KeyOrder(rest, second).cut(n - drawn))
            sampled = base.where(taken | extra)
        else:
            # All columns are read and hashed once; what follows needs the keys only.
            columns = [name for name in df.columns if name != key]
            rest = exclude(rest, sampled, key, "value", columns, drawn).select(key)
            rest = store(rest, scratch(df.sparkSession, "rest"))
            extra = rest.where(up_to(second, KeyOrder(rest, second).cut(n - drawn)))
            extra = F.broadcast(extra) if n - drawn <= BROADCAST_ROWS else extra
            sampled = sampled.unionByName(base.join(extra, key, "left_semi"))
    return sampled.select(*df.columns)


def union_all(*parts: DataFrame) -> DataFrame:
    """Bag union by column name; absent columns read as null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


class Drawn(NamedTuple):
    """Rows of a mix, and the keys of the same rows in a stored table of their own."""

    rows: DataFrame
    keys: DataFrame


def _keys(df: DataFrame, key: str) -> DataFrame:
    return store(df.select(key), scratch(df.sparkSession, "keys"))


def draw_mix(
    seed_rows: DataFrame,
    synthetic_rows: DataFrame,
    seed_ratio: float = fixed.SEED_RATIO,
    synthetic_ratio: float = fixed.SYNTHETIC_RATIO,
    key: str = "example_id",
    seed: int = 42,
) -> Drawn:
    """Both kinds of rows in a ratio of their total number, each capped by what there is.

    The cap can skew the ratio: 2,000 seed and 2,250 synthetic rows give 1,700
    and 2,250. Without synthetic rows all seed rows are kept. Each input is passed over
    twice: once for its keys, in which all cuts are found, and once for the rows.
    """
    order = order_key(key, seed, "mix")
    synthetic_keys, seed_keys = _keys(synthetic_rows, key), _keys(seed_rows, key)
    synthetic = KeyOrder(synthetic_keys, order)
    if synthetic.size == 0:
        return Drawn(seed_rows, seed_keys)
    seeds = KeyOrder(seed_keys, order)
    total = seeds.size + synthetic.size
    of_seeds = up_to(order, seeds.cut(int(total * seed_ratio)))
    of_synthetic = up_to(order, synthetic.cut(int(total * synthetic_ratio)))
    return Drawn(
        union_all(seed_rows.where(of_seeds), synthetic_rows.where(of_synthetic)),
        union_all(seed_keys.where(of_seeds), synthetic_keys.where(of_synthetic)),
    )


def mix(seed_rows: DataFrame, synthetic_rows: DataFrame, *args, **kwargs) -> DataFrame:
    """The rows of :func:`draw_mix`."""
    return draw_mix(seed_rows, synthetic_rows, *args, **kwargs).rows


def _split(df: DataFrame, order: Column, counted: KeyOrder, train_ratio: float, eval_ratio: float) -> DataFrame:
    train = int(counted.size * train_ratio)
    evals = int(counted.size * eval_ratio)
    last_train, last_eval = counted.cuts({"": [train, train + evals]})[""]
    label = (
        F.when(up_to(order, last_train), F.lit("train"))
        .when(up_to(order, last_eval), F.lit("eval"))
        .otherwise(F.lit("test"))
    )
    return df.withColumn("split", label)


def split_rows(
    df: DataFrame,
    key: str = "example_id",
    seed: int = 42,
    train_ratio: float = fixed.TRAIN_RATIO,
    eval_ratio: float = fixed.EVAL_RATIO,
    keys: DataFrame | None = None,
) -> DataFrame:
    """A ``split`` column: the first share of the shuffled rows is train, then eval, then test.

    ``keys`` may give the same rows' keys in a table that is cheaper to read.
    """
    order = order_key(key, seed, "split")
    return _split(df, order, KeyOrder(df if keys is None else keys, order), train_ratio, eval_ratio)


def split_groups(
    df: DataFrame,
    group: str,
    seed: int = 42,
    train_ratio: float = fixed.TRAIN_RATIO,
    eval_ratio: float = fixed.EVAL_RATIO,
) -> DataFrame:
    """The same over distinct group values: rows of one group never part.

    The cuts are found on the distinct values, stored once; the rows are labelled
    by their group's key alone, so there is no join and a hot group does no harm.
    """
    order = order_key(F.coalesce(F.col(group).cast("string"), F.lit("")), seed, "split")
    groups = store(df.select(group).distinct(), scratch(df.sparkSession, "groups"))
    counted = KeyOrder(groups, order)
    return _split(df, order, counted, train_ratio, eval_ratio)


def assign_batches(
    df: DataFrame,
    size: int = fixed.BATCH_SIZE,
    key: str = "ex_id",
    seed: int = 42,
    rows: int | None = None,
) -> DataFrame:
    """A ``batch_idx`` column: shuffled rows in consecutive batches of ``size``."""
    ranked = global_rank(df, order_key(key, seed, "batch"), "_rank", rows)
    return ranked.withColumn("batch_idx", F.expr(f"(_rank - 1) div {int(size)}")).drop("_rank")
