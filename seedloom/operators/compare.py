"""Predictions against gold queries: alignment, exact match, result bags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedloom import fixed
from seedloom.functions.text import default, drop_reasoning, exact_match, text
from seedloom.session import scratch
from seedloom.sources.files import store


def align_predictions(
    tests: DataFrame, predictions: DataFrame, key: str = "ex_id", strip_reasoning: bool = True
) -> DataFrame:
    """Test rows with their prediction; a missing one is the empty string.

    Each test has one prediction at most: several would make several rows (``prepare.check_keys``).
    """
    answer = drop_reasoning("pred_sql") if strip_reasoning else text("pred_sql")
    return tests.join(predictions.select(key, answer.alias("pred_sql")), key, "left").select(
        key,
        text("question").alias("question"),
        text("schema").alias("schema"),
        text("sql").alias("gold_sql"),
        text("pred_sql").alias("pred_sql"),
        default("complexity", fixed.UNKNOWN).alias("complexity"),
    )


def align_by_position(tests: DataFrame, predictions: DataFrame, strip_reasoning: bool = True) -> DataFrame:
    """Tests and predictions without keys, both in order: the n-th prediction belongs to the n-th test.

    Both have a ``position`` (see ``files.with_positions``). Sides of unequal length are refused, as
    from the first missing row on every pair would be wrong.
    """
    sizes = tests.count(), predictions.count()
    if sizes[0] != sizes[1]:
        raise ValueError(f"{sizes[0]} tests and {sizes[1]} predictions have no common order")
    return align_predictions(tests, predictions, "position", strip_reasoning)


def with_exact_match(aligned: DataFrame) -> DataFrame:
    return aligned.withColumn("exact_match", exact_match("pred_sql", "gold_sql"))


def match_results(executions: DataFrame, key: str = "ex_id", empty_is_match: bool = True) -> DataFrame:
    """``(key, execution_match)`` from executions ``(key, side, ok, error, row_repr)``.

    Each side has one status row (``ok`` set) and one row per result row
    (``row_repr`` set). A pair matches when both sides ran and every row text
    occurs equally often on both. Counting per ``(key, row text)`` with partial
    sums comes first, so neither a huge result nor a row with very many copies
    has to fit in one task.
    """
    sign = F.when(F.col("side") == "pred", F.lit(1)).otherwise(F.lit(-1))
    is_row = F.col("row_repr").isNotNull()
    per_row = executions.groupBy(key, "row_repr").agg(
        F.sum(F.when(is_row, sign)).alias("surplus"),
        F.count_if(~F.col("ok")).alias("failed"),
        F.count_if(F.col("ok")).alias("ran"),
    )
    same = (
        (F.coalesce(F.max(F.abs("surplus")), F.lit(0)) == 0)
        & (F.sum("failed") == 0)
        & (F.sum("ran") == 2)
    )
    if not empty_is_match:
        same = same & (F.count("row_repr") > 0)
    return per_row.groupBy(key).agg(same.alias("execution_match"))


def row_sums(row: str, sign: Column) -> list[Column]:
    """A fingerprint of the difference of two bags of row texts: signed sums of the halves of two hashes of each, 128 bits and more.

    Sums don't depend on the order of rows, and what a row adds can't cancel another's. Halves keep
    the sums of two billion rows below 64 bits.
    """
    hashes = [F.xxhash64(F.lit(mark), row) for mark in ("first", "second")]
    halves = [half for h in hashes for half in (h.bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned(h, 32))]
    known = F.col(row).isNotNull()
    return [F.coalesce(F.sum(F.when(known, sign * half)), F.lit(0)).alias(f"_sum{i}") for i, half in enumerate(halves)]


def match_fingerprints(
    executions: DataFrame, key: str = "ex_id", empty_is_match: bool = True, verify: bool = False
) -> DataFrame:
    """What :func:`match_results` gives, by fingerprints of each side's rows.

    Row texts stay where they are: each task sums up its rows by key, those of the two sides with
    opposite signs, and only the sums travel. ``verify`` compares the rows of the pairs that agree as
    :func:`match_results` does; without it, two different results agree by chance with a probability
    below 2^-100.
    """
    sign = F.when(F.col("side") == "pred", F.lit(1)).otherwise(F.lit(-1))
    per_key = executions.groupBy(key).agg(
        F.coalesce(F.sum(F.when(F.col("row_repr").isNotNull(), sign)), F.lit(0)).alias("_surplus"),
        F.count("row_repr").alias("_rows"), *row_sums("row_repr", sign),
        F.count_if(~F.col("ok")).alias("_failed"), F.count_if(F.col("ok")).alias("_ran"),
    )
    same = (F.col("_failed") == 0) & (F.col("_ran") == 2)
    for name in ("_surplus", *(f"_sum{i}" for i in range(4))):
        same = same & (F.col(name) == 0)
    if not empty_is_match:
        same = same & (F.col("_rows") > 0)
    found = per_key.select(key, same.alias("execution_match"))
    if not verify:
        return found
    found = store(found, scratch(executions.sparkSession, "agreeing"))
    agreeing = found.where("execution_match").select(F.col(key).alias("_key"))
    # Keys are few bytes and unique: a task holds those and passes the rows by, unsorted.
    small = agreeing.hint("shuffle_hash")
    suspects = executions.join(small, F.col(key).eqNullSafe(F.col("_key")), "left_semi")
    return match_results(suspects, key, empty_is_match).unionByName(found.where(~F.col("execution_match")))


def with_execution_match(aligned: DataFrame, matched: DataFrame, key: str = "ex_id") -> DataFrame:
    """Every aligned row with ``execution_match``; false where nothing is known of its execution."""
    found = matched.select(key, F.col("execution_match").alias("_match"))
    joined = aligned.join(found, key, "left")
    return joined.withColumn("execution_match", F.coalesce("_match", F.lit(False))).drop("_match")


def bag_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows that occur more often on one side, with ``surplus`` = left count − right count."""
    columns = left.columns
    both = left.withColumn("_n", F.lit(1)).unionByName(right.withColumn("_n", F.lit(-1)))
    return (
        both.groupBy(*columns).agg(F.sum("_n").alias("surplus")).where(F.col("surplus") != 0)
    )


def bag_equal(left: DataFrame, right: DataFrame) -> bool:
    """True where both frames hold the same rows, each equally often."""
    return bag_difference(left, right).isEmpty()


def executions_from_tables(rows: DataFrame, status: DataFrame) -> DataFrame:
    """Result rows ``(ex_id, side, row_repr)`` and status rows ``(ex_id, side, ok, error)`` as one table."""
    return status.unionByName(rows, allowMissingColumns=True)
