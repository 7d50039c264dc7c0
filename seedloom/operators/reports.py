"""Counts and shares of every step, as small DataFrames."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from seedloom import fixed
from seedloom.functions.numbers import share
from seedloom.functions.text import default, text
from seedloom.sources.files import small_table

BLOCK = "█"


def levels_table(like: DataFrame, levels: tuple[str, ...] = fixed.LEVELS) -> DataFrame:
    """The fixed levels with their order (a handful of rows)."""
    rows = [(name, at) for at, name in enumerate(levels)]
    return small_table(like.sparkSession, rows, ("level", "ord"))


class Watched(NamedTuple):
    """Rows that are counted while they are written, and the counts once they are."""

    rows: DataFrame
    seen: Observation
    names: tuple[str, ...]

    def report(self) -> DataFrame:
        """The counts as a table of one row; waits for the first action on ``rows``."""
        found = self.seen.get
        return small_table(self.rows.sparkSession, [tuple(found[name] for name in self.names)], self.names)


def watched(df: DataFrame, **counts: Column) -> Watched:
    """The rows with counts that the next pass over them makes on its way, so a report costs none of its own.

    Counts are those of the finished tasks of a pass that writes its rows without a shuffle in
    between: a task that runs again counts once.
    """
    seen = Observation()
    return Watched(df.observe(seen, *[count.alias(name) for name, count in counts.items()]), seen, tuple(counts))


def kept_counts(condition: Column) -> dict[str, Column]:
    return {"rows_before": F.count(F.lit(1)), "rows_after": F.count_if(condition)}


def kept_ratio(df: DataFrame, condition: Column) -> DataFrame:
    """Rows before and after a filter and their ratio, in one pass over the unfiltered rows."""
    return with_ratio(df.agg(*[count.alias(name) for name, count in kept_counts(condition).items()]))


def with_ratio(counted: DataFrame) -> DataFrame:
    """``rows_before, rows_after`` with their ratio; of no rows it is null."""
    ratio = F.when(
        F.col("rows_before") > 0,
        F.col("rows_after").cast("double") / F.col("rows_before").cast("double"),
    )
    return counted.withColumn("kept", ratio)


def stratum_report(df: DataFrame, n: int, level: str = "complexity") -> DataFrame:
    """Rows a sample of ``n`` takes from each level before topping up, and rows there are."""
    counted = df.groupBy(default(level, fixed.UNKNOWN).alias("level")).agg(
        F.count(F.lit(1)).alias("available")
    )
    levels = counted.agg(F.count(F.lit(1))).scalar()
    quota = F.greatest(F.lit(1), F.floor(F.lit(n) / levels)).cast("long")
    return counted.select("level", F.least(quota, F.col("available")).alias("sampled"), "available")


def level_report(
    df: DataFrame, level: str = "complexity", width: int = 40, levels: tuple[str, ...] = fixed.LEVELS
) -> DataFrame:
    """Rows of each fixed level, zeros included, with a bar; other levels are not shown."""
    counted = df.groupBy(default(level, fixed.UNKNOWN).alias("level")).agg(F.count(F.lit(1)).alias("n"))
    shown = levels_table(df, levels).join(counted, "level", "left")
    shown = shown.select("ord", "level", F.coalesce("n", F.lit(0)).alias("n"))
    return _with_bar(shown, width).select("ord", "level", "n", "bar").orderBy("ord")


def _with_bar(counted: DataFrame, width: int) -> DataFrame:
    """Adds a bar of at most ``width`` signs, as a share of the largest ``n``."""
    largest = counted.agg(F.max("n")).scalar()
    signs = F.when(largest > 0, F.floor(F.col("n") * F.lit(width) / largest)).otherwise(0)
    return counted.withColumn("bar", F.repeat(F.lit(BLOCK), signs.cast("int")))


def generation_summary(enriched: DataFrame, top: int = 5) -> DataFrame:
    """Total, the most frequent domains, and rows per complexity: ``(section, label, n)``.

    Sections in this order, counts falling inside each; ties go by label. Domains and levels share one grouping of the data.
    """
    pairs = enriched.groupBy(
        default("domain", fixed.UNKNOWN).alias("domain"),
        default("complexity", fixed.UNKNOWN).alias("complexity"),
    ).agg(F.count(F.lit(1)).alias("n"))
    total = pairs.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n")).select(
        F.lit("total").alias("section"), F.lit("all").alias("label"), "n"
    )
    domains = (
        pairs.groupBy(F.col("domain").alias("label"))
        .agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "label")
        .limit(top)
    )
    levels = pairs.groupBy(F.col("complexity").alias("label")).agg(F.sum("n").alias("n"))
    rows = total.unionByName(domains.select(F.lit("domain").alias("section"), "label", "n")).unionByName(
        levels.select(F.lit("complexity").alias("section"), "label", "n")
    )
    place = F.array_position(F.array(*map(F.lit, ("total", "domain", "complexity"))), F.col("section"))
    return rows.orderBy(place, F.desc("n"), "label")


def split_sizes(split_df: DataFrame, splits: tuple[str, ...] = ("train", "eval", "test")) -> DataFrame:
    """Rows of each split, in their order; one without rows shows 0."""
    counted = split_df.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
    known = small_table(split_df.sparkSession, [(name, at) for at, name in enumerate(splits)], ("split", "ord"))
    return known.join(counted, "split", "left").orderBy("ord").select("split", F.coalesce("n", F.lit(0)).alias("n"))


def source_shares(train: DataFrame) -> DataFrame:
    """Rows and percentage per source, the most frequent first."""
    counted = train.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.withColumn(
        "pct", F.col("n").cast("double") / total.cast("double") * F.lit(100.0)
    ).orderBy(F.desc("n"), "source")


def complexity_bars(train: DataFrame, width: int = 40) -> DataFrame:
    """Rows per complexity with a bar, the most frequent first."""
    counted = train.groupBy("complexity").agg(F.count(F.lit(1)).alias("n"))
    return _with_bar(counted, width).orderBy(F.desc("n"), "complexity")


def thinking_share(train: DataFrame) -> DataFrame:
    """Rows with a reasoning text among all; null share where there are no rows."""
    counted = train.agg(
        F.count_if(text("thinking") != "").alias("with_thinking"), F.count(F.lit(1)).alias("n")
    )
    ratio = F.col("with_thinking").cast("double") / F.col("n").cast("double")
    return counted.withColumn("thinking_ratio", F.when(F.col("n") > 0, ratio))


def format_counts(corrupt: str | None = None) -> dict[str, Column]:
    """What :func:`format_stats` counts, by name."""
    good = F.col("valid") if corrupt is None else F.col("valid") & F.col(corrupt).isNull()
    return {
        "total": F.count(F.lit(1)),
        "converted": F.count_if(good),
        "skipped": F.count_if(~good),
        "with_thinking": F.count_if(good & F.col("has_thinking")),
    }


def format_stats(flagged: DataFrame, corrupt: str | None = None) -> DataFrame:
    """Total, converted, skipped and with-reasoning counts of flagged examples.

    ``corrupt`` names the column a lenient read keeps bad lines in; those count
    as skipped.
    """
    return flagged.agg(*[count.alias(name) for name, count in format_counts(corrupt).items()])


def eval_report(results: DataFrame) -> DataFrame:
    """Rows, exact match and execution accuracy overall and per complexity, in one rollup."""
    grouped = results.rollup("complexity").agg(
        F.grouping("complexity").alias("is_overall"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("exact_match")).alias("em"),
        F.count_if(F.col("execution_match")).alias("ex"),
    )
    return grouped.select(
        F.when(F.col("is_overall") == 1, F.lit("overall")).otherwise(F.col("complexity")).alias("level"),
        (F.col("is_overall") == 1).alias("is_overall"),
        "n",
        share(F.col("em"), F.col("n")).alias("exact_match"),
        share(F.col("ex"), F.col("n")).alias("execution_accuracy"),
    )


def ordered_report(report: DataFrame, levels: tuple[str, ...] = fixed.LEVELS, width: int = 20) -> DataFrame:
    """The per-level rows in the fixed order, levels outside it last, with a bar."""
    known = levels_table(report, levels)
    bar = F.repeat(F.lit(BLOCK), F.floor(F.col("execution_accuracy") * F.lit(float(width))).cast("int"))
    return (
        report.where(~F.col("is_overall"))
        .join(known, "level", "left")
        .select("ord", "level", "n", "exact_match", "execution_accuracy", bar.alias("bar"))
        .orderBy(F.col("ord").asc_nulls_last(), "level")
    )
