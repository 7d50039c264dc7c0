"""The five steps, each from stored input to stored output and a report.

Where a step needs several passes over its rows (a draw, then a write, then
counts), it stores them once as Parquet in the scratch folder: the passes then
read single columns of that table and not the step's whole lineage.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial, reduce
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedloom import fixed
from seedloom.functions.chat import inference_messages
from seedloom.functions.text import filled
from seedloom.operators import compare, enrich, examples, prepare, reports, sampling
from seedloom.session import scratch
from seedloom.sources import files


def chain(df: DataFrame, *parts: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The frame after every part in turn; parts with arguments come as ``partial``."""
    return reduce(DataFrame.transform, parts, df)


def answer_chain(
    completions: DataFrame, score: bool = False, threshold: float = fixed.MIN_SCORE
) -> list[Callable[[DataFrame], DataFrame]]:
    """What happens to seed rows once their answers are there, as parts for :func:`chain`."""
    parts = [
        prepare.check_contract,
        prepare.check_keys,
        partial(enrich.attach_completions, completions=completions, keep_missing=False),
        enrich.required_fields,
    ]
    if score:
        parts.append(partial(enrich.score_enriched, threshold=threshold))
    return parts


class Prepared(NamedTuple):
    full: DataFrame
    sample: DataFrame
    kept: DataFrame
    levels: DataFrame


def prepare_seed(raw: DataFrame, n: int, out: str | None = None, seed: int = 42) -> Prepared:
    """Filter and normalise raw rows, draw ``n`` with equal shares per level.

    Rows need unique keys, ``ex_id``; see :func:`prepare.ensure_row_keys` for rows without.
    With ``out`` the two tables are written as JSON lines to ``seed_full`` and
    ``seed_sample`` below it.
    """
    spark = raw.sparkSession
    seen = reports.watched(raw, **reports.kept_counts(prepare.seed_quality()))
    full = files.store(prepare.normalize_seed(prepare.seed_filter(seen.rows)), scratch(spark, "seed-full"))
    prepare.check_keys(full)
    sample = files.store(sampling.stratified_sample(full, n, seed=seed), scratch(spark, "seed-sample"))
    if out:
        files.write_jsonl(full, f"{out}/seed_full")
        files.write_jsonl(sampling.shuffled(sample, seed=seed), f"{out}/seed_sample")
    return Prepared(full, sample, reports.with_ratio(seen.report()), reports.level_report(sample))


def request_completions(
    seed_rows: DataFrame, n: int | None = None, out: str | None = None, seed: int = 42
) -> DataFrame:
    """Prompts of all stages for ``n`` (or all) seed rows, for an inference service to answer."""
    rows = prepare.check_keys(prepare.check_contract(seed_rows))
    if n:
        rows = files.store(rows, scratch(rows.sparkSession, "seed-rows"))
        rows = sampling.exact_sample(rows, n, seed=seed, purpose="enrich")
    requests = enrich.stage_requests(rows)
    if out:
        files.write_jsonl(requests, out)
    return requests


class Enriched(NamedTuple):
    rows: DataFrame
    kept: DataFrame
    summary: DataFrame


def collect_completions(
    seed_rows: DataFrame,
    completions: DataFrame,
    out: str | None = None,
    score: bool = False,
) -> Enriched:
    """Seed rows with parsed answers, where the required fields are there.

    ``score=True`` also scores the rows and marks the poor ones, which
    ``build_examples`` then leaves out; without it they all count as good.
    Seed rows for which no request was made have no answer and drop out.
    """
    attached = enrich.attach_completions(prepare.check_keys(seed_rows), completions, keep_missing=False)
    complete = F.lit(True)
    for name in fixed.REQUIRED_FIELDS:
        complete = complete & filled(name)
    seen = reports.watched(attached, **reports.kept_counts(complete))
    attached = files.store(seen.rows, scratch(seed_rows.sparkSession, "attached"))
    rows = enrich.required_fields(attached)
    if score:
        rows = enrich.score_enriched(rows)
    if out:
        files.write_jsonl(rows, out)
    return Enriched(rows, reports.with_ratio(seen.report()), reports.generation_summary(rows))


class Mixed(NamedTuple):
    rows: DataFrame
    sizes: DataFrame
    sources: DataFrame
    levels: DataFrame
    thinking: DataFrame


def build_examples(
    seed_rows: DataFrame,
    enriched: DataFrame | None,
    out: str | None = None,
    seed_ratio: float = fixed.SEED_RATIO,
    synthetic_ratio: float = fixed.SYNTHETIC_RATIO,
    seed: int = 42,
    split_by: str | None = None,
) -> Mixed:
    """Mix seed and enriched rows by ratio, split them, and report on the training split.

    An original row can end up in another split than its copy with reasoning;
    ``split_by="question"`` keeps rows with the same question together. The written
    files hold their rows in a random order, as do the rows returned.
    """
    spark = seed_rows.sparkSession
    rows, keys = examples.seed_examples(seed_rows), None
    if enriched is not None:
        rows, keys = sampling.draw_mix(
            rows, examples.expand_enriched(enriched), seed_ratio, synthetic_ratio, seed=seed
        )
    prepare.check_keys(rows if keys is None else keys, "example_id")
    if split_by:
        rows = sampling.split_groups(files.store(rows, scratch(spark, "mixed")), split_by, seed=seed)
    else:
        rows = sampling.split_rows(rows, seed=seed, keys=keys)
    rows = files.store(sampling.shuffled(rows, "example_id", seed), scratch(spark, "shuffled"))
    if out:
        files.write_splits(rows, out)
    train = rows.where(F.col("split") == "train")
    return Mixed(
        rows,
        reports.split_sizes(rows),
        reports.source_shares(train),
        reports.complexity_bars(train),
        reports.thinking_share(train),
    )


class Formatted(NamedTuple):
    rows: DataFrame
    stats: DataFrame


def format_examples(rows: DataFrame, out: str | None = None, compression: str = "none") -> Formatted:
    """Examples as chat rows with the counts of what was kept.

    ``rows`` may come from a lenient read; its bad lines count as skipped. A
    ``split`` column is kept and makes one output folder per split. With ``out`` the
    rows are counted while they are written; ``compression`` is that of :func:`files.write_jsonl`.
    """
    corrupt = files.CORRUPT if files.CORRUPT in rows.columns else None
    keep = ("split",) if "split" in rows.columns else ()

    def formatted(flagged: DataFrame) -> DataFrame:
        return examples.chat_rows(flagged.where(F.col(corrupt).isNull()) if corrupt else flagged, keep)

    flagged = examples.flag_chat(rows)
    if not out:
        return Formatted(formatted(rows), reports.format_stats(flagged, corrupt))
    seen = reports.watched(flagged, **reports.format_counts(corrupt))
    (files.write_splits if keep else files.write_jsonl)(formatted(seen.rows), out, compression=compression)
    return Formatted(formatted(rows), seen.report())


def inference_requests(tests: DataFrame, key: str = "ex_id") -> DataFrame:
    """Messages to send to the model under test, one row per test example."""
    return tests.select(key, inference_messages().alias("messages"))


class Evaluated(NamedTuple):
    results: DataFrame
    report: DataFrame
    ordered: DataFrame


def evaluate(
    tests: DataFrame,
    predictions: DataFrame,
    result_rows: DataFrame,
    run_status: DataFrame,
    out: str | None = None,
    key: str = "ex_id",
    n: int | None = None,
    seed: int = 42,
    empty_is_match: bool = True,
) -> Evaluated:
    """Exact match and execution accuracy of predictions, overall and per complexity.

    Queries are run elsewhere, as models are: ``result_rows`` holds ``(key, side, row_repr)``
    and ``run_status`` ``(key, side, ok, error)`` (see :func:`compare.match_results`). Every
    test counts; one without a status on both sides is no execution match. A test has one prediction
    at most; repeated ones are refused. With ``out`` the report and the per-example table are written
    below it. Tests and predictions without keys are aligned by their order if both have a ``position``
    (``files.with_positions``), which then is the key of the other tables too.
    """
    spark = tests.sparkSession
    by_position = "position" in tests.columns and "position" in predictions.columns
    key = "position" if by_position else key
    prepare.check_keys(tests, key)
    prepare.check_keys(predictions, key)
    if n:
        tests = files.store(tests, scratch(spark, "tests"))
        tests = sampling.exact_sample(tests, n, key, seed, "evaluate")
    align = compare.align_by_position if by_position and not n else partial(compare.align_predictions, key=key)
    aligned = compare.with_exact_match(align(tests, predictions))
    executions = compare.executions_from_tables(result_rows, run_status)
    matched = compare.match_results(executions, key, empty_is_match)
    results = files.store(compare.with_execution_match(aligned, matched, key), scratch(spark, "results"))
    report = reports.eval_report(results)
    if out:
        files.write_report(report, f"{out}/report")
        results.write.mode("overwrite").parquet(f"{out}/examples")
    return Evaluated(results, report, reports.ordered_report(report))
