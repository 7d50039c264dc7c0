"""Command line: ``spark-submit`` or ``python -m seedloom <step> …``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedloom import fixed
from seedloom.operators import enrich, prepare, responses
from seedloom.plans import steps
from seedloom.session import build_session, scratch
from seedloom.sources import files

BODY_SCHEMA = "ex_id long, stage string, body string"
COMPLETION_SCHEMA = "ex_id long, stage string, choice_idx int, content string"
PREDICTION_SCHEMA = "example_id string, pred_sql string"
RESULT_SCHEMA = "example_id string, side string, row_repr string"
STATUS_SCHEMA = "example_id string, side string, ok boolean, error string"


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="seedloom", description=__doc__)
    parser.add_argument("--seed", type=int, default=42)
    step = parser.add_subparsers(dest="step", required=True)

    command = step.add_parser("prepare", help="filter and sample raw seed rows")
    command.add_argument("--raw", required=True, help="Parquet or JSON lines table")
    command.add_argument("--split", help="keep rows of this split only")
    command.add_argument("--out", required=True)
    command.add_argument("--n-samples", type=int, default=2000)

    command = step.add_parser("request", help="write the prompts of the enrichment")
    command.add_argument("--seed-rows", required=True)
    command.add_argument("--out", required=True)
    command.add_argument("--n-samples", type=int)
    command.add_argument("--dry-run", action="store_true", help="write mock answers for a few rows instead")

    command = step.add_parser("enrich", help="attach completions to seed rows")
    command.add_argument("--seed-rows", required=True)
    answers = command.add_mutually_exclusive_group(required=True)
    answers.add_argument("--completions", help="JSON lines of key, stage, choice_idx and content")
    answers.add_argument("--responses", help="JSON lines of key, stage and the body a service sent, as text")
    command.add_argument("--errors", help="where bodies without an answer go, with --responses")
    command.add_argument("--out", required=True)
    command.add_argument("--score", action="store_true")

    command = step.add_parser("mix", help="mix, split and report")
    command.add_argument("--seed-rows", required=True)
    command.add_argument("--enriched")
    command.add_argument("--out", required=True)
    command.add_argument("--seed-ratio", type=float, default=fixed.SEED_RATIO)
    command.add_argument("--synthetic-ratio", type=float, default=fixed.SYNTHETIC_RATIO)
    command.add_argument("--split-by")

    command = step.add_parser("format", help="chat rows")
    command.add_argument("--input", required=True)
    command.add_argument("--output", required=True)

    command = step.add_parser("evaluate", help="exact match and execution accuracy")
    command.add_argument("--tests", required=True)
    command.add_argument("--predictions", required=True)
    command.add_argument("--result-rows", required=True, help="rows that gold and predicted queries gave")
    command.add_argument("--run-status", required=True, help="whether each query ran")
    command.add_argument("--out", required=True)
    command.add_argument("--n-samples", type=int)
    return parser


def _keyed(df: DataFrame, name: str, key: str = "ex_id") -> DataFrame:
    return prepare.ensure_row_keys(df, scratch(df.sparkSession, name), key)


def main(arguments: list[str] | None = None) -> None:
    args = _parser().parse_args(arguments)
    spark = build_session()

    if args.step == "prepare":
        raw = _keyed(files.load_table(spark, args.raw, args.split), "raw")
        done = steps.prepare_seed(raw, args.n_samples, args.out, args.seed)
        reports = [done.kept, done.levels]
    elif args.step == "request":
        rows = _keyed(files.read_jsonl(spark, args.seed_rows, files.SEED), "seed")
        if args.dry_run:
            mock = enrich.dry_run(rows)
            files.write_jsonl(mock, args.out)
            reports = [mock]
        else:
            steps.request_completions(rows, args.n_samples, args.out, args.seed)
            reports = []
    elif args.step == "enrich":
        rows = _keyed(files.read_jsonl(spark, args.seed_rows, files.SEED), "seed")
        if args.responses:
            bodies = spark.read.schema(BODY_SCHEMA).option("mode", "FAILFAST").json(args.responses)
            completions, errors = responses.read_responses(bodies)
            if args.errors:
                files.write_jsonl(errors, args.errors)
        else:
            completions = spark.read.schema(COMPLETION_SCHEMA).option("mode", "FAILFAST").json(args.completions)
        done = steps.collect_completions(rows, completions, args.out, args.score)
        reports = [done.kept, done.summary]
    elif args.step == "mix":
        rows = _keyed(files.read_jsonl(spark, args.seed_rows, files.SEED), "seed")
        made = None
        if args.enriched:
            made = _keyed(files.read_jsonl(spark, args.enriched, files.ENRICHED), "enriched")
        done = steps.build_examples(
            rows, made, args.out, args.seed_ratio, args.synthetic_ratio, args.seed, args.split_by
        )
        reports = [done.sizes, done.sources, done.levels, done.thinking]
    elif args.step == "format":
        rows = files.read_jsonl_lenient(spark, args.input, files.EXAMPLE)
        reports = [steps.format_examples(rows, args.output).stats]
    else:
        predictions, results, status = (
            spark.read.schema(schema).option("mode", "FAILFAST").json(path)
            for schema, path in (
                (PREDICTION_SCHEMA, args.predictions), (RESULT_SCHEMA, args.result_rows), (STATUS_SCHEMA, args.run_status)
            )
        )
        tests = files.read_tests(spark, args.tests)
        if tests.where("example_id IS NOT NULL").isEmpty():  # in order, as are the predictions; ids elsewhere are positions
            tests, predictions = files.read_tests_in_order(spark, args.tests), files.with_positions(predictions)
            results, status = (df.withColumn("position", F.col("example_id").cast("long")) for df in (results, status))
        done = steps.evaluate(
            tests, predictions, results, status, args.out, "example_id", args.n_samples, args.seed
        )
        reports = [done.report, done.ordered]
    for report in reports:
        report.show(50, truncate=80)


if __name__ == "__main__":
    main()
