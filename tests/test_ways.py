"""Alignment by position and by buckets, fingerprints, counts made on the way, first rows of many levels."""

import glob
import json
import random

import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from seedloom import __main__ as command_line
from seedloom.operators import compare, reports, sampling
from seedloom.plans import steps
from seedloom.sources import files
from seedloom.streaming.batches import write_batches

# --- positions -----------------------------------------------------------------


def test_positions_over_files_and_pieces(spark, tmp_path):
    """Files in part order, each cut into several pieces that tasks read in any order."""
    lines, folder = [], tmp_path / "rows"
    folder.mkdir()
    for part in (0, 1, 2, 10, 100_000, 100_001):
        own = [json.dumps({"a": f"{part}-{i}", "b": "x" * random.Random(i).randint(0, 90)}) for i in range(200 if part % 2 else 61)]
        (folder / f"part-{part:05d}-x.json").write_text("\n\n".join(own) + ("\n" if part else ""))
        lines += own
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        rows = files.read_jsonl(spark, str(folder), "a string, b string")
        assert rows.rdd.getNumPartitions() > 6
        found = files.with_positions(rows)
        kept = files.with_positions(rows, F.col("a").endswith("0"))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found.columns == ["a", "b", "position"]
    wanted = [json.loads(line)["a"] for line in lines]
    assert [(r.position, r.a) for r in found.orderBy("position").collect()] == list(enumerate(wanted))
    zeros = [a for a in wanted if a.endswith("0")]
    assert [(r.position, r.a) for r in kept.orderBy("position").collect()] == list(enumerate(zeros))
    parquet = tmp_path / "table"
    found.orderBy("position").select("a").write.parquet(str(parquet))
    again = files.with_positions(spark.read.parquet(str(parquet)))
    assert [(r.position, r.a) for r in again.orderBy("position").collect()] == list(enumerate(wanted))
    assert files.with_positions(spark.read.parquet(str(parquet)).where("a = ''")).collect() == []


TEST, PREDICTION = "position long, question string, schema string, sql string, complexity string", "position long, pred_sql string"


def test_sides_of_unequal_length_are_refused(values):
    tests = values(TEST, [(i, "q", "s", f"SELECT {i}", None) for i in range(3)])
    predictions = [(i, f"SELECT {i};") for i in range(3)]
    aligned = compare.with_exact_match(compare.align_by_position(tests, values(PREDICTION, predictions)))
    assert rows_of(aligned.select("position", "exact_match")) == [(0, True), (1, True), (2, True)]
    for some in (predictions[:2], [*predictions, (3, "x")]):
        with pytest.raises(ValueError, match="no common order"):
            compare.align_by_position(tests, values(PREDICTION, some))


def test_repeated_predictions_are_refused(values):
    tests = values("ex_id long, question string, schema string, sql string, complexity string", [(1, "q", "s", "SELECT 1", "c")])
    runs = values("ex_id long, side string, row_repr string", []), values("ex_id long, side string, ok boolean, error string", [])
    with pytest.raises(ValueError):
        steps.evaluate(tests, values("ex_id long, pred_sql string", [(1, "a"), (1, "b")]), *runs)
    assert steps.evaluate(tests, values("ex_id long, pred_sql string", [(1, "SELECT 1")]), *runs).report.first().n == 1


def test_command_line_without_ids(spark, tmp_path, monkeypatch, capsys):
    def write(name, rows):
        (tmp_path / name).write_text("".join(json.dumps(row) + "\n" for row in rows))
        return str(tmp_path / name)

    chat = {"messages": [{"role": "user", "content": "x"}]}
    raw = [{"question": "q", "schema": "s", "sql": f"SELECT {i}", "complexity": "c"} for i in range(4)]
    arguments = [
        "evaluate", "--tests", write("tests.json", [raw[0], chat, *raw[1:]]),
        "--predictions", write("predictions.json", [{"pred_sql": f"select {i};"} for i in (0, 1, 7, 3)]),
        "--result-rows", write("rows.json", [{"example_id": "2", "side": "gold", "row_repr": "(1,)"}]),
        "--run-status", write("status.json", [{"example_id": str(i), "side": s, "ok": True} for i in (0, 2) for s in ("gold", "pred")]),
        "--out", str(tmp_path / "out"),
    ]
    monkeypatch.setattr(command_line, "build_session", lambda: spark)
    command_line.main(arguments)
    found = spark.read.parquet(f"{tmp_path}/out/examples").orderBy("position")
    assert [(r.position, r.exact_match, r.execution_match) for r in found.collect()] == [
        (0, True, True), (1, True, False), (2, False, False), (3, True, False),
    ]


# --- buckets ---------------------------------------------------------------------


def test_stored_by_key_needs_no_exchange(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = files.store_by_key(spark.range(1000).select(F.col("id").alias("ex_id"), (F.col("id") * 2).alias("a")), "ex_id", 4)
        right = files.store_by_key(spark.range(0, 1000, 3).select(F.col("id").alias("ex_id"), F.lit("b").alias("b")), "ex_id", 4)
        joined = left.join(right, "ex_id", "left")
        assert "Exchange" not in plan_of(joined) and joined.where("b = 'b'").count() == 334 and joined.count() == 1000
        assert "Exchange" not in plan_of(left.groupBy("ex_id").count())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


# --- fingerprints -------------------------------------------------------------------

RUNS = "ex_id long, side string, ok boolean, error string, row_repr string"


def random_runs(draw):
    rows = []
    for key in [*range(80), None]:
        bag = [draw.choice(["(1,)", "(2,)", "", "(None,)"]) for _ in range(draw.randint(0, 4))]
        other = list(bag) if draw.random() < 0.7 else bag + [draw.choice(["(1,)", "(9,)"])]
        draw.shuffle(other)
        for side, own in (("gold", bag), ("pred", other)):
            if draw.random() < 0.95:
                rows.append((key, side, draw.random() < 0.95, None, None))
            rows += [(key, side, None, None, row) for row in own]
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize("empty", [True, False])
def test_fingerprints_as_rows(values, empty):
    runs = values(RUNS, random_runs(random.Random(empty))).repartition(3)
    wanted = rows_of(compare.match_results(runs, empty_is_match=empty))
    assert any(match for _, match in wanted) and not all(match for _, match in wanted)
    for verify in (False, True):
        assert rows_of(compare.match_fingerprints(runs, empty_is_match=empty, verify=verify)) == wanted
    assert compare.match_fingerprints(runs.limit(0), verify=True).collect() == []


def test_fingerprints_leave_row_texts_where_they_are(values):
    plan = plan_of(compare.match_fingerprints(values(RUNS, random_runs(random.Random(1)))))
    shuffled = [line for line in plan.splitlines() if "Exchange" in line]
    assert shuffled and not any("row_repr" in line for line in shuffled)


def test_bags_that_agree_in_count_and_sum_of_parts_differ(values):
    rows = [(1, side, True, None, None) for side in ("gold", "pred")]
    rows += [(1, "gold", None, None, r) for r in ("ab", "cd")] + [(1, "pred", None, None, r) for r in ("ad", "cb")]
    assert rows_of(compare.match_fingerprints(values(RUNS, rows))) == [(1, False)]


# --- counts on the way -----------------------------------------------------------------


def test_report_costs_no_pass(spark, tmp_path):
    """The table is gone when the report is asked for: its counts were made while the rows were written."""
    source = str(tmp_path / "in")
    spark.range(1000).selectExpr("id AS n").write.parquet(source)
    seen = reports.watched(spark.read.parquet(source), **reports.kept_counts(F.col("n") < 250))
    plan = plan_of(seen.rows.where("n < 250"))
    assert plan.count("Scan parquet") == 1 and "CollectMetrics" in plan
    seen.rows.where("n < 250").write.parquet(str(tmp_path / "out"))
    spark.range(7).selectExpr("id AS n").write.mode("overwrite").parquet(source)
    report = reports.with_ratio(seen.report()).first()
    assert tuple(report) == (1000, 250, 0.25)


def test_counts_of_no_rows(spark, tmp_path):
    seen = reports.watched(spark.range(0).selectExpr("id AS n"), **reports.kept_counts(F.col("n") < 1))
    seen.rows.write.parquet(str(tmp_path / "none"))
    assert tuple(reports.with_ratio(seen.report()).first()) == (0, 0, None)


def test_formatted_rows_and_counts(spark, tmp_path):
    rows = [("a", "q", "s", "SELECT 1 FROM t", "why " * 9), ("b", "", "s", "SELECT 1 FROM t", ""), ("c", "q", "s", "short", ""), ("d", "q", "s", "SELECT 2 FROM t", "")]
    examples = spark.createDataFrame(
        [(*r, "c", "d", "src", 1.0, split) for r, split in zip(rows, ("train", "train", "test", "test"))], files.EXAMPLE.add("split", "string")
    ) if "split" not in files.EXAMPLE.names else None
    plain = steps.format_examples(examples)
    written = steps.format_examples(examples, str(tmp_path / "chat"))
    assert tuple(plain.stats.first()) == tuple(written.stats.first()) == (4, 2, 2, 1)
    assert rows_of(plain.rows.select("split")) == rows_of(spark.read.json(str(tmp_path / "chat")).select("split"))


# --- many levels -----------------------------------------------------------------------


@pytest.mark.parametrize("quota", [1, 3, 2000])
def test_first_rows_of_levels(spark, quota):
    rows = spark.range(30_000).select(
        F.col("id").alias("ex_id"), F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 1500).cast("string")).alias("_level"),
        F.md5(F.col("id").cast("string")).alias("_key"),
    )
    found = {r.ex_id for r in sampling.first_of_levels(rows, quota).collect()}
    by_level = {}
    for r in sorted(rows.collect(), key=lambda r: r["_key"]):
        by_level.setdefault(r["_level"], []).append(r.ex_id)
    assert found == {key for keys in by_level.values() for key in keys[:quota]}


def test_levels_are_limited_before_the_shuffle(spark):
    rows = spark.range(10).selectExpr("id AS ex_id", "string(id % 3) AS _level", "string(id) AS _key")
    plan = plan_of(sampling.first_of_levels(rows, 5))
    below = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in below and below.index("WindowGroupLimit") > 0


# --- batches ------------------------------------------------------------------------------


def test_a_file_per_batch_in_one_folder(spark, tmp_path):
    write_batches(spark.range(107).selectExpr("id AS ex_id", "'x' AS a"), str(tmp_path / "batches"), 10)
    parts = glob.glob(f"{tmp_path}/batches/part-*")
    assert glob.glob(f"{tmp_path}/batches/*=*") == []
    batches = [[json.loads(line)["batch_idx"] for line in open(part)] for part in parts]
    assert sorted(len(b) for b in batches) == [7] + [10] * 10 and all(len(set(b)) == 1 for b in batches)
    assert sorted(b[0] for b in batches) == list(range(11))
