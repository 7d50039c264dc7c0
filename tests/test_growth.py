"""What a query moves, sorts and stores: bounds that its rows must keep however large the tables are."""

from __future__ import annotations

import importlib
import random
import re

from helpers import plan_of, rows_of

import workload
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seedloom.functions import sql_names, text
from seedloom.operators import compare, enrich, examples
from seedloom.sources import files
from seedloom.streaming import batches

from test_ways import RUNS, random_runs


def test_fingerprints_travel_once_by_key(values):
    runs = values(RUNS, random_runs(random.Random(4)))
    plan = plan_of(compare.match_fingerprints(runs))
    assert sum("Exchange hashpartitioning" in line for line in plan.splitlines()) == 1


def test_verified_rows_are_not_sorted(values, spark):
    runs = values(RUNS, random_runs(random.Random(5))).repartition(3)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        matched = compare.match_fingerprints(runs, verify=True)
        plan = plan_of(matched)
        assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
        assert rows_of(matched) == rows_of(compare.match_results(runs))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


ANSWERS = "ex_id long, stage string, choice_idx int, content string"


def random_answers(draw, keys=30):
    """Answers with repeated slots, equal texts, missing stages, null keys, choices and texts, and a stage of nobody's."""
    rows = []
    for _ in range(keys * 6):
        stage = draw.choice(["upgrade", "variant", "trace", "trace", "other", None])
        tag = {"upgrade": "SQL", "variant": "QUESTION", "trace": "REASONING"}.get(stage, "SQL")
        content = draw.choice([None, "", f"[{tag}]{draw.randint(0, 5)}[/{tag}]", f"[{tag}] open"])
        rows.append((draw.choice([*range(keys), None]), stage, draw.choice([0, 0, 1, 2, None]), content))
    return rows


def test_answers_of_few_and_of_many_give_the_same_rows(values, monkeypatch):
    """With a bound of no answers all keys go the way of those with many, with one of four some do."""
    answers = values(ANSWERS, random_answers(random.Random(6))).repartition(3)
    seeds = values("ex_id long, question string", [(i, f"q{i}") for i in [*range(40), 3, 3, None]]).repartition(2)
    found = {}
    for many in (1000, 6, 0):
        monkeypatch.setattr(enrich, "MANY", many)
        found[many] = [rows_of(enrich.parse_completions(answers))] + [
            rows_of(enrich.attach_completions(seeds, answers, keep_missing=keep)) for keep in (True, False)
        ]
    assert found[1000] == found[6] == found[0]
    assert len(found[0][0]) > 30 and len(found[0][1]) > len(found[0][2]) > 30


def test_answers_travel_once(values):
    """Whole answers are shuffled once by key, and seed rows once to meet them."""
    answers = values(ANSWERS, random_answers(random.Random(7)))
    seeds = values("ex_id long, question string", [(i, f"q{i}") for i in range(40)])
    plan = plan_of(enrich.attach_completions(seeds.hint("merge"), answers))
    assert sum("Exchange " in line for line in plan.splitlines()) == 2


def test_a_projection_of_a_given_table_is_not_stored(spark):
    rows = workload.table(spark, "/root/testdata/sf0.001", "doc_rows")
    assert all("documents.parquet" in path for path in rows.inputFiles())


def test_stored_rows_are_compressed(spark, tmp_path):
    files.store(spark.range(10), str(tmp_path / "rows"))
    assert all(".zstd." in part.name for part in (tmp_path / "rows").glob("part-*"))


def test_runs_of_white_space_become_one_space(values):
    draw = random.Random(8)
    texts = ["".join(draw.choice(["a", "é", " ", " ", *text.WHITESPACE]) for _ in range(40)) for _ in range(200)]
    made = values("value string", [(t,) for t in texts]).select(
        "value", F.regexp_replace("value", text.WHITESPACE_RUN, " ").alias("made"), F.regexp_count("value", F.lit(text.WHITESPACE_RUN)).alias("n")
    )
    for row in made.collect():
        assert row.made == re.sub(f"[{text.WHITESPACE}]+", " ", row.value)
        runs = re.findall(f"[{text.WHITESPACE}]+", row.value)
        assert row.n == sum(run != " " for run in runs)


def test_scores_in_sql_name_their_counts_outside_of_branches():
    made = sql_names.definitions()
    assert "trace_steps(" not in made["trace_score"][2].split("CASE")[1]
    assert made["quality_score"][2].count("sql_feature_count(upgraded_sql)") == 1


def test_texts_of_chat_rows_are_stripped_once(values):
    rows = values(
        "example_id string, question string, schema string, sql string, thinking string, complexity string, domain string, source string",
        [("a", " q ", "s\t", "SELECT 1234567", " " * 30, None, None, "x"), ("b", " ", "s", "SELECT 1234567", None, "c", "d", "x")],
    ).repartition(2)
    for made in (examples.valid_messages(rows), examples.chat_rows(rows, ("example_id",))):
        assert made._jdf.queryExecution().optimizedPlan().toString().count("trim(") <= 2 * len(examples.STRIPPED)
    found = {row.example_id: row.messages for row in examples.valid_messages(rows).collect()}
    assert found["b"] is None and found["a"][1].content == "Database schema:\ns\n\nQuestion: q"


def test_json_lines_in_gzip_read_back(spark, values, tmp_path):
    rows = values("example_id string, question string, split string", [("a", "q", "train"), ("b", None, "test")])
    files.write_splits(rows, str(tmp_path / "splits"), compression="gzip")
    files.write_jsonl(rows, str(tmp_path / "rows"), compression="gzip")
    parts = [part.name for part in tmp_path.rglob("part-*")]
    assert parts and all(name.endswith(".json.gz") for name in parts)
    assert rows_of(files.read_jsonl(spark, str(tmp_path / "rows"), rows.schema)) == rows_of(rows)
    assert [row.example_id for row in files.read_split(spark, str(tmp_path / "splits"), "test").collect()] == ["b"]


def test_a_batch_of_one_file_has_more_than_one_task(spark, values, tmp_path):
    values("ex_id long, word string", [(i, f"w{i}") for i in range(100)]).coalesce(1).write.parquet(str(tmp_path / "in"))
    rows = batches.file_stream(spark, str(tmp_path / "in"), T.StructType().add("ex_id", "long").add("word", "string"), 1, "parquet")
    out = str(tmp_path / "out")
    batches.run_batches(batches.dealt(rows), lambda batch: batch, out, str(tmp_path / "state"), pause_seconds=None).awaitTermination()
    made = [part.name for part in (tmp_path / "out").glob("part-*")]
    assert len(made) > 1 and all(".zstd." in name for name in made)
    assert spark.read.parquet(out).count() == 100


def test_thinking_share_stores_no_texts_of_the_mix(spark, values, tmp_path):
    """The share is counted on the way; where the mix is stored, it is the same."""
    entry = importlib.import_module("__spark_entry__")
    sf = str(tmp_path)
    people = [(i, f"Customer#{i}", "BUILDING") for i in range(5)]
    orders = [(i, i % 5, ("1-URGENT", "5-LOW")[i % 2], "FOP"[i % 3], 1000.0 * i) for i in [*range(200), 7, 7]]
    values("c_custkey long, c_name string, c_mktsegment string", people).write.parquet(f"{sf}/customer.parquet")
    schema = "o_orderkey long, o_custkey long, o_orderpriority string, o_orderstatus string, o_totalprice double"
    values(schema, orders).write.parquet(f"{sf}/orders.parquet")
    counted = rows_of(entry.queries()["thinking_share"](spark, sf))
    assert {name for _, folder, name in workload._stored if folder == sf} == {"cases"}
    assert counted[0][0] > 0
    assert counted == rows_of(entry.reports.thinking_share(entry._train(spark, sf)))
    assert counted == rows_of(entry.queries()["thinking_share"](spark, sf))
