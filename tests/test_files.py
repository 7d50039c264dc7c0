"""Sources, sinks, streams, whole steps and the command line."""

import hashlib
import json

import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seedloom.__main__ import main
from seedloom.operators import enrich, examples, prepare, reports, sampling
from seedloom.plans import steps
from seedloom.session import scratch
from seedloom.sources import files
from seedloom.streaming.batches import file_stream, run_batches, write_batches


def lines(path, *texts):
    path.write_text("\n".join(texts) + "\n", encoding="utf-8")
    return str(path)


GOOD = '{"question": "é?", "schema": "s", "sql": "SELECT 123"}'


def test_strict_read(spark, tmp_path):
    fine = lines(tmp_path / "fine.jsonl", GOOD, "", "   \t", GOOD)
    rows = files.read_jsonl(spark, fine, files.EXAMPLE)
    assert rows.count() == 2 and rows.first().question == "é?"
    bad = lines(tmp_path / "bad.jsonl", GOOD, "{bad")
    with pytest.raises(Exception, match="FAILED_READ_FILE|MALFORMED_RECORD"):
        files.read_jsonl(spark, bad, files.EXAMPLE).collect()


def test_lenient_read(spark, tmp_path):
    path = lines(tmp_path / "mixed.jsonl", GOOD, "", "  ", "{bad", '{"question": "no sql"}', GOOD[:-1])
    rows = files.read_jsonl_lenient(spark, path, files.EXAMPLE)
    stats = reports.format_stats(examples.flag_chat(rows), files.CORRUPT).first()
    assert tuple(stats) == (4, 1, 3, 0)


def test_write_keeps_nulls_and_letters(spark, tmp_path):
    df = spark.createDataFrame([("é\n\"", None)], "a string, b string")
    out = tmp_path / "deep" / "out"
    files.write_jsonl(df, str(out))
    files.write_jsonl(df, str(out))
    text = "".join(part.read_text(encoding="utf-8") for part in out.glob("part-*"))
    assert text == '{"a":"é\\n\\"","b":null}\n'


def test_splits(spark, tmp_path):
    df = spark.createDataFrame([("1", "train"), ("2", "train"), ("3", "test")], "example_id string, split string")
    files.write_splits(df, str(tmp_path / "out"))
    read = {name: files.read_split(spark, str(tmp_path / "out"), name).count() for name in ("train", "eval", "test")}
    assert read == {"train": 2, "eval": 0, "test": 1}
    assert files.load_table(spark, _parquet(df), split="train").count() == 2


def _parquet(df):
    path = scratch(df.sparkSession, "table")
    df.write.parquet(path)
    return path


def test_tests_in_chat_form_are_left_out(spark, tmp_path):
    path = lines(tmp_path / "tests.jsonl", GOOD, '{"messages": [{"role": "user", "content": "x"}], "_meta": {}}')
    assert [r.sql for r in files.read_tests(spark, path).collect()] == ["SELECT 123"]


def test_training_text_prefers_the_chat_file(spark, tmp_path):
    raw = lines(tmp_path / "raw.jsonl", GOOD)
    chat = lines(tmp_path / "chat.jsonl", '{"messages": [{"role": "user", "content": "x"}]}')
    assert files.read_training_text(spark, chat, raw).first().text == "<|im_start|>user\nx<|im_end|>\n"
    none = str(tmp_path / "none")
    assert files.read_training_text(spark, none, raw).first().text.startswith("### Schema:\ns\n")
    with pytest.raises(FileNotFoundError):
        files.read_training_text(spark, none, none)


def test_row_keys_follow_the_values_alone(spark):
    rows = spark.range(300).selectExpr("CASE WHEN id < 100 THEN 'same' ELSE concat('x', id) END AS sql", "id % 2 AS n")
    keyed = [
        rows_of(prepare.with_row_keys(rows.repartition(parts), scratch(spark, "k"))) for parts in (1, 3, 11)
    ]
    assert [row[0] for row in keyed[0]] == list(range(1, 301))
    assert keyed[0] == keyed[1] == keyed[2]
    empty = prepare.with_row_keys(rows.limit(0), scratch(spark, "k"))
    assert empty.count() == 0 and empty.columns == ["ex_id", "sql", "n"]


def test_given_keys_stay(spark):
    rows = spark.range(10, 20).selectExpr("id AS ex_id", "'a' AS sql")
    assert prepare.ensure_row_keys(rows, scratch(spark, "k")) is rows
    with pytest.raises(ValueError, match="1 of 10 rows have no ex_id"):
        prepare.ensure_row_keys(rows.selectExpr("nullif(ex_id, 12) AS ex_id", "sql"), scratch(spark, "k"))
    bare = prepare.ensure_row_keys(rows.selectExpr("cast(null AS string) AS ex_id", "sql"), scratch(spark, "k"))
    assert sorted(r.ex_id for r in bare.collect()) == sorted(map(str, range(1, 11)))


def test_check_keys(spark):
    rows = spark.range(5).withColumnRenamed("id", "ex_id")
    assert prepare.check_keys(rows) is rows
    with pytest.raises(ValueError, match="0 rows without a key, 5 keys given more than once"):
        prepare.check_keys(rows.union(rows))
    with pytest.raises(ValueError, match="1 rows without a key"):
        prepare.check_keys(rows.selectExpr("nullif(ex_id, 3) AS ex_id"))


def test_scratch_needs_a_shared_folder(spark):
    assert scratch(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_stored_filters_reach_the_scan(spark):
    stored = files.store(spark.range(10).selectExpr("id AS ex_id", "'a' AS text"), scratch(spark, "s"))
    plan = plan_of(stored.where("ex_id = 3").select("ex_id"))
    assert "EqualTo(ex_id,3)" in plan and "ReadSchema: struct<ex_id:bigint>" in plan


def test_stream_equals_batch(spark, tmp_path):
    rows = spark.range(40).selectExpr(
        "id AS ex_id", "'SELECT a FROM t' AS sql", "CASE WHEN id % 2 = 0 THEN 'SELECT a FROM t JOIN u' END AS upgraded_sql",
        "'SELECT b FROM v' AS variant_sql", "repeat('q', 10 + id) AS upgraded_question", "'short' AS variant_question",
        "repeat('Then join. ', id) AS reasoning_trace",
    )
    files.write_jsonl(rows.repartition(5), str(tmp_path / "in"))

    def step(df):
        return enrich.score_enriched(df).select("ex_id", "quality_score")

    def run():
        stream = file_stream(spark, str(tmp_path / "in"), rows.schema, files_per_batch=2)
        run_batches(stream, step, str(tmp_path / "out"), str(tmp_path / "ckpt"), None).awaitTermination()
        return rows_of(spark.read.schema("ex_id long, quality_score double").parquet(str(tmp_path / "out")))

    assert run() == rows_of(step(rows))
    files.write_jsonl(rows.selectExpr("ex_id + 100 AS ex_id", *rows.columns[1:]), str(tmp_path / "in"), "append")
    assert len(run()) == 80  # only the new files were worked off


def test_command_line(spark, tmp_path, capsys):
    """All steps on a small table, each from the files of the one before."""
    at = lambda name: str(tmp_path / name)
    spark.range(60).selectExpr(
        "concat('Which rows have a = ', id, '?') AS sql_prompt", "'CREATE TABLE t (a INT); INSERT INTO t VALUES (7);' AS sql_context",
        "concat('SELECT a FROM t WHERE a = ', id) AS sql", "'d' AS domain",
        "CASE WHEN id % 3 = 0 THEN 'CTEs' ELSE 'basic SQL' END AS sql_complexity", "cast(null AS string) AS sql_task_type",
        "cast(null AS string) AS sql_explanation", "'train' AS split",
    ).write.parquet(at("raw"))
    main(["prepare", "--raw", at("raw"), "--split", "train", "--out", at("seed"), "--n-samples", "20"])
    seed = files.read_jsonl(spark, at("seed/seed_sample"), files.SEED)
    assert seed.groupBy("complexity").count().where("count = 10").count() == 2
    assert files.read_jsonl(spark, at("seed/seed_full"), files.SEED).count() == 60

    main(["request", "--seed-rows", at("seed/seed_sample"), "--out", at("mock"), "--dry-run"])
    assert spark.read.json(at("mock")).count() == 5
    main(["request", "--seed-rows", at("seed/seed_sample"), "--out", at("requests"), "--n-samples", "12"])
    requests = spark.read.json(at("requests"))
    assert requests.count() == 36

    answer = F.when(F.col("stage") == "upgrade", "[QUESTION]uq[/QUESTION][SQL]SELECT max(a) FROM t[/SQL]").when(
        F.col("stage") == "variant", "[SCHEMA]s[/SCHEMA][QUESTION]vq[/QUESTION][SQL]SELECT 12345[/SQL]"
    ).otherwise("[REASONING]a reason that is long enough[/REASONING]")
    files.write_jsonl(
        requests.select("ex_id", "stage", F.lit(0).alias("choice_idx"), answer.alias("content")), at("completions")
    )
    main(["enrich", "--seed-rows", at("seed/seed_sample"), "--completions", at("completions"), "--out", at("enriched")])
    assert files.read_jsonl(spark, at("enriched"), files.ENRICHED).count() == 12

    main(["mix", "--seed-rows", at("seed/seed_sample"), "--enriched", at("enriched"), "--out", at("final")])
    splits = {s: files.read_split(spark, at("final"), s).count() for s in ("train", "eval", "test")}
    assert splits == {"train": 47, "eval": 2, "test": 4}  # 20 of 22 seed rows and 33 of 36 others

    main(["format", "--input", at("final") + "/split=train", "--output", at("chat")])
    chat = files.read_jsonl(spark, at("chat"), files.CHAT)
    assert chat.count() == 47 and chat.where("size(messages) = 3").count() == 47

    tests = files.read_split(spark, at("final"), "test")
    files.write_jsonl(tests.selectExpr("example_id", "concat(sql, ';') AS pred_sql"), at("predictions"))
    sides = F.explode(F.array(F.lit("pred"), F.lit("gold"))).alias("side")
    files.write_jsonl(tests.select("example_id", sides, F.lit("(1,)").alias("row_repr")), at("results"))
    files.write_jsonl(tests.select("example_id", sides, F.lit(True).alias("ok"), F.lit(None).cast("string").alias("error")), at("status"))
    main(["evaluate", "--tests", at("final") + "/split=test", "--predictions", at("predictions"),
          "--result-rows", at("results"), "--run-status", at("status"), "--out", at("eval")])
    report = [json.loads(line) for part in (tmp_path / "eval/report").glob("part-*") for line in part.read_text().splitlines()]
    overall = next(row for row in report if row["is_overall"])
    assert overall["n"] == 4 and overall["exact_match"] == 1.0 and overall["execution_accuracy"] == 1.0
    assert "overall" in capsys.readouterr().out


def test_batches_of_rows(spark, tmp_path):
    """A stream over 50 rows in batches of 20 takes 20, 20 and the rest."""
    rows = spark.range(50).selectExpr("id AS ex_id", "concat('q', id) AS question").repartition(3)
    write_batches(rows, str(tmp_path / "in"))
    schema = T.StructType([*rows.schema.fields, T.StructField("batch_idx", T.LongType())])
    stream = run_batches(
        file_stream(spark, str(tmp_path / "in"), schema), lambda batch: batch, str(tmp_path / "out"),
        str(tmp_path / "state"), pause_seconds=None,
    )
    stream.awaitTermination()
    assert sorted(p.numInputRows for p in stream.recentProgress if p.numInputRows) == [10, 20, 20]
    done = spark.read.schema(schema).parquet(str(tmp_path / "out"))
    assert rows_of(done.select("ex_id", "question")) == rows_of(rows)
    expected = {r.ex_id: r.batch_idx for r in sampling.assign_batches(rows).collect()}
    assert {r.ex_id: r.batch_idx for r in done.collect()} == expected


def test_split_files_are_shuffled(spark, tmp_path):
    """The written files hold seed and made rows in hash order."""
    seed = spark.range(400).selectExpr(
        "id AS ex_id", "concat('q', id) AS question", "'s' AS schema", "'SELECT 12345' AS sql", "'CTEs' AS complexity",
        "'d' AS domain", "'seed' AS source",
    )
    made = seed.selectExpr(
        "*", "'u' AS upgraded_question", "'' AS upgraded_sql", "'' AS upgraded_complexity", "'' AS variant_schema",
        "'' AS variant_question", "'' AS variant_sql", "'why' AS reasoning_trace", "1.0D AS quality_score",
    )
    steps.build_examples(seed, made, str(tmp_path / "final"))
    parts = sorted((tmp_path / "final" / "split=train").glob("part-*"))
    files_of = [[json.loads(line)["example_id"] for line in part.read_text().splitlines()] for part in parts]
    for part in files_of:
        keys = [hashlib.md5(f"42|shuffle|{key}".encode()).hexdigest() for key in part]
        assert keys == sorted(keys) and len({key.split("/")[0] for key in part}) == 2
