"""Seed rows, enrichment, examples, chat rows and reports."""

import json

import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from seedloom import fixed
from seedloom.functions import chat
from seedloom.functions.sql_names import register_sql_functions
from seedloom.operators import enrich, examples, prepare, reports

RAW = "ex_id long, sql_prompt string, sql_context string, sql string, sql_explanation string, domain string, sql_complexity string, sql_task_type string"


def raw(values, sql="SELECT a FROM t WHERE b = 1", context="CREATE TABLE t (a INT)", prompt="What is a here?"):
    return values(RAW, [(1, prompt, context, sql, None, None, None, None)])


@pytest.mark.parametrize(
    "changes, kept",
    [
        ({}, True),
        ({"sql": "x" * 19}, False),
        ({"sql": "x" * 20}, True),
        ({"sql": "x" * 600}, True),
        ({"sql": "x" * 601}, False),
        ({"sql": " " * 19 + "x"}, True),
        ({"sql": "SELECT todo, fixme FROM t"}, True),
        ({"sql": "SELECT a FROM TODOS WHERE 1"}, False),
        ({"sql": "SELECT a FROM t -- FIXME"}, False),
        ({"sql": None}, False),
        ({"context": "create table t (a INT)"}, True),
        ({"context": "create  table t (a INT)"}, False),
        ({"context": "CREATE TABLE" + "x" * 1488}, True),
        ({"context": "CREATE TABLE" + "x" * 1489}, False),
        ({"prompt": "x" * 9}, False),
        ({"prompt": "é" * 10}, True),
    ],
)
def test_seed_quality(values, changes, kept):
    assert prepare.seed_filter(raw(values, **changes)).count() == int(kept)


def test_normalize(values):
    row = prepare.normalize_seed(raw(values, prompt="\t What? \n")).first()
    assert row.question == "What?" and row.explanation == "" and row.domain == row.complexity == "unknown"
    assert row.task_type == "analytics and reporting" and row.split == "seed"


def test_contract(spark):
    df = spark.createDataFrame([("q", "s", "x", "c", "d")], list(fixed.REQUIRED_COLUMNS))
    assert prepare.check_contract(df) is df
    with pytest.raises(ValueError, match="domain"):
        prepare.check_contract(df.drop("domain"))
    with pytest.raises(ValueError, match="rows"):
        prepare.check_contract(df.limit(0))


def seeds(values, n=2):
    return values(
        "ex_id long, question string, schema string, sql string, complexity string, domain string, task_type string",
        [(k, f"q{k}", "s", "SELECT {{ domain }}", "CTEs", None, "t") for k in range(n)],
    )


def test_requests(values):
    rows = rows_of(enrich.stage_requests(seeds(values, 1)).select("stage", "max_tokens", "temperature", "messages"))
    assert [(r[0], r[1], r[2]) for r in rows] == [("trace", 1024, 0.3), ("upgrade", 1024, 0.8), ("variant", 1500, 0.9)]
    system, user = rows[1][3]
    assert system.role == "system" and user.role == "user"
    assert user.content.startswith("Domain: \nCurrent complexity: CTEs\n\nDatabase schema:\ns\n")
    assert "Original SQL:\nSELECT {{ domain }}\n" in user.content  # a slot inside a value stays


def completions(values, rows):
    return values("ex_id long, stage string, choice_idx int, content string", rows)


def test_attach(values):
    done = completions(
        values,
        [
            (0, "upgrade", 0, "[QUESTION] harder [/QUESTION][SQL]SELECT 1[/SQL][COMPLEXITY]CTEs[/COMPLEXITY]"),
            (0, "variant", 0, "[SCHEMA]t[/SCHEMA][QUESTION]v[/QUESTION][SQL]SELECT 2[/SQL]"),
            (0, "trace", 0, "[REASONING]\nwhy\n[/REASONING]"),
            (0, "upgrade", 1, "[SQL]open"),
            (9, "trace", 0, "[REASONING]nobody[/REASONING]"),
        ],
    )
    rows = enrich.attach_completions(seeds(values), done).orderBy("ex_id", "choice_idx").collect()
    assert [(r.ex_id, r.choice_idx) for r in rows] == [(0, 0), (0, 1), (1, 0)]
    assert (rows[0].upgraded_question, rows[0].upgraded_sql, rows[0].upgraded_complexity) == ("harder", "SELECT 1", "CTEs")
    assert (rows[0].variant_schema, rows[0].variant_question, rows[0].variant_sql) == ("t", "v", "SELECT 2")
    assert rows[0].reasoning_trace == "why"
    assert (rows[1].upgraded_sql, rows[1].variant_sql, rows[1].reasoning_trace) == ("", "SELECT 2", "why")
    assert {rows[2][c] for c in enrich.FIELDS} == {""}
    attached = enrich.attach_completions(seeds(values), done, keep_missing=False)
    assert attached.count() == 2
    assert enrich.required_fields(attached).count() == 1


def test_hot_row_is_split(spark):
    """A third of all answers belong to one seed row: the join spreads them over tasks."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.files.maxPartitionBytes": "100k",  # several tasks read what was stored
        "spark.sql.files.openCostInBytes": "10k",
    }
    before = {name: spark.conf.get(name) for name in changed}
    try:
        for name, value in changed.items():
            spark.conf.set(name, value)
        base = spark.range(20000).selectExpr(
            "id AS ex_id", "'q' AS question", "'s' AS schema", "'x' AS sql", "'c' AS complexity", "'d' AS domain"
        )
        done = spark.range(20000).selectExpr(
            "CASE WHEN id % 3 = 0 THEN 7 ELSE id END AS ex_id", "'trace' AS stage",
            "CASE WHEN id % 3 = 0 THEN cast(id AS int) ELSE 0 END AS choice_idx",
            "concat('[REASONING]', sha2(string(id), 512), '[/REASONING]') AS content",
        )
        total = enrich.attach_completions(base, done).agg(F.count("ex_id"), F.count_distinct("reasoning_trace"))
        assert tuple(total.collect()[0]) == (26667, 20001)  # two answers share choice 0 of row 7; both stay
        assert "skew=true" in plan_of(total)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_no_answer_is_mixed_or_lost(values):
    done = completions(
        values,
        [
            (0, "upgrade", 0, "[QUESTION]q A[/QUESTION][SQL]SELECT z[/SQL]"),
            (0, "upgrade", 0, "[QUESTION]q B[/QUESTION][SQL]SELECT y[/SQL]"),  # the request went out twice
            (0, "upgrade", 1, "[QUESTION]q C[/QUESTION][SQL]SELECT x[/SQL]"),
            (0, "trace", 0, "[REASONING]why[/REASONING]"),
            (1, "trace", 3, "[REASONING]first[/REASONING]"),
            (1, "trace", 5, "[REASONING]second[/REASONING]"),
            (1, "upgrade", 5, "[QUESTION]q D[/QUESTION][SQL]SELECT w[/SQL]"),
        ],
    )
    rows = enrich.attach_completions(seeds(values), done).orderBy("ex_id", "choice_idx")
    assert [(r.ex_id, r.choice_idx, r.upgraded_question, r.upgraded_sql, r.reasoning_trace) for r in rows.collect()] == [
        (0, 0, "q A", "SELECT z", "why"), (0, 1, "q C", "SELECT x", "why"), (0, 2, "q B", "SELECT y", "why"),
        (1, 3, "q D", "SELECT w", "first"), (1, 5, "q D", "SELECT w", "second"),
    ]
    assert enrich.required_fields(rows).count() == 5


def test_required_fields_ignore_white_space(values):
    df = values("upgraded_sql string, upgraded_question string, reasoning_trace string",
                [("a", "b", "c"), ("a", " \n", "c"), ("a", "b", None), (" ", "b", "c")])
    assert enrich.required_fields(df).count() == 1


def test_dry_run_replaces_columns(values, tmp_path):
    rows = seeds(values, 2).withColumn("quality_score", F.lit(0.1)).withColumn("upgraded_sql", F.lit("old"))
    made = enrich.dry_run(rows)
    made.write.parquet(str(tmp_path / "mock"))
    assert {(r.quality_score, r.upgraded_sql == "old") for r in made.collect()} == {(0.85, False)}


def test_dry_run(values):
    rows = enrich.dry_run(seeds(values, 9)).orderBy("ex_id").collect()
    assert [r.ex_id for r in rows] == [0, 1, 2, 3, 4]
    assert rows[0].upgraded_question == "[MOCK] Harder version of: q0" and rows[0].quality_score == 0.85
    assert rows[0].upgraded_sql.startswith("SELECT t1.*, COUNT(t2.id) FROM (SELECT {{ domain }}) t1 LEFT JOIN")


ENRICHED = (
    "ex_id long, question string, schema string, sql string, complexity string, domain string, upgraded_question string, "
    "upgraded_sql string, upgraded_complexity string, variant_schema string, variant_question string, variant_sql string, "
    "reasoning_trace string, quality_score double"
)
WHOLE = dict(
    ex_id=1, question="q", schema="s", sql="sql text", complexity="basic SQL", domain="d", upgraded_question="uq",
    upgraded_sql="us", upgraded_complexity="CTEs", variant_schema="vs", variant_question="vq", variant_sql="vx",
    reasoning_trace="why", quality_score=None,
)


@pytest.mark.parametrize(
    "changes, sources",
    [
        ({}, "rsu"),
        ({"quality_score": -1.0}, ""),
        ({"quality_score": 0.0}, "rsu"),
        ({"sql": "[MOCK] x"}, "rsu"),
        ({"upgraded_sql": "[MOCK] x"}, "rs"),
        ({"variant_sql": "[MOCK] x"}, "ru"),
        ({"question": None}, "su"),
        ({"upgraded_question": ""}, "rs"),
        ({"variant_schema": None}, "ru"),
        ({"schema": None, "reasoning_trace": None}, "rsu"),
    ],
)
def test_expand(values, changes, sources):
    row = WHOLE | changes
    got = examples.expand_enriched(values(ENRICHED, [tuple(row[n.split()[0]] for n in ENRICHED.split(", "))])).collect()
    letters = {"seed_with_reasoning": "r", "synthetic_variant": "s", "synthetic_upgraded": "u"}
    assert "".join(sorted(letters[r.source] for r in got)) == sources
    for r in got:
        assert r.quality_score == (row["quality_score"] if row["quality_score"] is not None else 1.0)
        assert (r.thinking != "") == (r.source == "seed_with_reasoning" and bool(row["reasoning_trace"]))
        assert r.example_id == f"{r.source}/1"
        assert r.schema == ("vs" if r.source == "synthetic_variant" else row["schema"] or "")
        assert r.complexity == ("CTEs" if r.source == "synthetic_upgraded" else "basic SQL")


def test_seed_examples(values):
    got = examples.seed_examples(seeds(values, 1).withColumn("question", F.lit(" q "))).first()
    assert (got.example_id, got.question, got.thinking, got.domain, got.source, got.quality_score) == (
        "seed/0", "q", "", "unknown", "unknown", 1.0
    )


EXAMPLE = "question string, schema string, sql string, thinking string, complexity string, domain string, source string"


@pytest.mark.parametrize(
    "question, schema, sql, thinking, valid, thinks",
    [
        ("q", "s", "SELECT 123", "x" * 20, True, False),
        ("q", "s", "SELECT 123", "x" * 21, True, True),
        ("q", "s", "SELECT 123", " " * 9 + "x" * 20, True, False),
        ("q", "s", " SELECT 12 ", "", False, False),
        (" ", "s", "SELECT 123", "", False, False),
        ("q", None, "SELECT 123", None, False, False),
    ],
)
def test_chat_rows(values, question, schema, sql, thinking, valid, thinks):
    df = values(EXAMPLE, [(question, schema, sql, thinking, None, "d", "s")])
    rows = examples.chat_rows(df).collect()
    assert len(rows) == int(valid)
    stats = reports.format_stats(examples.flag_chat(df)).first()
    assert tuple(stats) == (1, int(valid), int(not valid), int(valid and thinks))
    if valid:
        system, user, assistant = rows[0].messages
        assert system.content == (fixed.CHAT_SYSTEM_THINKING if thinks else fixed.CHAT_SYSTEM)
        assert user.content == "Database schema:\ns\n\nQuestion: q"
        assert assistant.content == ("<think>\n" + "x" * 21 + "\n</think>\n\nSELECT 123" if thinks else "SELECT 123")
        assert rows[0]._meta.asDict() == {
            "complexity": "unknown", "domain": "d", "source": "s", "has_thinking": thinks
        }


def test_training_text(values):
    df = values("messages array<struct<role:string,content:string>>, question string, schema string, sql string",
                [([("user", "a"), ("assistant", "b")], None, None, None), (None, "q", "s", "x")])
    got = {r[0] for r in df.select(chat.training_text()).collect()}
    assert got == {
        "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n",
        "### Schema:\ns\n\n### Frage:\nq\n\n### SQL:\nx",
    }


def test_serve_request(values):
    body = values("question string, schema string", [('say "é"', "a\nb")]).select(chat.serve_request()).first()[0]
    assert json.loads(body) == {
        "model": "text2sql",
        "messages": [
            {"role": "system", "content": fixed.SERVE_SYSTEM},
            {"role": "user", "content": 'Database schema:\na\nb\n\nQuestion: say "é"'},
        ],
        "max_tokens": 256,
        "temperature": 0.1,
    }


def test_level_report_shows_all_fixed_levels(values):
    df = values("complexity string", [("CTEs",)] * 11 + [("other",)] + [(None,)])
    got = [(r.level, r.n, r.bar) for r in reports.level_report(df).collect()]
    assert [level for level, _, _ in got] == list(fixed.LEVELS)
    assert got[6] == ("CTEs", 11, "█" * 40) and got[0] == ("basic SQL", 0, "")


def test_bars_do_not_grow_with_the_data(spark):
    df = spark.range(1).selectExpr("explode(array('a', 'b', 'c')) AS complexity")
    many = spark.range(3000).selectExpr("CASE WHEN id < 2000 THEN 'a' WHEN id < 2990 THEN 'b' ELSE 'c' END AS complexity")
    assert [tuple(r) for r in reports.complexity_bars(many).collect()] == [("a", 2000, "█" * 40), ("b", 990, "█" * 19), ("c", 10, "")]
    assert {r.bar for r in reports.complexity_bars(df).collect()} == {"█" * 40}


def test_an_empty_split_is_shown(values):
    df = values("split string", [("train",)] * 3 + [("test",)])
    assert [tuple(r) for r in reports.split_sizes(df).collect()] == [("train", 3), ("eval", 0), ("test", 1)]


def test_generation_summary(values):
    df = values("domain string, complexity string", [(f"d{k % 7}", "CTEs" if k % 3 else None) for k in range(22)])
    got = [tuple(r) for r in reports.generation_summary(df).collect()]
    assert ("total", "all", 22) in got and ("domain", "d0", 4) in got and ("complexity", "unknown", 8) in got
    assert [label for section, label, _ in got if section == "domain"] == ["d0", "d1", "d2", "d3", "d4"]


def test_reports_of_nothing(values):
    empty = values("split string, source string, complexity string, domain string, thinking string", [])
    assert tuple(reports.thinking_share(empty).first()) == (0, 0, None)
    assert tuple(reports.kept_ratio(empty, F.lit(True)).first()) == (0, 0, None)
    assert reports.source_shares(empty).count() == 0


def test_shares(values):
    df = values("source string, thinking string", [("a", "x"), ("a", None), ("b", ""), ("a", "y")])
    assert rows_of(reports.source_shares(df)) == [("a", 3, 75.0), ("b", 1, 25.0)]
    assert tuple(reports.thinking_share(df).first()) == (2, 4, 0.5)


def test_no_python_in_row_wise_plans(values):
    row = tuple(WHOLE.values())
    df = values(ENRICHED, [row])
    for made in (enrich.score_enriched(df).where("quality_score >= 0"), examples.expand_enriched(df),
                 examples.chat_rows(examples.expand_enriched(df))):
        assert "Python" not in plan_of(made) and "Exchange" not in plan_of(made)


def test_sql_names(spark):
    assert "tagged" in register_sql_functions(spark)
    got = spark.sql(
        """SELECT py_strip('\t a \n'), canonical_sql(' A  b ;'), drop_reasoning('<think>x</think>y'),
                  tagged('[SQL] 1 [/SQL]', 'SQL'), sql_feature_count('select 1'), plausible_sql('SELECT 123'),
                  trace_keywords('select join'), trace_steps('first 2.')"""
    ).first()
    assert tuple(got) == ("a", "a b ", "y", "1", 1, True, 2, 2)
