"""Declared chains, and table functions of SQL."""

import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from seedloom.functions.sql_names import register_sql_functions
from seedloom.operators import examples, ranking
from seedloom.plans.blocks import Block, declared, ordered, run_blocks


def block(name, inputs=(), outputs=(), after=()):
    return Block(name, lambda df: df.withColumns({c: F.lit(name) for c in outputs}), tuple(inputs), tuple(outputs), tuple(after))


def names(blocks, columns=("a",)):
    return [b.name for b in ordered(blocks, columns)]


def test_order_follows_from_names():
    last, middle, first = block("last", "c", "d"), block("middle", "b", "c"), block("first", "a", "b")
    assert names([last, middle, first]) == ["first", "middle", "last"]
    assert names([block("x"), block("y"), block("z")]) == ["x", "y", "z"]
    assert names([block("y", "a", after=["x"]), block("x", "a")]) == ["x", "y"]
    assert names([block("reads", "a"), block("changes", "a", "a")]) == ["changes", "reads"]
    assert names([]) == []


@pytest.mark.parametrize(
    "blocks, message",
    [
        ([block("x", "q")], "x needs q"),
        ([block("x", "c", "b"), block("y", "b", "c")], "wait for each other"),
        ([block("x", after=["y"]), block("y", after=["x"])], "wait for each other"),
        ([block("x", "b", "b")], "only it gives"),
        ([block("x", (), "b"), block("y", (), "b")], "given by x and by y"),
        ([block("x"), block("x")], "one name"),
        ([block("x", after=["nobody"])], "x needs nobody"),
    ],
)
def test_what_cannot_run(blocks, message):
    with pytest.raises(ValueError, match=message):
        ordered(blocks, ["a"])


def test_run(spark):
    rows = spark.range(3).select(F.col("id").alias("a"))
    kinds = {"add": lambda df, to, n: df.withColumn(to, F.col("a") + n), "keep": lambda df, least: df.where(F.col("b") >= least)}
    spec = [
        {"kind": "keep", "inputs": ["b"], "params": {"least": "$least"}},
        {"kind": "add", "inputs": ["a"], "outputs": ["b"], "params": {"to": "b", "n": 10}},
    ]
    assert rows_of(run_blocks(rows, declared(spec, kinds, least=11))) == [(1, 11), (2, 12)]
    with pytest.raises(ValueError, match="does not give c"):
        run_blocks(rows, [Block("x", lambda df: df, (), ("c",))])
    for wrong in ({"kind": "none"}, {"kind": "add", "colour": 1}):
        with pytest.raises(ValueError, match="no such block"):
            declared([wrong], kinds)


def test_table_functions(spark, values):
    register_sql_functions(spark)
    texts = values("id long, content string", [(1, "[A] x [/A] [A][/A]"), (2, None), (3, "[A]open"), (4, "[B]b[/B][A]\n1\n[/A]")])
    found = spark.sql("SELECT c.id, t.* FROM {c} c, LATERAL tagged_texts(c.content, 'A') t", c=texts)
    assert rows_of(found) == [(1, 0, "x"), (1, 1, ""), (4, 0, "1")]
    answers = values("id long, stage string, content string", [(1, "trace", "[REASONING]r[/REASONING]"), (2, "none", "x"), (3, None, "x"), (4, "trace", None)])
    found = spark.sql("SELECT a.id, f.* FROM {a} a, LATERAL answer_fields(a.stage, a.content) f", a=answers)
    assert rows_of(found) == [(1, "reasoning_trace", "r"), (4, "reasoning_trace", "")]
    assert "Exchange" not in plan_of(found) and "Join" not in plan_of(found)


def test_expansion_as_table_function(spark, values):
    register_sql_functions(spark)
    texts = ["question", "schema", "sql", "complexity", "domain", "reasoning_trace", "upgraded_question", "upgraded_sql", "upgraded_complexity",
             "variant_schema", "variant_question", "variant_sql"]
    draw = [None, "", "x", "[MOCK] y"]
    rows = [(i, *[draw[(i // 4**(at % 5) + at) % 4] for at in range(12)], [None, -1.0, 0.5][i % 3]) for i in range(200)]
    df = values("ex_id long, " + ", ".join(f"{c} string" for c in texts) + ", quality_score double", rows)
    found = spark.sql(
        "SELECT m.* FROM {e} e, LATERAL training_examples(string(ex_id), " + ", ".join(texts) + ", quality_score) m", e=df
    )
    wanted = examples.expand_enriched(df)
    assert found.columns == wanted.columns and rows_of(found) == rows_of(wanted) and wanted.count() > 20
    assert "Exchange" not in plan_of(found) and "Join" not in plan_of(found)


def test_equal_rows_keep_their_numbers(spark):
    rows = spark.range(3000).select((F.col("id") % 7).alias("v")).repartition(5)
    numbered = ranking.value_rank(rows, F.md5(F.col("v").cast("string")))
    assert numbered.columns == ["v", "rank"]
    assert sorted(r["rank"] for r in numbered.collect()) == list(range(1, 3001))
