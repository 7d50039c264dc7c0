import random

import pytest
from pyspark.sql import functions as F

from seedloom.functions import score
from seedloom.functions.numbers import round_exactly, share
from seedloom.operators import enrich, examples

UPGRADED = (
    "SELECT u.name, COUNT(o.id) as order_count FROM users u LEFT JOIN orders o ON u.id = o.user_id "
    "WHERE u.age > 30 GROUP BY u.name HAVING COUNT(o.id) > 5 ORDER BY order_count DESC"
)
TRACE = "Step 1: Identify tables. Step 2: JOIN users with orders. Step 3: GROUP BY user_id."
FIELDS = "sql string, upgraded_sql string, variant_sql string, upgraded_question string, variant_question string, reasoning_trace string"


def enriched(values, sql, upgraded, **changes):
    row = {
        "sql": sql,
        "upgraded_sql": upgraded,
        "variant_sql": "SELECT COUNT(*) FROM orders GROUP BY user_id",
        "upgraded_question": "How many orders has each user placed?",
        "variant_question": "Show total orders per user",
        "reasoning_trace": TRACE,
    } | changes
    return values(FIELDS, [tuple(row[name.split()[0]] for name in FIELDS.split(", "))])


@pytest.mark.parametrize(
    "sql, upgraded, expected, exact",
    [
        ("SELECT name FROM users WHERE age > 30", UPGRADED, 0.851, 0.851),
        ("SELECT * FROM products", "SELECT * FROM products", 0.71, 0.711),
        ("SELECT id FROM users", "SELECT", 0.5, 0.501),
    ],
)
def test_scores_as_printed(values, sql, upgraded, expected, exact):
    df = enriched(values, sql, upgraded)
    assert df.select(score.quality_score()).first()[0] == expected
    assert enrich.score_enriched(df, None).first().quality_score == expected
    assert enrich.score_enriched(df, None, exact=True).first().quality_score == exact


def test_simpler_and_marks(values):
    df = enriched(values, UPGRADED, "SELECT name FROM users")
    assert enrich.score_enriched(df, None).first().quality_score == 0.571
    assert enrich.score_enriched(df).first().quality_score == -1.0
    assert enrich.score_enriched(df, 0.5).first().quality_score == 0.571


def test_question_must_be_longer_than_fifteen(values):
    short = enriched(values, "SELECT * FROM p", "SELECT * FROM p", upgraded_question="x" * 15)
    long = enriched(values, "SELECT * FROM p", "SELECT * FROM p", upgraded_question="x" * 16)
    difference = (
        enrich.score_enriched(long, None).first().quality_score
        - enrich.score_enriched(short, None).first().quality_score
    )
    assert difference == pytest.approx(0.075, abs=0.0011)


@pytest.mark.parametrize(
    "sql, count",
    [
        ("", 0),
        (None, 0),
        ("VALUES (1)", 0),
        ("select 1", 1),
        ("SELECT DENSE_RANK() OVER (ORDER BY a) FROM t", 2),
        ("WITH x AS (SELECT a FROM t JOIN u) SELECT COUNT(*) OVER () FROM x UNION SELECT 1", 6),
        ("update t set a = 1", 0),
    ],
)
def test_feature_count(values, sql, count):
    assert values("a string", [(sql,)]).select(score.feature_count("a")).first()[0] == count


@pytest.mark.parametrize(
    "sql, ok",
    [
        ("SELECT a FROM t", True),
        ("  with x as (select 1) select * from x", True),
        ("SELECT 12", False),
        ("SELECT 123", True),
        ("MERGE INTO t USING u", False),
        ("SELECT (a FROM t", False),
        (")SELECT( a FROM t", False),
        ("SELECT )a( FROM t", True),
        ("SELECT todo FROM t", True),
        ("SELECT TODOS FROM t", False),
        ("SELECT a, ... FROM t", False),
        ("SELECT <your column> FROM t", False),
        (None, False),
    ],
)
def test_plausible_sql(values, sql, ok):
    assert values("a string", [(sql,)]).select(score.plausible_sql("a")).first()[0] is ok


@pytest.mark.parametrize(
    "trace, keywords, steps",
    [
        (TRACE, 3, 3),
        ("select Where JOINS group by GROUP  BY withering with", 4, 0),
        ("first,next;then finally stepwise 1. 22. 3", 0, 6),
        ("éSELECT SELECTé _WITH WITH_ ſelect", 1, 0),
        ("٣. 10.5", 0, 2),
    ],
)
def test_trace_counts(values, trace, keywords, steps):
    df = values("a string", [(trace,)])
    assert tuple(df.select(score.keyword_count("a"), score.step_count("a")).first()) == (keywords, steps)


def test_trace_bounds(values):
    rows = [("x" * 49,), ("x" * 50,), (" " * 30 + "x" * 49,), (" " * 30 + "x" * 50,), ("Then join. " * 100,), (None,)]
    got = [r[0] for r in values("a string", rows).coalesce(1).select(score.trace_score("a")).collect()]
    assert got == [0.0, 0.05, 0.0, 0.08, 1.0, 0.0]


def test_rounding_is_pythons(values):
    pick = random.Random(7)
    numbers = [k / n for n in range(1, 90) for k in range(n + 1)] + [pick.random() for _ in range(3000)]
    numbers = [v for v in numbers + [k / 2000 for k in range(2001)] if v == 0 or v >= 0.001]
    df = values("v double", [(v,) for v in numbers])
    for v, three, four in df.select("v", round_exactly(F.col("v"), 3), round_exactly(F.col("v"), 4)).collect():
        assert (three, four) == (round(v, 3), round(v, 4))


def test_shares_are_rounded_as_python_does(values):
    pairs = [(k, n) for n in (1, 3, 32, 64, 160, 800, 19999, 20000, 20001, 40000) for k in range(0, n + 1, max(1, n // 500))]
    pairs += [(1, 20000), (3, 20000), (1, 10**9), (5, 10**5), (5, 10**4)]
    df = values("a long, b long", pairs)
    for a, b, got in df.select("a", "b", share(F.col("a"), F.col("b"))).collect():
        assert got == round(a / b, 4)


def test_share_of_nothing_is_null(values):
    got = values("a long, b long", [(0, 0), (1, 32)]).coalesce(1).select(share(F.col("a"), F.col("b"))).collect()
    assert [r[0] for r in got] == [None, 0.0312]


def test_rejected_rows_give_no_examples(values):
    df = enriched(values, UPGRADED, "SELECT name FROM users").selectExpr(
        "1L AS ex_id", "'q' AS question", "'s' AS schema", "'basic SQL' AS complexity", "'d' AS domain",
        "'CTEs' AS upgraded_complexity", "'v' AS variant_schema", "*",
    )
    assert examples.expand_enriched(enrich.score_enriched(df)).count() == 0
    assert examples.expand_enriched(enrich.score_enriched(df, 0.5)).count() == 3
