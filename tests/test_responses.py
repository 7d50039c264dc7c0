"""Response bodies of a model service."""

import json

import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from seedloom.operators import enrich, responses


def chat(*contents, **more):
    return {"choices": [{"index": i, "message": {"role": "assistant", "content": c}, "finish_reason": "stop"} for i, c in enumerate(contents)], **more}


CASES = [
    (chat("a"), [(0, "a", None)]),
    (chat("a", "b"), [(0, "a", None), (1, "b", None)]),
    (chat(""), [(0, "", None)]),
    (chat(None), [(0, None, "no content")]),
    (chat("a", None, "c"), [(0, "a", None), (1, None, "no content"), (2, "c", None)]),
    (chat([{"type": "text", "text": "x "}, {"type": "image"}, {"type": "text", "text": "y"}]), [(0, "x y", None)]),
    (chat([]), [(0, None, "no content")]),
    (chat({"text": "x"}), [(0, None, "no content")]),
    (chat(7), [(0, None, "no content")]),
    ({"choices": [{"text": "plain"}, {"text": "other", "index": 5}]}, [(0, "plain", None), (5, "other", None)]),
    ({"choices": [{"message": {"content": "x"}, "index": "1"}]}, [(1, "x", None)]),
    ({"choices": [{}]}, [(0, None, "no content")]),
    ({"choices": ["x"]}, [(0, None, "no content")]),
    ({"choices": []}, [(None, None, "no choices")]),
    ({"choices": {"message": {"content": "x"}}}, [(None, None, "no choices")]),
    ({"choices": None}, [(None, None, "no choices")]),
    ({}, [(None, None, "no choices")]),
    (chat("a", error=None), [(0, "a", None)]),
    ({"error": {"message": "busy", "code": 429}}, [(None, None, "service error: busy")]),
    ({"error": "gone"}, [(None, None, "service error: gone")]),
    (chat("a", error={"message": "late"}), [(None, None, "service error: late")]),
    ({"custom_id": "1", "response": {"status_code": 200, "body": chat("in a line")}, "error": None}, [(0, "in a line", None)]),
    ({"custom_id": "1", "response": None, "error": {"message": "expired"}}, [(None, None, "service error: expired")]),
]
TEXTS = ["", "  ", "no json", "{", '{"choices": [', "[1, 2]", "null", "3", '"text"', json.dumps(chat("a")) + ",", json.dumps(chat("a")) * 2]


@pytest.mark.parametrize("body, expected", [*[(json.dumps(b), rows) for b, rows in CASES], *[(t, [(None, None, "not JSON")]) for t in [*TEXTS, None]]])
def test_bodies(values, body, expected):
    read = responses.read_bodies(values("ex_id long, body string", [(1, body)]))
    assert read.columns == ["ex_id", "choice_idx", "content", "finish_reason", "error"]
    assert [(r.choice_idx, r.content, r.error) for r in read.orderBy("choice_idx").collect()] == expected


def test_escapes_and_long_texts(values):
    long = "[SQL]" + "é\\\"\n\t" * 200_000 + "[/SQL]"
    row = responses.read_bodies(values("ex_id long, body string", [(1, json.dumps(chat(long)))])).first()
    assert row.content == long


def test_answers_and_errors(values):
    cut = chat("half")
    cut["choices"][0]["finish_reason"] = "length"
    rows = [
        (1, "trace", json.dumps(chat("[REASONING]why[/REASONING]")), "x"), (2, "trace", "{", "x"), (None, "trace", json.dumps(chat("k")), "x"),
        (3, "trace", json.dumps(cut), "x"), (1, "trace", json.dumps(chat("[REASONING]again[/REASONING]")), "x"),
    ]
    bodies = values("ex_id long, stage string, body string, error string", rows)
    found = responses.read_responses(bodies)
    assert rows_of(found.completions.select("ex_id", "content")) == [
        (None, "k"), (1, "[REASONING]again[/REASONING]"), (1, "[REASONING]why[/REASONING]"), (3, "half"),
    ]
    assert rows_of(found.errors) == [(2, "trace", None, "not JSON")]
    strict = responses.read_responses(bodies, cut_off=False)
    assert rows_of(strict.errors.select("ex_id", "error")) == [(2, "not JSON"), (3, "cut off")]
    traces = enrich.parse_completions(found.completions.where("ex_id = 1"))
    assert sorted(r.reasoning_trace for r in traces.collect()) == ["again", "why"]
    none = responses.read_responses(bodies.limit(0))
    assert none.completions.collect() == [] and none.errors.collect() == []


def test_one_narrow_pass(spark):
    bodies = spark.range(5).select(F.col("id").alias("ex_id"), F.lit(json.dumps(chat("a", "b"))).alias("body"))
    plan = plan_of(responses.read_bodies(bodies))
    assert "Exchange" not in plan and "Python" not in plan and plan.count("Generate") == 1


def test_texts_of_single_slots_stay_where_they_are(values):
    """Only slots that are there twice send their answers' texts; the others send the fields read from them."""
    rows = [(i, "upgrade", 0, f"[SQL]SELECT {i}[/SQL]") for i in range(50)] + [(7, "upgrade", 0, "[SQL]A[/SQL]")] * 2
    done = enrich.parse_completions(values("ex_id long, stage string, choice_idx int, content string", rows)).collect()
    assert len(done) == 52
    assert sorted((r.choice_idx, r.upgraded_sql) for r in done if r.ex_id == 7) == [(0, "A"), (1, "A"), (2, "SELECT 7")]
