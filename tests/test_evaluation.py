"""Result comparison and the evaluation step."""

import pytest
from helpers import plan_of, rows_of

from seedloom.operators import compare, reports
from seedloom.plans import steps

DDL = "CREATE TABLE t (a INT, b TEXT); INSERT INTO t VALUES (1, 'x');"


def executions(values, rows):
    return values("ex_id long, side string, ok boolean, error string, row_repr string", rows)


def status(key, pred=True, gold=True):
    return [(key, "pred", pred, None, None), (key, "gold", gold, None, None)]


def results(key, side, *texts):
    return [(key, side, None, None, text) for text in texts]


def test_match_results(values):
    rows = (
        status(1) + results(1, "pred", "b", "a") + results(1, "gold", "a", "b")  # order does not matter
        + status(2)  # both empty
        + status(3) + results(3, "pred", "a", "a") + results(3, "gold", "a")  # counts differ
        + status(4, pred=False, gold=False)
        + status(5, pred=False) + results(5, "gold", "a")
        + status(6) + results(6, "gold", "a")
        + status(7) + results(7, "pred", "(1,)") + results(7, "gold", "(1.0,)")
        + status(8)[:1]  # one side was not run
    )
    got = dict(rows_of(compare.match_results(executions(values, rows))))
    assert got == {1: True, 2: True, 3: False, 4: False, 5: False, 6: False, 7: False, 8: False}
    strict = dict(rows_of(compare.match_results(executions(values, rows), empty_is_match=False)))
    assert strict == got | {2: False}


def test_hot_pair_is_counted_in_parts(values, spark):
    big = spark.range(20000).selectExpr("1L AS ex_id", "CASE WHEN id % 2 = 0 THEN 'pred' ELSE 'gold' END AS side",
                                        "cast(null AS boolean) AS ok", "cast(null AS string) AS error", "'same' AS row_repr")
    matched = compare.match_results(big.unionByName(executions(values, status(1))))
    assert rows_of(matched) == [(1, True)]
    assert "partial_sum" in plan_of(matched)


def test_bags(values):
    left = values("a int, b string", [(1, "x"), (1, "x"), (2, None)])
    right = values("a int, b string", [(2, None), (1, "x")])
    assert not compare.bag_equal(left, right)
    assert compare.bag_equal(left, right.union(right.where("a = 1")))
    assert rows_of(compare.bag_difference(left, right)) == [(1, "x", 1)]


def test_reports(values):
    df = values("complexity string, exact_match boolean, execution_match boolean",
                [("CTEs", True, True), ("CTEs", False, True), ("basic SQL", False, False), ("odd", False, True)])
    report = reports.eval_report(df)
    assert rows_of(report) == [
        ("CTEs", False, 2, 0.5, 1.0), ("basic SQL", False, 1, 0.0, 0.0),
        ("odd", False, 1, 0.0, 1.0), ("overall", True, 4, 0.25, 0.75),
    ]
    ordered = [(r.ord, r.level, r.bar) for r in reports.ordered_report(report).collect()]
    assert ordered == [(0, "basic SQL", ""), (6, "CTEs", "█" * 20), (None, "odd", "█" * 20)]


def test_evaluate(values, tmp_path):
    tests = values("ex_id long, question string, schema string, sql string, complexity string",
                   [(1, "q", DDL, "SELECT a FROM t;", "CTEs"), (2, "q", DDL, "SELECT b FROM t", None),
                    (3, "q", DDL, "SELECT b FROM t", "CTEs")])
    predictions = values("ex_id long, pred_sql string",
                         [(1, "<think>hm</think>\nselect  a from t"), (2, "SELECT b FROM t ORDER BY a")])
    asked = steps.inference_requests(tests).first().messages
    assert [m.role for m in asked] == ["system", "user"] and asked[1].content.endswith("\n\nQuestion: q")
    run_status = values("ex_id long, side string, ok boolean, error string",
                        [row[:4] for row in status(1) + status(2)])  # nothing was run for 3
    result_rows = values("ex_id long, side string, row_repr string",
                         [(1, "pred", "(1,)"), (1, "gold", "(1,)"), (2, "pred", "('x',)"), (2, "gold", "('x',)")])
    done = steps.evaluate(tests, predictions, result_rows, run_status, str(tmp_path / "eval"))
    assert rows_of(done.results.select("ex_id", "pred_sql", "exact_match", "execution_match")) == [
        (1, "select  a from t", True, True), (2, "SELECT b FROM t ORDER BY a", False, True), (3, "", False, False),
    ]
    overall = done.report.where("is_overall").first()
    assert (overall.n, overall.exact_match, overall.execution_accuracy) == (3, 0.3333, 0.6667)
    assert (tmp_path / "eval" / "report" / "_SUCCESS").exists()
    assert steps.evaluate(tests, predictions, result_rows, run_status, n=2).results.count() == 2
    for bad in (tests.union(tests.where("ex_id = 1")), tests.selectExpr("nullif(ex_id, 2) AS ex_id", *tests.columns[1:])):
        with pytest.raises(ValueError, match="ex_id"):
            steps.evaluate(bad, predictions, result_rows, run_status)
