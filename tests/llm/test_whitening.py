"""Whitening against exact sums and numpy's eigenvectors."""

import numpy as np
import pytest

from seedloom.llm import matrices, whitening
from seedloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def expected(vectors):
    """Plain numpy: n, sums, whitened by component, explained, of usable vectors by position."""
    whole = [np.floor(np.array(v, dtype=np.float64) * 256).astype(np.int64) for v in vectors]
    fit = np.array(sorted({tuple(x) for x in whole}))
    n, sums = len(fit), fit.sum(axis=0)
    away = fit - sums / n
    values, columns = np.linalg.eigh(away.T @ away / n)
    values, columns = values[::-1][:4], columns[:, ::-1][:, :4]
    white = [(x - sums / n) @ columns / np.sqrt(values) for x in whole]
    deviation = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(x, sums)) for x in whole]
    return n, deviation, white, values / np.trace(away.T @ away / n)


def test_query_against_numpy(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    n, deviation, white, explained = expected([v for _, v in rows])
    at = {key: i for i, (key, _) in enumerate(rows)}
    found = QUERIES["op13_whitening"](spark, SF).collect()
    assert len(found) == 4 * len(rows) and {r["component"] for r in found} == {1, 2, 3, 4}
    ratio = {}
    for r in found:
        i, c = at[r["vec_id"]], r["component"] - 1
        assert r["n"] == n and r["deviation"] == deviation[i] and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(explained[c], rel=1e-9)
        sign = ratio.setdefault(c, np.sign(r["whitened"] * white[i][c]))
        assert r["whitened"] == pytest.approx(sign * white[i][c], abs=1e-7)


@pytest.mark.parametrize("size", [1, 2, 3, 17, 64])
def test_eigen_solver(size):
    draw = np.random.default_rng(size)
    a = draw.standard_normal((3 * size, size))
    for matrix in (a.T @ a, np.diag(draw.standard_normal(size)), np.zeros((size, size))):
        values, vectors = whitening.leading_eigen(matrix, 4)
        own = np.linalg.eigvalsh(matrix)[::-1][:4]
        assert np.allclose(values, own[own > 1e-13], rtol=1e-12, atol=1e-13)
        assert np.allclose(vectors @ vectors.T, np.eye(len(values)), atol=1e-13)
        assert np.allclose(matrix @ vectors.T, vectors.T * values, atol=1e-12)


def test_clusters_of_equal_eigenvalues():
    turn, _ = np.linalg.qr(np.random.default_rng(3).standard_normal((20, 20)))
    matrix = turn @ np.diag([5.0] * 3 + [5 - 1e-9] + [1.0] * 16) @ turn.T
    values, vectors = whitening.leading_eigen((matrix + matrix.T) / 2, 6)
    assert np.allclose(values, [5] * 4 + [1] * 2) and np.allclose(vectors @ vectors.T, np.eye(6), atol=1e-13)
    assert np.allclose(matrix @ vectors.T, vectors.T * values, atol=1e-12)


def test_matrices_are_added_in_levels(spark, monkeypatch):
    monkeypatch.setattr(matrices, "FAN", 3)
    parts = [(part, row, [float(part), float(row)]) for part in range(20) for row in range(2)]
    frame = spark.createDataFrame(parts, "part long, row int, entries array<double>").repartition(5)
    assert matrices.added(frame, 2).tolist() == [[190.0, 0.0], [190.0, 20.0]]


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [0.5, 1.0]), (1, [0.5, 1.0]), (2, [0.5, 1.0]), (None, [-0.25, 3.0]), (3, None), (4, []), (5, [None, 1.0]),
        (6, [nan, 1.0]), (7, [1.0, -inf]), (8, [1.0, 2.0, 3.0]), (9, [2.0, -0.0]), (10, [1.0, 0.001]),
    ]
    columns = "vec_id long, embedding array<float>, x string, projected string, N string, fit string"
    df = spark.createDataFrame([row + ("kept",) * 4 for row in rows], columns).repartition(3)
    done = whitening.whiten(df)
    assert done.columns == [*df.columns, "white"]
    found = done.collect()
    assert sorted(str(r["vec_id"]) for r in found) == sorted(["1", "1", "2", "None", "9", "10"])
    usable = [r["embedding"] for r in found]
    n, deviation, white, explained = expected(usable)
    assert n == 4
    for at, r in enumerate(found):
        assert (r["white"]["n"], r["white"]["deviation"], r["x"], r["N"]) == (4, deviation[at], "kept", "kept")
        assert [abs(c["whitened"]) for c in r["white"]["components"]] == pytest.approx(list(map(abs, white[at])), abs=1e-9)
        assert [c["explained"] for c in r["white"]["components"]] == pytest.approx(list(explained), abs=1e-12)


def test_no_variance_and_no_rows(spark):
    schema = "vec_id long, embedding array<double>"
    same = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], schema)).collect()
    assert [(r["white"]["n"], r["white"]["deviation"], r["white"]["components"]) for r in same] == [(1, 0, [])] * 2
    none = whitening.whiten(spark.createDataFrame([], schema))
    assert none.collect() == [] and none.columns == ["vec_id", "embedding", "white"]
    assert whitening.whiten(spark.createDataFrame([(1, None)], schema)).collect() == []


def test_entries_beyond_doubles_stay_exact(spark):
    rows = [(1, [3e15, 1.0]), (2, [-3e15, 2.0]), (3, [1e15, 3.0])]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    whole = {key: [int(256 * c) for c in v] for key, v in rows}
    sums = [sum(x[i] for x in whole.values()) for i in range(2)]
    for r in found:
        assert r["white"]["deviation"] == sum((3 * a - s) ** 2 for a, s in zip(whole[r["vec_id"]], sums))
    huge = whitening.whiten(spark.createDataFrame([(1, [1e30]), (2, [-1e30])], "vec_id long, embedding array<double>"))
    assert [r["white"]["deviation"] for r in huge.collect()] == [None, None] or all(
        r["white"]["deviation"] > 10**36 for r in huge.collect()
    )
