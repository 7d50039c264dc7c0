"""Exact top-k against all inner products."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from seedloom.llm import topk

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows, k=5, every=2):
    used = []
    for key, vector in rows:
        if vector and all(x is not None and math.isfinite(x) for x in vector):
            used.append((key, [math.floor(256 * float(np.float32(x))) for x in vector]))
    out = []
    for i, (key, vector) in enumerate(used):
        if key is None or key % every:
            continue
        scores = [
            (-sum(a * b for a, b in zip(vector, other)), other_key is None, other_key or 0, j)
            for j, (other_key, other) in enumerate(used) if j != i
        ]
        best = sorted(scores)[:k]
        out += [(key, rank, None if null else other, -score) for rank, (score, null, other, _) in enumerate(best, 1)]
    return sorted(out, key=repr)


def found(df, k=5, **options):
    return sorted((tuple(r) for r in topk.top_k(df, F.col("vec_id") % 2 == 0, k, **options).collect()), key=repr)


def vectors(n, width, seed, share=1.0):
    draw = np.random.default_rng(seed)
    return [(i, [float(x) if draw.random() < share else 0.0 for x in draw.normal(0, 0.2, width)]) for i in range(n)]


@pytest.mark.parametrize("blocks", [{}, {"query_block": 7, "candidate_block": 11}])
@pytest.mark.parametrize("share", [1.0, 0.1])
def test_blocks_of_any_size(spark, blocks, share):
    rows = vectors(60, 8, 3, share)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(3), **blocks) == plain(rows)


def test_odd_vectors(spark):
    rows = vectors(12, 3, 4) + [
        (0, [0.1, 0.2, 0.3]), (0, [0.1, 0.2, 0.3]), (None, [0.5, 0.5, 0.5]), (20, None), (22, []), (24, [0.1, None, 0.2]),
        (26, [math.nan, 0.0, 0.0]), (28, [math.inf, 0.0, 0.0]), (30, [1.0]), (32, [0.1] * 6), (34, [0.0, 0.0, 0.0]),
        (36, [-0.001, 0.001, 0.0]),
    ]
    assert found(spark.createDataFrame(rows, SCHEMA).coalesce(1)) == plain(rows)
    wide = spark.createDataFrame([row + (1, 2, 3) for row in rows], SCHEMA + ", ROW int, id int, asks int").coalesce(1)
    assert found(wide) == plain(rows)
    assert found(wide.limit(0)) == []


def test_ties_and_few_rows(spark):
    same = [(i, [0.5, 0.5]) for i in range(9)]
    assert found(spark.createDataFrame(same, SCHEMA), query_block=2, candidate_block=2) == plain(same)
    alone = [(2, [0.5, 0.5])]
    assert found(spark.createDataFrame(alone, SCHEMA)) == []
    assert found(spark.createDataFrame(alone + [(4, [1.0, 0.0])], SCHEMA)) == plain(alone + [(4, [1.0, 0.0])])


def test_selection_is_exact_among_ties():
    draw = np.random.default_rng(1)
    for _ in range(200):
        n = draw.integers(1, 40)
        scores, ids, tie = draw.integers(0, 4, n), draw.integers(0, 10, n), draw.permutation(n)
        best = topk.select(scores, ids, tie, 5)
        assert best.tolist() == sorted(range(n), key=lambda i: (-scores[i], ids[i], tie[i]))[:5]
