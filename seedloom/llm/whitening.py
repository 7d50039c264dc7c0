"""Whitening of embeddings along their leading principal components.

Entries become whole numbers (``floor(scale * c)``), so that sums over rows are exact and
equal vectors are equal. The covariance is taken over the *fit list*, each distinct vector
once, in two passes: the exact sums first, then products of centred entries. Tasks add up
their own matrix; matrices are added by 64 at a time until one is left, row by row, so no
task and not the driver ever holds more than one sum of 64 rows or one matrix.

Householder reflections make that matrix tridiagonal; the leading eigenvalues are found by
bisection on Sturm counts, their vectors by inverse iteration, in which vectors of
neighbouring eigenvalues (a cluster) are made orthogonal to each other in every step. The
components, a few vectors, go to all tasks, which project their rows.

A third pass over the fit list measures the covariance of what comes out against the identity.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedloom.llm.frames import stored, with_new
from seedloom.llm.matrices import MATRIX, added, matrix_rows, numbers

#: Eigenvalues closer than this share of the matrix's norm are one cluster.
CLUSTER = 1e-3
EPSILON = float(np.finfo(np.float64).eps)


# --- the symmetric eigenproblem ------------------------------------------------


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[int, np.ndarray]]]:
    """Diagonal, off-diagonal, and the reflections ``(first row, unit vector)`` in the order they were applied."""
    a = np.array(matrix, dtype=np.float64)
    size, reflections = len(a), []
    for at in range(size - 2):
        column = a[at + 1 :, at].copy()
        norm = np.linalg.norm(column)
        if norm == 0 or not column[1:].any():
            continue
        column[0] += np.copysign(norm, column[0])
        v = column / np.linalg.norm(column)
        reflections.append((at + 1, v))
        block = a[at + 1 :, at + 1 :]
        p = block @ v
        w = 2 * (p - (v @ p) * v)
        block -= np.outer(v, w) + np.outer(w, v)
        a[at + 1 :, at] -= 2 * v * (v @ a[at + 1 :, at])
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflections


def below(diagonal: np.ndarray, squares: np.ndarray, tiny: float, x: np.ndarray) -> np.ndarray:
    """Sturm counts: how many eigenvalues lie below each of ``x``."""
    pivot = diagonal[0] - x
    count = (pivot < 0).astype(np.int64)
    for d, square in zip(diagonal[1:], squares):
        pivot = d - x - square / np.where(np.abs(pivot) < tiny, -tiny, pivot)
        count += pivot < 0
    return count


def leading_values(diagonal: np.ndarray, beside: np.ndarray, wanted: int) -> np.ndarray:
    """The largest eigenvalues, falling, by bisection until no number lies between the bounds."""
    size = len(diagonal)
    radius = np.r_[0.0, np.abs(beside)] + np.r_[np.abs(beside), 0.0]
    norm = float(np.max(np.abs(diagonal) + radius)) or 1.0
    low = np.full(wanted, np.min(diagonal - radius) - EPSILON * norm)
    high = np.full(wanted, np.max(diagonal + radius) + EPSILON * norm)
    rank = size - np.arange(wanted)  # so many lie below any number above the eigenvalue
    tiny = max(EPSILON**2 * norm, np.finfo(np.float64).tiny / EPSILON)
    while True:
        middle = low + (high - low) / 2
        inside = (middle > low) & (middle < high) & (high - low > EPSILON * np.maximum(np.abs(low), np.abs(high)))
        if not inside.any():
            return middle
        above = below(diagonal, beside**2, tiny, middle) >= rank
        high = np.where(inside & above, middle, high)
        low = np.where(inside & ~above, middle, low)


def solve(diagonal: np.ndarray, beside: np.ndarray, shift: float, tiny: float, right: np.ndarray) -> np.ndarray:
    """``x`` of ``(T - shift) x = right`` by elimination with row exchanges; small pivots become ``tiny``."""
    size = len(diagonal)
    d, first, second = diagonal - shift, np.r_[beside, 0.0], np.zeros(size)
    x = right.copy()
    for at in range(size - 1):
        under, next_d, next_first = beside[at], d[at + 1], first[at + 1]
        if abs(under) > abs(d[at]):  # exchange the rows
            factor = d[at] / under
            d[at + 1] = first[at] - factor * next_d
            first[at + 1] = -factor * next_first
            d[at], first[at], second[at] = under, next_d, next_first
            x[at], x[at + 1] = x[at + 1], x[at] - factor * x[at + 1]
        else:
            factor = under / (d[at] if abs(d[at]) > tiny else tiny)
            d[at + 1] = next_d - factor * first[at]
            x[at + 1] -= factor * x[at]
    for at in range(size - 1, -1, -1):
        value = x[at]
        if at + 1 < size:
            value -= first[at] * x[at + 1]
        if at + 2 < size:
            value -= second[at] * x[at + 2]
        x[at] = value / (d[at] if abs(d[at]) > tiny else np.copysign(tiny, d[at]))
    return x


def inverse_iteration(diagonal: np.ndarray, beside: np.ndarray, values: np.ndarray, steps: int = 12) -> np.ndarray:
    """Unit eigenvectors, as rows, of the tridiagonal matrix for falling ``values``."""
    size = len(diagonal)
    norm = float(np.max(np.abs(diagonal)) + 2 * np.max(np.abs(beside), initial=0.0)) or 1.0
    tiny, draw = EPSILON * norm, np.random.default_rng(size)
    found: list[np.ndarray] = []
    for at, value in enumerate(values):
        cluster = [found[i] for i in range(at) if values[i] - value <= CLUSTER * norm]
        # Equal eigenvalues are taken apart by a little, or their systems would be the same.
        shift = value - 10 * tiny * sum(abs(values[i] - value) <= 10 * tiny for i in range(at))
        x = draw.standard_normal(size)
        for _ in range(steps):
            for _ in range(2):
                for other in cluster:
                    x -= (other @ x) * other
            x /= np.linalg.norm(x)
            x = solve(diagonal, beside, shift, tiny, x)
            x /= np.max(np.abs(x))
        for _ in range(2):
            for other in cluster:
                x -= (other @ x) * other
        found.append(x / np.linalg.norm(x))
    return np.array(found).reshape(len(found), size)


def leading_eigen(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues above rounding, falling, and their unit eigenvectors as rows.

    The sign makes a vector's largest entry positive.
    """
    size = len(matrix)
    scale = float(np.max(np.abs(matrix), initial=0.0))
    if scale == 0 or not np.isfinite(scale):
        return np.empty(0), np.empty((0, size))
    diagonal, beside, reflections = tridiagonal(matrix / scale)
    values = leading_values(diagonal, beside, min(wanted, size))
    values = values[values > size * EPSILON * max(1.0, values[0])]
    vectors = inverse_iteration(diagonal, beside, values)
    for first, v in reversed(reflections):
        vectors[:, first:] -= 2 * np.outer(vectors[:, first:] @ v, v)
    for vector in vectors:
        vector *= np.sign(vector[np.argmax(np.abs(vector))]) / np.linalg.norm(vector)
    return values * scale, vectors


# --- distributed sums ------------------------------------------------------------


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - sums``, exact: as 64-bit integers where they fit, as Python integers otherwise."""
    most = max((abs(int(bound)) for bound in (x.max(initial=0), x.min(initial=0))), default=0)
    if n * most + max(map(abs, sums)) < 1 << 63:
        return n * x - np.array(sums, dtype=np.int64)
    return n * x.astype(object) - np.array(sums, dtype=object)


def sums_of_products(fit: DataFrame, size: int, rows_of, wide: int) -> np.ndarray:
    """Sum over the fit list of the outer products that ``rows_of(x)`` gives, one square matrix."""

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((wide, wide))
        for batch in batches:
            rows = rows_of(numbers(batch.column(0), size))
            total += rows.T @ rows
        yield matrix_rows(total)

    return added(fit.mapInArrow(products, MATRIX), wide)


def whole_sums(fit: DataFrame, size: int) -> tuple[int, list[int]]:
    """How many vectors there are and their exact sums per dimension."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * size
        for batch in batches:
            x = numbers(batch.column(0), size)
            n += len(x)
            exact = x if np.abs(x.astype(np.float64)).max(initial=0.0) * len(x) < 2.0**62 else x.astype(object)
            total = [a + int(b) for a, b in zip(total, exact.sum(axis=0))]
        columns = [pa.array([n] * size, pa.int64()), pa.array(range(size), pa.int32()), pa.array(list(map(str, total)))]
        yield pa.record_batch(columns, names=["n", "at", "total"])

    sums = fit.mapInArrow(count, "n long, at int, total string").withColumn("total", F.col("total").cast("decimal(38,0)"))
    rows = sums.groupBy("at").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total")).collect()
    rows = sorted(rows, key=lambda row: row["at"])
    return (rows[0]["n"], [int(row["total"]) for row in rows]) if rows else (0, [0] * size)


# --- the operator ------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """What the tasks need: counts and sums of the fit list, components as rows, and how exact they are."""

    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    identity_error: float | None = None

    def project(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums).astype(np.float64) / self.n @ (self.components / np.sqrt(self.values)[:, None]).T


def whole_numbers(vector: Column, scale: int) -> Column:
    """The entries as longs; null unless there are entries and all are finite."""
    fine = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(c.cast("double")))
    whole = F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(scale))).cast("long"))
    return F.when(fine & (F.size(vector) > 0), whole)


def fit_whitening(fit: DataFrame, size: int, wanted: int) -> Whitening:
    """The components of a fit list: a stored frame of one column, vectors of ``size`` longs."""
    n, sums = whole_sums(fit, size)
    if not n:
        return Whitening(0, sums, np.empty((0, size)), np.empty(0), np.empty(0))
    covariance = sums_of_products(fit, size, lambda x: centred(x, n, sums).astype(np.float64) / n, size) / n
    values, vectors = leading_eigen(covariance, wanted)
    found = Whitening(n, sums, vectors, values, values / (np.trace(covariance) or 1.0))
    if not len(values):
        return found
    # The last row and column of the products hold the sums, for the mean.
    products = sums_of_products(fit, size, lambda x: np.c_[found.project(x), np.ones(len(x))], len(values) + 1) / n
    mean = products[-1, :-1]
    error = np.max(np.abs(products[:-1, :-1] - np.outer(mean, mean) - np.eye(len(values))))
    return Whitening(n, sums, vectors, values, found.explained, float(error))


def whiten(df: DataFrame, vector: str = "embedding", out: str = "white", *, wanted: int = 4, scale: int = 256) -> DataFrame:
    """The rows with usable vectors and a struct ``out``: fit list size, deviation, components, identity error.

    ``out.components`` lists ``component`` (from 1), ``whitened`` and ``explained``, at most
    ``wanted``: components without variance above rounding are left out, so vectors that are all
    equal have none. ``out.deviation`` is the exact sum over dimensions of (n * x - S)^2, a decimal
    of 38 digits, null beyond them.

    Rows whose vector is null or empty or holds null, NaN or infinite entries are dropped, and so
    are vectors of another length than most rows have (the longer one at a tie). Repeated vectors
    count once in the fit and all stay as rows, and so do repeated rows and null keys. Entries
    beyond 64 bits are held to their range. Other columns pass unchanged, except one named like
    ``out``, which is replaced. An empty table gives an empty one.
    """
    spark = df.sparkSession
    rows, x = with_new(df, "x", whole_numbers(F.col(vector), scale))
    rows = rows.where(F.col(x).isNotNull())
    common = rows.groupBy(F.size(x).alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    size = common[0]["size"] if common else 1
    rows = rows.where(F.size(x) == size)
    fit = stored(rows.select(F.col(x).alias("x")).distinct(), "fit")
    found = spark.sparkContext.broadcast(fit_whitening(fit, size, wanted))

    @F.arrow_udf("deviation decimal(38,0), whitened array<double>")
    def project(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = found.value
        kind = pa.list_(pa.field("element", pa.float64()))
        for batch in batches:
            vectors = numbers(batch, size)
            if not len(vectors):
                continue
            apart = centred(vectors, own.n, own.sums)
            most = max(abs(int(apart.max())), abs(int(apart.min())))
            exact = apart if size * most**2 < 1 << 63 else apart.astype(object)
            totals = [str(total) if total < 10**38 else None for total in map(int, (exact * exact).sum(axis=1))]
            deviation = pa.array(totals, pa.string()).cast(pa.decimal128(38, 0))
            yield pa.StructArray.from_arrays(
                [deviation, pa.array(list(own.project(vectors)), kind)], names=["deviation", "whitened"]
            )

    value = found.value
    explained = F.array(*map(F.lit, map(float, value.explained))) if len(value.explained) else F.array().cast("array<double>")
    # Of no vectors there are no rows, and the function is not called.
    projected, name = with_new(rows, "projected", project(F.col(x)))
    components = F.transform(
        F.col(f"{name}.whitened"),
        lambda y, i: F.struct((i + 1).alias("component"), y.alias("whitened"), F.element_at(explained, (i + 1).cast("int")).alias("explained")),
    )
    struct = F.struct(
        F.lit(value.n).cast("long").alias("n"), F.col(f"{name}.deviation").alias("deviation"),
        F.lit(value.identity_error).cast("double").alias("identity_error"), components.alias("components"),
    )
    return projected.withColumn(out, struct).drop(x, name)
