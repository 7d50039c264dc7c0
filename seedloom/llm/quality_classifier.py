"""A quality classifier: kernel ridge regression on document statistics.

Random Fourier features approximate a Gaussian kernel over standardised statistics of a
text, so a linear model on them is a kernel machine. Its normal equations are sums over
rows: each task streams its share of the labelled rows and makes one matrix of fixed size;
these are added up in the cluster, and the driver solves the ridge system of the sum. Isotonic
regression then maps raw scores to probabilities: labels are counted per narrow bin of
the raw score, and neighbouring bins that fall are pooled.

Statistics cover whole texts. Null and empty texts have all statistics zero and get the
score of such a text; very long ones are read whole. Labels other than 0 and 1 and rows without a label teach nothing;
a document with several labels teaches each. Repeated rows stay. Without any usable label
every score is 0.5. An empty frame gives an empty frame. Other columns pass unchanged, but
for one named like the score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from seedloom.llm.frames import stored, with_new
from seedloom.llm.matrices import MATRIX, added, matrix_rows
from seedloom.llm.quality_rules import SPACES, SYMBOLS, ascii_letters

N_FOURIER, WIDTH, RIDGE, SEED = 256, 3.0, 1e-3, 20
BINS = 512
LOWEST, HIGHEST = -0.5, 1.5
DIGITS, ENDS = b"0123456789", b".!?"

STATISTICS = (
    "words", "word_length", "symbols", "dup_lines", "line_words", "upper", "lower", "distinct", "pairs", "marked",
    "stutter", "digits", "ends", "longest",
)


def statistics_of(text: str | None) -> tuple[float, ...]:
    """Shares and logarithms of counts over one whole text, in the order of ``STATISTICS``."""
    raw = (text or "").encode("utf-8")
    words = raw.split()
    if not words:
        return (0.0,) * len(STATISTICS)

    def count(signs: bytes) -> int:
        return len(raw) - len(raw.translate(None, signs))

    n, distinct = len(words), set(words)
    chars = len(text) - count(SPACES)
    lines = [line for line in raw.split(b"\n") if line.strip(SPACES)]
    if text.isascii():
        upper, lower = ascii_letters(raw)
    else:
        upper, lower = sum(map(str.isupper, text)), sum(map(str.islower, text))
    symbols = count(SYMBOLS)
    return (
        float(np.log1p(n)),
        float(np.log(chars / n)),
        symbols / chars,
        1 - len(set(lines)) / len(lines),
        float(np.log(n / len(lines))),
        upper / chars,
        lower / chars,
        len(distinct) / n,
        len(set(zip(words, words[1:]))) / n,
        sum(word.translate(None, SYMBOLS) != word for word in words) / n if symbols else 0.0,
        sum(map(eq, words, words[1:])) / n,
        count(DIGITS) / chars,
        count(ENDS) / n,
        float(np.log(max(map(len, distinct)))),
    )


def _rows_of(texts: pa.Array) -> np.ndarray:
    return np.array([statistics_of(text.as_py()) for text in texts], dtype=np.float64).reshape(-1, len(STATISTICS))


@F.arrow_udf(ArrayType(DoubleType()))
def text_statistics(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        yield pa.array(list(_rows_of(texts)), pa.list_(pa.float64()))


@dataclass(frozen=True)
class Model:
    """Everything a task needs to score: a few thousand numbers at any size of the corpus."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    at: np.ndarray
    level: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        return np.interp(raw_score(fourier(rows, self.mean, self.scale), self.weights), self.at, self.level)


def directions() -> tuple[np.ndarray, np.ndarray]:
    """Frequencies and phases of the Fourier features: draws from the Gaussian kernel's spectrum."""
    draw = np.random.default_rng(SEED)
    return draw.normal(0, 1 / WIDTH, (len(STATISTICS), N_FOURIER)), draw.uniform(0, 2 * np.pi, N_FOURIER)


def fourier(rows: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    """Fourier features and a constant of the standardised rows."""
    frequency, phase = directions()
    waves = np.sqrt(2 / N_FOURIER) * np.cos(((rows - mean) / scale).clip(-8, 8) @ frequency + phase)
    return np.hstack([waves, np.ones((len(rows), 1))])


def raw_score(features: np.ndarray, weights: np.ndarray) -> np.ndarray:
    return (features @ weights).clip(LOWEST, HIGHEST)


def solve(square: np.ndarray, moment: np.ndarray, n: float) -> np.ndarray:
    """Ridge weights from summed normal equations; the constant is not shrunk."""
    shrink = np.full(len(moment), RIDGE * n)
    shrink[-1] = 0
    return np.linalg.solve(square + np.diag(shrink), moment)


def isotonic(total: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Rising shares of good by bin: neighbours that fall are pooled, weighted by their rows."""
    pools: list[list[float]] = []
    for n, g in zip(total, good):
        pools.append([n, g, 1])
        while len(pools) > 1 and pools[-2][1] * pools[-1][0] >= pools[-1][1] * pools[-2][0]:
            n_last, g_last, bins = pools.pop()
            pools[-1] = [pools[-1][0] + n_last, pools[-1][1] + g_last, pools[-1][2] + bins]
    return np.concatenate([np.full(int(bins), g / n) for n, g, bins in pools])


def fit(labelled: DataFrame) -> Model:
    """The model of rows ``statistics array<double>, good double``, which are passed over three times."""
    k = len(STATISTICS)
    parts = labelled.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.avg(F.col("statistics")[i]).alias(f"mean_{i}") for i in range(k)],
        *[F.stddev_pop(F.col("statistics")[i]).alias(f"scale_{i}") for i in range(k)],
    ).head()
    if not parts["n"]:
        ends, half = np.array([LOWEST, HIGHEST]), np.array([0.5, 0.5])
        return Model(np.zeros(k), np.ones(k), np.zeros(N_FOURIER + 1), ends, half)
    mean = np.array([parts[f"mean_{i}"] for i in range(k)])
    scale = np.array([parts[f"scale_{i}"] or 1.0 for i in range(k)])

    def matrix(rows: pa.Array) -> np.ndarray:
        return rows.flatten().to_numpy(zero_copy_only=False).reshape(-1, k)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((N_FOURIER + 1, N_FOURIER + 2))
        for batch in batches:
            features = fourier(matrix(batch.column(0)), mean, scale)
            good = batch.column(1).to_numpy(zero_copy_only=False)
            total += features.T @ np.column_stack([features, good])
        yield matrix_rows(total)

    total = added(labelled.mapInArrow(sums, MATRIX), N_FOURIER + 2)
    weights = solve(total[:, :-1], total[:, -1], float(parts["n"]))

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, good = np.zeros(BINS), np.zeros(BINS)
        for batch in batches:
            raw = raw_score(fourier(matrix(batch.column(0)), mean, scale), weights)
            at = ((raw - LOWEST) / (HIGHEST - LOWEST) * BINS).astype(int).clip(0, BINS - 1)
            n += np.bincount(at, minlength=BINS)
            good += np.bincount(at, weights=batch.column(1).to_numpy(zero_copy_only=False), minlength=BINS)
        used = np.flatnonzero(n)
        yield pa.record_batch([pa.array(used), pa.array(n[used]), pa.array(good[used])], names=["bin", "n", "good"])

    counted = labelled.mapInArrow(bins, "bin long, n double, good double")
    levels = counted.groupBy("bin").agg(F.sum("n").alias("n"), F.sum("good").alias("good")).orderBy("bin").collect()
    at, n, good = (np.array([row[name] for row in levels], dtype=float) for name in ("bin", "n", "good"))
    return Model(mean, scale, weights, LOWEST + (at + 0.5) * (HIGHEST - LOWEST) / BINS, isotonic(n, good))


def held_out(doc_id: Column, parts: int = 5) -> Column:
    """Whether a document is kept from learning: its id's CRC-32 is a multiple of ``parts``; a null id is."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == 0, F.lit(True))


def labelled_rows(df: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """Statistics and labels of the rows to learn from, stored once."""
    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).where(~held_out(F.col("key")))
    known = labels.select(F.col(key).alias("key"), F.col(label).cast("double").alias("good"))
    known = known.where(F.col("good").isin(0.0, 1.0) & F.col("key").isNotNull())
    joined = rows.select("key", text_statistics("text").alias("statistics")).join(known, "key")
    return stored(joined.select("statistics", "good"), "labelled")


def score_texts(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """The rows with the probability that their text is good; a column named like ``out`` is replaced."""
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(DoubleType())
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(sent.value.score(_rows_of(texts)), pa.float64())

    found, name = with_new(df, "scored", scored(F.col(text).cast("string")))
    return found.withColumn(out, F.col(name)).drop(name)
