"""Quality rules as weak supervision: rules vote or abstain, EM weighs them.

Each rule looks at counts of a whole text and votes good (1), bad (-1) or abstains (0).
A document's hidden class is good or bad; given the class, the rules vote independently.
Expectation-maximisation estimates how often each rule votes good, bad or not at all in
either class, and how many documents are good; the posterior probability of the good
class then takes the place of "all rules must pass".

The model needs no more than the number of documents per combination of votes. Spark
counts the combinations (3 to the power of the rules at most, 177,147), so the fit sees all
documents at any size, and one text that fills a third of the table is one count. The
estimates lean on prior votes worth a fixed share of the documents, so that rules can
neither swap sides nor become certain.

Nulls count as empty texts; empty texts, having no words, fail the base rules. Very long
texts are counted whole. Repeated rows stay, and so do other columns, whatever their names. An
empty frame gives an empty frame.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from seedloom.llm.frames import free_name, with_new

# --- fixed values of the base rules -------------------------------------------
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MIN_WORDS, MAX_REPEAT_PERCENT = 10, 20
# ------------------------------------------------------------------------------

_SYMBOLS = frozenset(SYMBOLS)
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower",
    "n_distinct", "n_shouts", "n_marked", "n_stutter",
)


def counts_of(text: str | None) -> tuple[int, ...]:
    """The counts of one whole text, in the order of ``COUNTS``.

    Lines are those with a word, shouts words that end in an exclamation mark, marked
    words those with a symbol; a word stutters if it equals the one before.
    """
    raw = (text or "").encode("utf-8")
    words = raw.split()
    if not words:
        return (0,) * len(COUNTS)
    spaces = len(raw) - len(raw.translate(None, SPACES))
    lines = [line for line in raw.split(b"\n") if line.strip(SPACES)] if b"\n" in raw else [raw]
    return (
        len(words),
        len(text) - spaces,
        len(raw) - len(raw.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        sum(map(str.isupper, text)) if not text.isascii() else ascii_letters(raw)[0],
        sum(map(str.islower, text)) if not text.isascii() else ascii_letters(raw)[1],
        len(set(words)),
        sum(word.endswith(b"!") for word in words) if b"!" in raw else 0,
        sum(not word.isdisjoint(_SYMBOLS) for word in map(set, words)) if not _SYMBOLS.isdisjoint(raw) else 0,
        sum(map(eq, words, words[1:])),
    )


def ascii_letters(raw: bytes) -> tuple[int, int]:
    """Upper- and lower-case letters of ASCII bytes."""
    found = np.bincount(np.frombuffer(raw, dtype=np.uint8), minlength=128)
    return int(found[65:91].sum()), int(found[97:123].sum())


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that the text holds twice or more, the first one included."""
    windows = list(zip(*(words[at:] for at in range(window))))
    if len(set(windows)) == len(windows):
        return 0
    often = Counter(windows)
    total, covered = 0, 0
    for at, found in enumerate(windows):
        if often[found] > 1:
            total += at + window - max(at, covered)
            covered = at + window
    return total




@F.arrow_udf(StructType([StructField(name, LongType()) for name in COUNTS]))
def text_counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        rows = np.array([counts_of(text.as_py()) for text in texts], dtype=np.int64).reshape(-1, len(COUNTS))
        yield pa.StructArray.from_arrays([pa.array(rows[:, i]) for i in range(len(COUNTS))], names=list(COUNTS))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > MAX_REPEAT_PERCENT * n_words)


def vote(bad: Column, good: Column | None = None) -> Column:
    """-1, 1 or 0 for an abstention; a rule without ``good`` is a detector, which knows bad texts only."""
    voted = F.when(bad, F.lit(-1))
    return (voted if good is None else voted.when(good, F.lit(1))).otherwise(F.lit(0))


def rules(c) -> dict[str, Column]:
    """Votes by name; ``c`` maps a count to its column."""
    words, letters = c("n_words"), c("n_upper") + c("n_lower")
    return {
        "length": vote(words < 5, words >= 50),
        "word_length": vote(
            (c("word_chars") < 2 * words) | (c("word_chars") > 14 * words),
            (c("word_chars") >= 3 * words) & (c("word_chars") <= 10 * words),
        ),
        "variety": vote(10 * c("n_distinct") < words, (3 * c("n_distinct") >= words) & (words >= 20)),
        "symbols": vote(5 * c("n_symbols") > words),
        "dense_symbols": vote(12 * c("n_symbols") > c("word_chars")),
        "marked_words": vote(10 * c("n_marked") > 3 * words),
        "upper_case": vote(2 * c("n_upper") > letters),
        "shouts": vote(5 * c("n_shouts") > words),
        "repeats": vote(100 * c("n_repeat_words") > MAX_REPEAT_PERCENT * words),
        "stutter": vote(5 * c("n_stutter") > words),
        "lines": vote(2 * c("n_dup_lines") > c("n_lines")),
    }


@dataclass(frozen=True)
class VoteModel:
    """log P(good) - log P(bad) of the classes, and per rule of a bad vote, none and a good vote."""

    prior: float
    weights: tuple[tuple[float, float, float], ...]

    def posterior(self, votes: list[Column]) -> Column:
        odds = F.lit(self.prior)
        for column, (bad, none, good) in zip(votes, self.weights):
            odds = odds + F.when(column < 0, bad).when(column > 0, good).otherwise(none)
        return 1 / (1 + F.exp(-odds))


#: Shares of bad, absent and good votes by class as they are taken to be before any is seen,
#: and the weight of that belief as a share of the documents.
BELIEF = {"good": (0.002, 0.498, 0.5), "bad": (0.3, 0.35, 0.35)}
BELIEF_WEIGHT, GOOD_SHARE, ROUNDS = 0.02, 0.85, 100


def fit_votes(combinations: np.ndarray, documents: np.ndarray, rounds: int = ROUNDS) -> VoteModel:
    """EM over combinations of votes (rows of -1, 0, 1) and the number of documents with each."""
    n_rules = combinations.shape[1]
    shown = np.stack([combinations == value for value in (-1, 0, 1)], axis=2).astype(float)
    total = float(documents.sum())
    belief = np.stack([np.tile(BELIEF[name], (n_rules, 1)) for name in ("good", "bad")])
    share, chances = GOOD_SHARE, belief.copy()
    for _ in range(rounds if total else 0):
        logs = np.einsum("nrv,crv->nc", shown, np.log(chances)) + np.log([share, 1 - share])
        logs -= logs.max(axis=1, keepdims=True)
        class_of = np.exp(logs)
        class_of *= (documents / class_of.sum(axis=1))[:, None]
        weight = BELIEF_WEIGHT * total
        share = (class_of[:, 0].sum() + weight * GOOD_SHARE) / (total + weight)
        chances = np.einsum("nrv,nc->crv", shown, class_of) + weight * belief
        chances /= chances.sum(axis=2, keepdims=True)
    weights = np.log(chances[0]) - np.log(chances[1])
    return VoteModel(float(np.log(share / (1 - share))), tuple(map(tuple, weights.tolist())))


def judge(df: DataFrame, text: str = "text", out: str = "quality", threshold: float = 0.5) -> DataFrame:
    """The rows with a struct column ``out``: the counts, ``base_failed``, ``posterior`` and ``kept``.

    A row is kept if it passes the base rules and its posterior probability of being good
    is at least ``threshold``. A column named like ``out`` is replaced.
    """
    counted, name = with_new(df, "counts", text_counts(F.col(text).cast("string")))
    votes = list(rules(lambda count: F.col(f"{name}.{count}")).values())
    names = [f"vote_{i}" for i in range(len(votes))]
    found = (
        counted.select(*[v.cast("int").alias(n) for v, n in zip(votes, names)])
        .groupBy(*names).agg(F.count(F.lit(1)).alias("documents")).orderBy(*names).collect()
    )
    model = fit_votes(
        np.array([row[:-1] for row in found], dtype=int).reshape(-1, len(votes)),
        np.array([row[-1] for row in found], dtype=float),
    )
    failed = base_failed(F.col(f"{name}.n_words"), F.col(f"{name}.n_repeat_words"))
    probability = free_name(counted, "posterior")
    rated = counted.withColumn(probability, model.posterior(votes))
    fields = [F.col(f"{name}.{count}").alias(count) for count in COUNTS]
    verdict = F.struct(
        *fields, failed.alias("base_failed"), F.col(probability).alias("posterior"),
        (~failed & (F.col(probability) >= threshold)).alias("kept"),
    )
    result, new = with_new(rated, "verdict", verdict)
    return result.withColumn(out, F.col(new)).drop(name, probability, new)
