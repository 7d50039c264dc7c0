"""Quality rules and the quality classifier against plain Python and held-out labels."""

import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from seedloom.llm import quality_classifier as classifier
from seedloom.llm import quality_rules as rules

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain_counts(text):
    """The base counts, written from their definition."""
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    repeated = set()
    for i, window in enumerate(windows):
        if windows.count(window) > 1:
            repeated |= set(range(i, i + 5))
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        sum(line in lines[:i] for i, line in enumerate(lines)), len(repeated),
    )


@given(st.lists(st.sampled_from(["a", "b", "é ", " ", "\n", "\x0b", "\x85", "\xa0", "# ", "c\n", "a b c d e "]), max_size=60))
@settings(max_examples=400, deadline=None)
def test_counts(parts):
    text = "".join(parts)
    assert rules.counts_of(text)[:5] == plain_counts(text)


def test_judge(odd_documents, no_documents):
    judged = rules.judge(odd_documents)
    assert set(judged.columns) == set(odd_documents.columns) | {"quality"}
    assert judged.count() == odd_documents.count()
    for row in judged.select("text", "quality.*").collect():
        counts = plain_counts(row["text"]) if len(row["text"] or "") < 10_000 else rules.counts_of(row["text"])[:5]
        assert tuple(row[1:6]) == counts
        failed = counts[0] < 10 or 100 * counts[4] > 20 * counts[0]
        assert row["base_failed"] == failed and not (failed and row["kept"])
        assert row["kept"] == (not failed and row["posterior"] >= 0.5)
    assert rules.judge(no_documents).count() == 0


def test_votes_recover_hidden_classes():
    draw = np.random.default_rng(5)
    good = draw.random(20_000) < 0.8
    votes = np.zeros((len(good), 6), dtype=int)
    for rule in range(6):
        speaks = draw.random(len(good)) < 0.6
        right = draw.random(len(good)) < (0.75 + 0.04 * rule)
        votes[:, rule] = np.where(speaks, np.where(right == good, 1, -1), 0)
    combinations, documents = np.unique(votes, axis=0, return_counts=True)
    model = rules.fit_votes(combinations, documents)
    weights = np.array(model.weights)
    odds = model.prior + sum(weights[r][votes[:, r] + 1] for r in range(6))
    accuracy = ((odds > 0) == good).mean()
    true = np.array([0.75 + 0.04 * rule for rule in range(6)])
    best = ((votes @ np.log(true / (1 - true)) + np.log(0.8 / 0.2) > 0) == good).mean()
    assert ((votes.sum(axis=1) > 0) == good).mean() < accuracy and accuracy > best - 0.01
    assert (weights[:, 2] > weights[:, 0]).all()


def test_fit_without_documents():
    assert rules.fit_votes(np.zeros((0, 3), dtype=int), np.zeros(0)).weights


def test_rules_keep_good_and_reject_bad(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    judged = rules.judge(spark.read.parquet(f"{SF}/documents.parquet"), out="judged").join(labels, "doc_id")
    found = [tuple(r) for r in judged.select("quality", "judged.base_failed", "judged.kept").collect()]
    bad = [kept for label, failed, kept in found if label == 0 and not failed]
    good = [kept for label, failed, kept in found if label == 1 and not failed]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.1


# --- classifier --------------------------------------------------------------


def test_isotonic_is_the_best_rising_fit():
    total, good = np.array([10.0, 5, 5, 20, 1]), np.array([1.0, 3, 1, 15, 0])
    levels = classifier.isotonic(total, good)
    assert (np.diff(levels) >= 0).all()
    assert levels.tolist() == [0.1, 0.4, 0.4, 15 / 21, 15 / 21]


def test_fourier_features_approach_the_kernel():
    rows = np.random.default_rng(1).normal(size=(40, len(classifier.STATISTICS)))
    waves = classifier.fourier(rows, np.zeros(rows.shape[1]), np.ones(rows.shape[1]))[:, :-1]
    apart = ((rows[:, None] - rows[None]) ** 2).sum(axis=2)
    assert np.abs(waves @ waves.T - np.exp(-apart / (2 * classifier.WIDTH**2))).max() < 0.35


def test_held_out(spark):
    ids = [0, 1, 7, -3, 10**15, None]
    df = spark.createDataFrame([(i,) for i in ids], "doc_id long").withColumn("h", classifier.held_out(classifier.F.col("doc_id")))
    assert [r["h"] for r in df.collect()] == [i is None or zlib.crc32(str(i).encode()) % 5 == 0 for i in ids]


def test_classifier_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    model = classifier.fit(classifier.labelled_rows(docs, labels))
    scored = classifier.score_texts(docs, model).withColumn("h", classifier.held_out(docs["doc_id"])).join(labels, "doc_id")
    found = [(r["score"], r["quality"]) for r in scored.where("h").collect()]
    assert all(0 <= score <= 1 for score, _ in found)
    assert np.mean([(score >= 0.3) == bool(label) for score, label in found]) > 0.95


def test_classifier_takes_odd_rows(spark, odd_documents, no_documents):
    labels = spark.createDataFrame([(1, 1), (2, 0), (8, 1), (8, 0), (None, 1), (11, 0), (6, None), (7, 5)], "doc_id long, quality int")
    model = classifier.fit(classifier.labelled_rows(odd_documents, labels))
    scored = classifier.score_texts(odd_documents, model)
    assert scored.count() == odd_documents.count() and set(odd_documents.columns) <= set(scored.columns)
    assert all(0 <= r["score"] <= 1 for r in scored.select("score").collect())
    assert classifier.score_texts(no_documents, model).count() == 0
    nothing = classifier.fit(classifier.labelled_rows(no_documents, labels))
    assert {r["score"] for r in classifier.score_texts(odd_documents, nothing).select("score").collect()} == {0.5}


def test_one_class_of_labels(spark, odd_documents):
    labels = spark.createDataFrame([(i, 1) for i in range(12)], "doc_id long, quality int")
    model = classifier.fit(classifier.labelled_rows(odd_documents, labels))
    assert {r["score"] for r in classifier.score_texts(odd_documents, model).select("score").collect()} == {1.0}


def test_normal_equations_do_not_depend_on_tasks(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rows = classifier.labelled_rows(docs, labels)
    first = classifier.fit(rows)
    for parts in (1, 5, 70):
        assert first.weights == pytest.approx(classifier.fit(rows.repartition(parts)).weights, abs=1e-6)
