"""Removal of repeated passages against all windows of all documents."""

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from seedloom.llm import repeats


def expected(rows, window=13):
    """``(id, n_words, n_removed, kept)`` per row, from a dictionary of all windows."""
    last = float("inf")
    lists = [(last if key is None else key, (text or "").encode().split()) for key, text in rows]
    first = {}
    for key, words in lists:
        for at in range(len(words) - window + 1):
            name = tuple(words[at : at + window])
            first[name] = min(first.get(name, last), key)
    out = []
    for (key, words), (own, _) in zip(lists, rows):
        gone = set()
        for at in range(len(words) - window + 1):
            if first[tuple(words[at : at + window])] < key:
                gone.update(range(at, at + window))
        kept = [w for at, w in enumerate(words) if at not in gone]
        out.append((own, len(words), len(gone), b" ".join(kept).decode()))
    return out


def check(spark, rows, parts=3, **options):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    done, paths = repeats.remove_repeats(df, **options)
    found = [(r["key"], r["n_words"], r["n_removed"], r["kept"]) for r in done.collect()]
    wanted = expected(rows, options.get("window", 13))
    assert sorted(map(repr, found)) == sorted(map(repr, wanted))
    assert all(r["kept_sha256"] == sha256(r["kept"].encode()).hexdigest() for r in done.collect())
    return paths.collect()


@pytest.fixture
def family():
    """Texts with whole copies, shared passages of many lengths, repeated lines and overlaps of several sources."""
    draw = random.Random(11)
    words = [f"w{i}" for i in range(300)]

    def prose(n):
        return [draw.choice(words) for _ in range(n)]

    passages = [prose(n) for n in (12, 13, 14, 20, 50, 200, 13, 700)]
    texts = []
    for _ in range(120):
        text = prose(draw.randint(0, 40))
        for _ in range(draw.randint(0, 3)):
            passage = draw.choice(passages)
            start = draw.randint(0, len(passage) // 2)
            text += passage[start : draw.randint(start, len(passage))] if draw.random() < 0.5 else passage
            text += prose(draw.randint(0, 20))
        texts.append(" ".join(text))
    texts += [draw.choice(texts) for _ in range(30)] + ["a b " * 40, "a b " * 60, "x " * 100, "x " * 13, "x " * 12, "same line\n" * 30]
    draw.shuffle(texts)
    return texts


@pytest.mark.parametrize("parts", [1, 7])
@pytest.mark.parametrize("block", [500, 8 << 20])
def test_against_all_windows(spark, family, parts, block, monkeypatch):
    monkeypatch.setattr(repeats, "BLOCK", block)
    rows = list(enumerate(family))
    paths = check(spark, rows, parts)
    lists = {key: text.split() for key, text in rows}
    for p in paths:
        size = p["n"] + 12
        assert p["source_doc"] < p["doc"]
        source = lists[p["source_doc"]][p["source_start"] : p["source_start"] + size]
        assert lists[p["doc"]][p["start"] : p["start"] + size] == source and len(source) == size


def test_other_windows(spark, family):
    for window in (1, 3, 30):
        check(spark, list(enumerate(family[:60])), window=window)


def test_hot_anchors_travel_singly(spark, family, monkeypatch):
    monkeypatch.setattr(repeats, "LEAST_FREQUENT", 3)
    monkeypatch.setattr(repeats, "FREQUENT_ONE_IN", 200)
    texts = spark.createDataFrame([(i, 0, t) for i, t in enumerate(family)], "doc long, tag long, text string")
    assert len(repeats.frequent_anchors(texts, repeats.Hashing(0, 13)))
    check(spark, list(enumerate(family)))


def test_false_paths_are_found_out(spark, family, monkeypatch):
    """Paths that lead to other words, as equal hashes would give: the comparison fails and all is done again."""
    real_paths, real_check, seen = repeats.repeated_paths, repeats.verified, []

    def paths(texts, hashing):
        found = real_paths(texts, hashing)
        return found if hashing.attempt else found.withColumn("start", F.greatest(F.col("start") - 1, F.lit(0)))

    def watched(done):
        seen.append(real_check(done))
        return seen[-1]

    monkeypatch.setattr(repeats, "repeated_paths", paths)
    monkeypatch.setattr(repeats, "verified", watched)
    check(spark, list(enumerate(family[:60])))
    assert seen == [False, True]


def test_odd_rows(spark, odd_documents, no_documents):
    done, paths = repeats.remove_repeats(odd_documents)
    rows = [(r["doc_id"], r["text"]) for r in odd_documents.collect()]
    found = [(r["key"], r["n_words"], r["n_removed"], r["kept"]) for r in done.collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, expected(rows)))
    for df in repeats.remove_repeats(no_documents):
        assert df.collect() == []
    assert done.drop("kept").columns == repeats.remove_repeats(no_documents)[0].drop("kept").columns


def test_one_id_with_two_texts(spark):
    text = " ".join(f"t{i}" for i in range(40))
    rows = [(5, text), (5, "other words before " + text), (5, text), (7, text), (None, "z " + text), (None, text), (-3, "q")]
    check(spark, rows)
    check(spark, [(9, text), (9, text)])


def test_texts_stay_out_of_the_result(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    row = repeats.remove_repeats(df, keep_text=False)[0].collect()[0]
    assert row["kept"] is None and row["kept_sha256"] == sha256(b"a b").hexdigest()
    with pytest.raises(ValueError):
        repeats.remove_repeats(df, window=0)
