"""The pipeline's stages on odd rows and given tables, and the registered queries."""

import os
import random
import struct
import zlib
from collections import defaultdict

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from seedloom.llm import jaccard_join, pii, quality_rules
from seedloom.llm.queries import CHAT_LIMITS, EXAMPLE_KEY, QUERIES, SQL

SF = "/root/testdata/sf0.001"
GIVEN = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def rows_of(df, columns):
    return sorted(repr(tuple(row)) for row in df.select(*columns).collect())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_against_sql(spark, name):
    duck = duckdb.connect()
    for table in GIVEN:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = duck.execute(SQL[name])
    columns = [c[0] for c in found.description]
    df = QUERIES[name](spark, SF)
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df, columns) == sorted(map(repr, found.fetchall()))


def test_all_are_registered():
    names = [name for name in entry.queries() if name == "pipeline" or name.startswith("op")]
    assert {name.split("_")[0] for name in names} == {f"op{n}" for n in range(1, 14)} | {"pipeline"} and len(names) == 14
    assert set(SQL) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def ids(texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return {key: library.encode(text, add_special_tokens=False).ids for key, text in texts.items()}


def test_token_queries(spark, texts, ids):
    counted = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op3_token_counts"](spark, SF).collect()}
    assert counted == {k: (len(t.encode()), len(ids[k]), len(ids[k]) > 512) for k, t in texts.items()}
    import hashlib

    sha = lambda b: hashlib.sha256(b).hexdigest()
    coded = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op5_bpe"](spark, SF).collect()}
    assert coded == {k: (len(v), sha(struct.pack(f"<{len(v)}I", *v)), sha(texts[k].encode())) for k, v in ids.items()}


def test_packing_query(spark, ids):
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in QUERIES["op10_packing"](spark, SF).collect():
        whole = [*ids[r["doc_id"]], 1]
        piece = whole[r["start"] : r["start"] + r["length"]]
        assert r["doc_tokens"] == len(whole) and len(piece) == r["length"] > 0
        assert r["ids_crc32"] == zlib.crc32(struct.pack(f"<{len(piece)}I", *piece))
        by_doc[r["doc_id"]].append((r["start"], r["length"]))
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for found, total in [*((v, len(ids[k]) + 1) for k, v in by_doc.items()), *((v, None) for v in by_sequence.values())]:
        at = 0
        for start, length in sorted(found):
            assert start == at
            at += length
        assert at == total if total else at <= 2048
    sizes = [sum(n for _, n in v) for v in by_sequence.values()]
    assert sum(2048 - n for n in sizes if n & (n - 1)) <= 0.02 * sum(sizes)


def test_chat_packing_query(spark):
    """Every limit holds, loss-bearing tokens bind, and every token of every view is there once."""
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sequences = defaultdict(list)
    for r in QUERIES["chat_packing"](spark, SF).collect():
        sequences[r["sequence_id"]].append(r)
    sums = [(sum(p["length"] for p in found), len(found), sum(p["loss_tokens"] for p in found)) for found in sequences.values()]
    for at, most in enumerate((CHAT_LIMITS.tokens, CHAT_LIMITS.segments, CHAT_LIMITS.loss_tokens)):
        assert max(s[at] for s in sums) <= most
    assert max(s[2] for s in sums) == CHAT_LIMITS.loss_tokens
    for found in sequences.values():
        at = 0
        for piece in sorted(found, key=lambda p: p["offset"]):
            assert piece["offset"] == at
            at += piece["length"]
    views = QUERIES["op4_chat_views"](spark, SF).collect()
    whole = sum(len(library.encode(r["segment"], add_special_tokens=False).ids) + 1 for r in views)
    assert sum(s[0] for s in sums) == whole


def test_stages_against_plain_python(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {r["doc_id"] for r in quality_rules.judge(docs).where("quality.kept").collect()}
    first = corpus_pipeline.keep_good_by_rules(spark, docs, SF)
    assert first.columns == docs.columns and {r["doc_id"] for r in first.collect()} == kept
    hidden = corpus_pipeline.hide_personal_data(spark, docs, SF)
    own = pii.Pseudonyms(EXAMPLE_KEY)
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in hidden.collect()} == {
        k: (own.replace(t)[0], len(own.replace(t)[0])) for k, t in texts.items()
    }
    single = corpus_pipeline.keep_one_of_near_copies(spark, docs, SF)
    join = jaccard_join.JaccardJoin(docs, size=5, threshold=jaccard_join.Threshold(80, 100))
    labels = join.components().collect()
    expected = {r["component"] for r in labels if r["n"]} | {r["key"] for r in labels if not r["n"]}
    found = [r["doc_id"] for r in single.collect()]
    assert len(found) == len(set(found)) and set(found) == expected
    second = corpus_pipeline.keep_good_by_classifier(spark, docs, SF)
    assert second.columns == docs.columns
    scored = QUERIES["op8_quality_classifier"](spark, SF).collect()
    assert {r["doc_id"] for r in second.collect()} == {r["doc_id"] for r in scored if r["predicted"]}
    quality = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [r["predicted"] for r in scored if quality.get(r["doc_id"]) == 1]
    assert sum(good) >= 0.97 * len(good)


def test_near_copies_as_all_pairs_of_five_words(spark):
    """The stage against brute force at five words and 0.8, on copies between its bar and op7's."""
    draw = random.Random(21)
    words = [f"w{i}" for i in range(5000)]
    rows = []
    for _ in range(8):
        base = draw.sample(words, 200)
        rows.append((len(rows), " ".join(base)))
        for n in (170, 155):  # 15 and 22.5 % cut off
            rows.append((len(rows), " ".join(base[:n])))
        for at in ([50, 150], [20, 60, 100, 140], [20, 50, 80, 110, 140, 170]):
            rows.append((len(rows), " ".join(draw.choice(words) if i in at else w for i, w in enumerate(base))))
    rows += [(len(rows) + i, text) for i, text in enumerate(["one two three four", "one two three four", "", "one two"])]
    grams = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := text.split()) else set() for _, text in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if grams[i] and 100 * len(grams[i] & grams[j]) >= 80 * len(grams[i] | grams[j]):
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [r["doc_id"] for r in corpus_pipeline.keep_one_of_near_copies(spark, docs, SF).collect()]
    assert sorted(kept) == sorted(set(label))
    assert len(kept) < jaccard_join.JaccardJoin(docs).representatives().count()


def test_classifier_learns_from_labels_of_rejected_documents(spark):
    """On stage 1's output, and bad documents without a label that slipped past it, op8's model decides."""
    documents, labels = (spark.read.parquet(f"{SF}/{name}.parquet") for name in ("documents", "labels"))
    first = corpus_pipeline.keep_good_by_rules(spark, documents, SF)
    bad = documents.join(labels.where("quality = 0").select("doc_id").distinct(), "doc_id", "left_semi")
    slipped = bad.withColumn("doc_id", bad["doc_id"] + 10**9).select(first.columns)
    kept = {r["doc_id"] for r in corpus_pipeline.keep_good_by_classifier(spark, first.unionByName(slipped), SF).collect()}
    good = {r["doc_id"] for r in QUERIES["op8_quality_classifier"](spark, SF).collect() if r["predicted"]}
    slipped, first = ({r["doc_id"] for r in df.collect()} for df in (slipped, first))
    assert kept == (first & good) | {i for i in slipped if i - 10**9 in good}
    assert slipped and len(kept & slipped) < 0.2 * len(slipped)


def test_stages_take_odd_rows(spark, odd_documents, no_documents):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd_documents, no_documents):
            done = stage(spark, docs, SF)
            rows = done.count()
            assert (rows > 0) == (docs is odd_documents), name
            if name != "packing":
                assert done.columns == docs.columns and rows <= docs.count()


def test_run(spark):
    pieces = corpus_pipeline.run(spark, SF)
    assert pieces.count() > 0 and "sequence_id" in pieces.columns
    assert corpus_pipeline.ORACLE_SQL is None


def test_scratch_is_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir").removeprefix("file:")
    before = set(os.listdir(root))
    QUERIES["op2_url_filter"](spark, SF).count()
    assert set(os.listdir(root)) - before
