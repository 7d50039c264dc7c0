"""Alignment of two tokenizers against whole texts, token pair by token pair."""

import random
from collections import Counter
from hashlib import sha256

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from seedloom.llm import alignment
from seedloom.llm.bpe import byte_of_char
from seedloom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = Tokenizer.from_file(PATHS[0])
LIBRARY.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def tokens_of(text):
    """Ids with byte ranges of A and B over the whole text, or two empty lists."""
    to_byte = byte_of_char()
    coded = LIBRARY.encode(" " + text, add_special_tokens=False)
    a = [(i, bytes(to_byte[c] for c in token)) for i, token in zip(coded.ids, coded.tokens)]
    b = []
    for i in PIECES.encode(text):
        piece = PIECES.id_to_piece(i)
        b.append((i, bytes([int(piece[1:-1], 16)]) if PIECES.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if not text or not b"".join(x for _, x in a) == whole == b"".join(x for _, x in b):
        return [], []

    def placed(tokens):
        out, at = [], 0
        for i, data in tokens:
            out.append((i, at, at + len(data)))
            at += len(data)
        return out

    return placed(a), placed(b)


def expected(texts):
    """Per text the columns of the operator, and the links per pair of ids."""
    found, count = [], Counter()
    for text in texts:
        a, b = tokens_of(text or "")
        links, first = [], 0
        for i, start, end in a:  # b is sorted, so what ended before this token can't meet a later one
            while first < len(b) and b[first][2] <= start:
                first += 1
            for j, other, last in b[first:]:
                if other >= end:
                    break
                if max(start, other) < min(end, last):
                    links.append((i, j))
        count.update(links)
        ends = sorted({e for _, _, e in a} & {e for _, _, e in b})
        groups = ";".join(
            ",".join(str(i) for i, _, e in a if low < e <= high) + "|" + ",".join(str(j) for j, _, e in b if low < e <= high)
            for low, high in zip([0, *ends], ends)
        ) if len(a) < 3000 else None
        found.append((a, b, ends, links, groups))
    best = Counter()
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    rows = [
        (len(a), len(b), len(ends), len(links), sum(count[p] == best[p[1]] for p in links), sum(count[p] for p in links), groups)
        for a, b, ends, links, groups in found
    ]
    return rows, count, best


def same(found, rows):
    for r, row in zip(found, rows, strict=True):
        assert (r["n_a"], r["n_b"], r["n_groups"], r["n_links"], r["n_best"], r["count_sum"]) == row[:6]
        if row[6] is not None:
            assert r["groups_sha256"] == (sha256(row[6].encode()).hexdigest() if row[0] else "")


def test_query_against_all_token_pairs(spark):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = QUERIES["op11_alignment"](spark, SF).collect()
    rows, _, _ = expected([texts[r["doc_id"]] for r in found])
    assert len(found) == len(texts)
    same(found, rows)


ODD = [
    "", None, " ", "  ", "\n", "a", " a", "a ", "a  b", "a \n b", "x\ny z", "  lead and trail  ", "\ta\t b", "▁a b", "b ▁", "<s> a </s>",
    "<|endoftext|> x <|endoftext|>", "世界 \U0001f600\U0001f600 b", "é ́e", "\U000e0001 x", "a\x00b c", "a\x1c b \x1cc", "a b   c",
    "don't we'll 'S x's", "1,234.5 67", "\U0001f468‍\U0001f469‍\U0001f467 fam", "﻿ x ﻿y", " a  b", "x" * 3000, "\U0001f600" * 500,
    "각 각", "a▁ b", "᠎a b", "a\u0085b \u0085", "� x", "\U0010ffff y",
]


@pytest.mark.parametrize("common", [0, 40, 1 << 20])
def test_odd_texts(spark, prose, common):
    draw = random.Random(5)
    signs = [chr(c) for c in (32, 32, 32, 10, 9, 0x2581, 0xA0, 0xE9, 0x4E16, 0x1F600, 0x301, 39, 46, 115, 116, 97, 97, 98, 0x2003, 0x3C, 0xAD)]
    noise = ["".join(draw.choice(signs) for _ in range(draw.randint(1, 40))) for _ in range(150)]
    texts = [*ODD, *noise, *(prose(60, s) for s in range(6)), prose(30, 1), prose(2000, 7)]
    df = spark.createDataFrame([(i if i % 9 else None, text, "x", "y") for i, text in enumerate(texts)], "doc_id long, text string, key string, block string")
    one = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found, pairs = alignment.align(one.repartition(3), *PATHS, common=common)
    rows, count, best = expected(texts)
    found = sorted(found.collect(), key=lambda r: r["key"])
    same(found, rows)
    assert [r["groups"] for r, row in zip(found, rows) if row[6] is not None] == [row[6] if row[0] else "" for row in rows if row[6] is not None]
    assert {(r["a"], r["b"]): (r["n"], r["best"]) for r in pairs.collect()} == {p: (n, n == best[p[1]]) for p, n in count.items()}
    again = alignment.align(df, *PATHS, common=common)[0]
    assert sorted(str(tuple(r)[1:]) for r in again.collect()) == sorted(str(tuple(r)[1:]) for r in found)


def test_empty_tables_and_small_caches(spark, no_documents, prose, monkeypatch):
    result, pairs = alignment.align(no_documents, *PATHS)
    assert result.collect() == [] and pairs.collect() == []
    own = alignment.Aligner(*PATHS)
    assert own.cuts
    texts = [prose(300, 20 + i) + " ▁x" * (i == 3) for i in range(8)]
    rows, _, _ = expected(texts)
    monkeypatch.setattr(alignment, "UNITS", 50)
    monkeypatch.setattr(alignment, "AT_ONCE", 7)
    for i, text in enumerate(texts):
        total = alignment._Pairs()
        doc = alignment.block_rows(own, [i], [text], 5, True, total).to_pylist()[0]
        counts = [n for batch in total.rows() for n in batch.to_pylist()[0]["n"]]
        assert (doc["n_a"], doc["n_b"], doc["n_groups"], doc["n_links"]) == rows[i][:4] and sum(counts) == rows[i][3]
        assert doc["row"] == 5
        assert doc["groups"] == (rows[i][6] if rows[i][0] else "")


def test_tasks_merge_their_pairs(monkeypatch):
    import numpy as np

    monkeypatch.setattr(alignment, "GATHERED", 5)
    total = alignment._Pairs()
    for _ in range(7):
        total.add(np.array([1, 5, 9]), np.array([1, 2, 3]))
    rows = [r for batch in total.rows() for r in batch.to_pylist()]
    assert [(r["pairs"], r["n"], r["row"]) for r in rows] == [([1, 5, 9], [7, 14, 21], None)]
    for numbers in ([], [0], [3, 3, 400, 70_000, 1 << 40]):
        assert alignment.unpacked(alignment.packed(np.array(numbers, dtype=np.int64))).tolist() == numbers
