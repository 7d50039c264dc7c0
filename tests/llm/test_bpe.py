"""The byte-pair codec, token counts and packing against the tokenizers library."""

import random
import struct
from collections import defaultdict

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from seedloom.llm import bpe, packing, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
PARTS = [
    " ", "  ", "\n", "\t", "a", "'s", "'LL", "é", "<|endoftext|>", "<|endof", " ", "\U0001f600", "՘", "1", "23",
    "-", "----", "aaaaaaa", "\x1c", "　", "日本", "ſ", "​", "'", "Konst", " the", "."
]


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def packed(ids):
    return struct.pack(f"<{len(ids)}I", *ids)


@given(st.lists(st.sampled_from(PARTS), max_size=14).map("".join))
@settings(max_examples=400, deadline=None)
def test_parts_as_the_library_encodes(text):
    own = bpe.codec(PATH)
    assert own.encode(text) == packed(ids_of(text))
    assert own.decode(own.encode(text)) == LIBRARY.decode(ids_of(text), skip_special_tokens=False) == text


@given(st.text(max_size=30))
@settings(max_examples=400, deadline=None)
def test_any_text_as_the_library_encodes(text):
    assert bpe.codec(PATH).encode(text) == packed(ids_of(text))


def test_pairs_are_compatible_if_merges_leave_them_apart():
    own, draw = bpe.codec(PATH), random.Random(1)
    merges = own._rules[0]
    for _ in range(3000):
        left, right = draw.randrange(50256), draw.randrange(50256)
        text = own.text_of[left] + own.text_of[right]
        ids = [own.tokens[c] for c in text]
        while True:
            ranked = [(merges[p], at) for at, p in enumerate(zip(ids, ids[1:])) if p in merges]
            if not ranked:
                break
            at = min(ranked)[1]
            ids[at : at + 2] = [own.tokens[own.text_of[ids[at]] + own.text_of[ids[at + 1]]]]
        assert own.compatible(left, right) == (ids == [left, right])


def test_long_pre_token_and_broken_bytes():
    own = bpe.codec(PATH)
    text = "ab" * 100_000 + "-" * 50_000
    assert own.encode(text) == packed(ids_of(text))
    half = LIBRARY.encode("日", add_special_tokens=False).ids[:1]
    assert own.decode(packed(half)) == LIBRARY.decode(half, skip_special_tokens=False)


def test_caches_forget_without_changing_results(monkeypatch, prose):
    monkeypatch.setattr(bpe, "UNIT_CACHE", 40)
    monkeypatch.setattr(bpe, "PIECE_CACHE", 20)
    monkeypatch.setattr(bpe, "PAIR_CACHE", 10)
    own = bpe.BytePairCodec(PATH)
    for seed in range(20):
        assert own.encode(prose(80, seed)) == packed(ids_of(prose(80, seed)))
    assert len(own.spaced) <= 20


def test_encode_and_decode_frames(odd_documents, no_documents):
    encoded = bpe.encode_texts(odd_documents, PATH)
    assert set(odd_documents.columns) | {"ids"} == set(encoded.columns)
    for row in bpe.decode_ids(encoded, PATH).select("text", "ids", bpe.n_tokens().alias("m"), "decoded").collect():
        assert (bytes(row["ids"]), row["m"]) == (packed(ids_of(row["text"])), len(ids_of(row["text"])))
        assert row["decoded"] == (row["text"] or "")
    assert bpe.encode_texts(no_documents, PATH).count() == 0
    columns = ["doc_id", "text", "ids", "decoded"]
    both = bpe.encode_and_decode(odd_documents, PATH).select(*columns).collect()
    apart = bpe.decode_ids(encoded, PATH).select(*columns).collect()
    assert sorted(map(repr, both)) == sorted(map(repr, apart))
    assert bpe.encode_and_decode(no_documents, PATH).count() == 0


def test_count_tokens(odd_documents, no_documents, prose):
    counted = token_counts.count_tokens(odd_documents, PATH)
    assert set(counted.columns) == set(odd_documents.columns) | {"n_tokens"}
    for row in counted.select("text", "n_tokens").collect():
        assert row["n_tokens"] == len(ids_of(row["text"]))
    assert token_counts.count_tokens(no_documents, PATH).count() == 0


def test_counter_without_and_with_table(prose):
    texts = [prose(50, seed) for seed in range(5)] + ["", None, " a", "a ", "a  b", "x<|endoftext|>y", "\n\n a"]
    own = bpe.codec(PATH)
    table = {unit: len(own.spaced[unit]) // 4 for unit in set(prose(2000, 9).split(" "))}
    for known in ({}, table):
        counter = token_counts.TokenCounter(PATH, token_counts.pack_table(known))
        assert [counter.count(text) for text in texts] == [len(ids_of(text)) for text in texts]


# --- packing -----------------------------------------------------------------


@given(
    st.lists(st.tuples(st.integers(1, 60), st.integers(0, 70)), max_size=25),
    st.integers(1, 40), st.integers(1, 5), st.integers(1, 40),
)
@settings(max_examples=300, deadline=None)
def test_place_holds_every_token_once_within_limits(examples, tokens, segments, loss_tokens):
    limits = packing.Limits(tokens, segments, loss_tokens)
    lengths, loss_starts = [e[0] for e in examples], [e[1] for e in examples]
    seen = defaultdict(list)
    for sequence in packing.place(lengths, loss_starts, limits):
        assert 0 < sum(p.length for p in sequence) <= tokens and len(sequence) <= segments
        assert sum(packing.loss_of(p.start, p.length, loss_starts[p.example]) for p in sequence) <= loss_tokens
        for p in sequence:
            seen[p.example] += range(p.start, p.start + p.length)
    assert {e: sorted(t) for e, t in seen.items()} == {e: list(range(n)) for e, n in enumerate(lengths)}


def test_last_sequences_are_powers_of_two():
    rows = packing.place([700, 600, 500], [0, 0, 0], packing.Limits(2048))
    assert [sum(p.length for p in row) for row in rows] == [1024, 512, 256, 8]


def test_pack_texts(odd_documents, no_documents):
    pieces = packing.pack_texts(odd_documents, PATH, end_id=1, block=4).collect()
    by_sequence = defaultdict(list)
    tokens = 0
    for p in pieces:
        by_sequence[p["sequence_id"]].append(p)
        assert len(p["ids"]) == 4 * p["length"] > 0
        tokens += p["length"]
    expected = [ids_of(row["text"]) + [1] for row in odd_documents.select("text").collect()]
    assert tokens == sum(map(len, expected))
    for rows in by_sequence.values():
        rows.sort(key=lambda p: p["offset"])
        ends = [0]
        for p in rows:
            assert p["offset"] == ends[-1]
            ends.append(p["offset"] + p["length"])
        assert ends[-1] <= 2048
    long = sorted((p for p in pieces if p["key"] == 6), key=lambda p: p["start"])
    own = next(ids for ids in expected if len(ids) == long[0]["doc_tokens"])
    assert b"".join(bytes(p["ids"]) for p in long) == packed(own)
    assert packing.pack_texts(no_documents, PATH, end_id=1).count() == 0


def test_pack_instruction_rows(spark, prose):
    rows = [(i, prose(20 + i, i), 30) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, prompt int")
    limits = packing.Limits(tokens=512, segments=6, loss_tokens=200)
    pieces = packing.pack_texts(df, PATH, end_id=1, loss_from="prompt", limits=limits).collect()
    by_sequence = defaultdict(list)
    for p in pieces:
        by_sequence[p["sequence_id"]].append(p)
    for found in by_sequence.values():
        assert sum(p["length"] for p in found) <= 512 and len(found) <= 6 and sum(p["loss_tokens"] for p in found) <= 200
    expected = sum(len(ids_of(t)) + 1 - len(ids_of(t[:30])) for _, t, _ in rows)
    assert sum(p["loss_tokens"] for p in pieces) == expected


def test_room_is_needed(no_documents):
    with pytest.raises(ValueError):
        packing.pack_texts(no_documents, PATH, end_id=1, limits=packing.Limits(tokens=0))


@pytest.mark.parametrize("loss_start, limits", [(0, packing.Limits()), (0, packing.Limits(512, 256, 200)), (2, packing.Limits(512, 40, 30))])
def test_every_underfull_sequence_is_cut_into_powers_of_two(loss_start, limits):
    """Very short texts use up the segments, or loss-bearing tokens run out, long before a sequence is full."""
    lengths = [3] * 2000 + [900]
    places = packing.place(lengths, [loss_start] * len(lengths), limits)
    sizes = [sum(p.length for p in sequence) for sequence in places]
    assert sum(sizes) == sum(lengths) and all(n == limits.tokens or n & (n - 1) == 0 for n in sizes)
    assert all(len(sequence) <= limits.segments for sequence in places)
    held = sorted((p.example, p.start + i) for sequence in places for p in sequence for i in range(p.length))
    assert held == [(example, i) for example, n in enumerate(lengths) for i in range(n)]
