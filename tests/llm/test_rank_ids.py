"""Ids by ranks against the tokenizers library, and the two ways of packing against each other."""

import json
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from seedloom.llm import packing, rank_ids
from seedloom.llm.packing import Limits

PATH = public_tokenizers.path("byte_bpe_50k.json")
OWN = rank_ids.RankEncoder(PATH)
LIBRARY = Tokenizer.from_file(PATH)


def ids(text):
    return np.frombuffer(OWN.encode(text), dtype="<u4").tolist()


def test_noise_as_the_library():
    draw = random.Random(5)
    signs = [chr(c) for c in (32, 32, 32, 10, 9, 0x2581, 0xA0, 0xE9, 0x4E16, 0x1F600, 0x301, 39, 46, 115, 116, 97, 97, 98, 0x2003, 0x3C, 0xAD, 0x1C)]
    signs += ["<|endoftext|>", "\U0001e900", "Ⲳ", "'ve", "​"]
    assert OWN.ranked and ids(None) == ids("") == []
    for _ in range(3000):
        text = "".join(draw.choice(signs) for _ in range(draw.randint(1, 40)))
        assert ids(text) == LIBRARY.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("text", [" " * 399_999 + "a", " " * 1_500_000 + "a", "x" * 600_000, "ab " * 200_000, "\n" * 399_000 + "b", "<|endoftext|>" * 3])
def test_long_texts_and_runs(text):
    assert ids(text) == LIBRARY.encode(text, add_special_tokens=False).ids


def test_files_that_number_otherwise(tmp_path):
    with open(PATH, encoding="utf-8") as file:
        spec = json.load(file)
    merges = spec["model"]["merges"]
    spec["model"]["merges"] = [merges[1], merges[0], *merges[2:]]
    other = tmp_path / "other.json"
    other.write_text(json.dumps(spec))
    own, library = rank_ids.RankEncoder(str(other)), Tokenizer.from_file(str(other))
    text = "the their there in on antenna"
    assert not own.ranked and np.frombuffer(own.encode(text), "<u4").tolist() == library.encode(text).ids


@pytest.mark.parametrize("seed", range(60))
def test_both_ways_place_alike(seed):
    draw = random.Random(seed)
    limits = Limits(draw.choice([8, 16, 64]), draw.choice([1, 2, 3, 50]), draw.choice([4, 8, 64]))
    waiting = [packing.Piece(i, draw.randint(0, 3), draw.randint(1, min(limits.tokens, draw.choice([3, 20, 64])))) for i in range(draw.randint(1, 60))]
    none = [0] * len(waiting)
    assert packing.pack_by_length(waiting, none, limits) == packing.pack_by_product(waiting, none, limits)
