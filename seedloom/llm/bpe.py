"""Byte-level BPE: exact merges in linear time, and decoding by an offset table.

A tokenizer file in JSON gives the vocabulary, the merges and the special strings.

*Encoding.* An Aho-Corasick automaton over the vocabulary finds the longest token at a
byte. Tokens are placed from left to right, longest first; a token may stand
after another only if the two are compatible, i.e. if merging the bytes of both gives
just these two tokens. Where nothing fits, the last token is taken back and a shorter
one tried, and the position is never tried again, so the work stays linear. A row of
tokens whose neighbours are all compatible is the row that the merges give.

*Pieces.* Merges stay inside pre-tokens. A single space between two other characters
always starts a pre-token, so text is cut there first ("units", mostly a word) and
whole units are looked up in a worker's cache; only new units are split into
pre-tokens and encoded. Caches forget when full, which changes no result.

*Decoding.* The bytes of all tokens lie in one buffer with an offset per id; numpy
gathers them block by block.

Nulls: a null text encodes as the empty text, null ids decode to null. Special strings
inside a text become their ids, as the tokenizers library does by default. Very long texts and
words take linear time. An empty table gives an empty one; other columns pass unchanged.
"""

from __future__ import annotations

import json
import struct
import sys
import unicodedata
from collections.abc import Callable, Iterable, Iterator
from functools import cache, cached_property
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructField, StructType
from tokenizers import Tokenizer

from seedloom.llm.frames import in_parts, with_new

# --- fixed values: they must equal those of byte-level BPE tokenizers ---------
PRE_TOKENS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTABLE_BYTES = ((0x21, 0x7E), (0xA1, 0xAC), (0xAE, 0xFF))
# ------------------------------------------------------------------------------

UNIT_CACHE, PIECE_CACHE, PAIR_CACHE = 800_000, 60_000, 300_000
LONG_UNIT, LONG_TEXT, BLOCK = 48, 1 << 20, 1 << 16
NEVER = 1 << 62
#: Letters below are letters in every version of Unicode.
SETTLED = "\u0530"


def byte_of_char() -> dict[str, int]:
    """Vocabulary characters to bytes: printable ones stand for themselves, the rest follow from U+0100."""
    printable = [b for first, last in PRINTABLE_BYTES for b in range(first, last + 1)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(others)}


@cache
def recent_characters() -> regex.Pattern:
    """Characters newer than Unicode 3.2, whose classes differ between library versions."""
    old, ranges, first = unicodedata.ucd_3_2_0, [], None
    for code in range(sys.maxunicode + 2):
        new = code <= sys.maxunicode and old.category(chr(code)) == "Cn"
        if new and first is None:
            first = code
        elif not new and first is not None:
            ranges.append(f"\\U{first:08x}-\\U{code - 1:08x}")
            first = None
    return regex.compile(f"[{''.join(ranges)}]")


class Unsafe(Exception):
    """A unit with white space at its edge: where it ends depends on its neighbours."""


class _Units(dict):
    """Encoded units by text, of two generations: when the young one is full, those not seen since it began go."""

    def __init__(self, encode: Callable[[str], bytes], room: int):
        super().__init__()
        self.encode, self.room, self.old = encode, room // 2, {}

    def __missing__(self, unit: str) -> bytes:
        value = self.old.get(unit)
        if value is None:
            value = self.encode(unit)
            if len(unit) > LONG_UNIT:
                return value
        if len(self) >= self.room:
            self.old = dict(self)
            self.clear()
        self[unit] = value
        return value


class BytePairCodec:
    """Encodes and decodes as the tokenizers library does with the same JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or spec.get("normalizer") or spec["pre_tokenizer"]["type"] != "ByteLevel":
            raise ValueError(f"{path}: not a byte-level BPE tokenizer")
        to_byte = byte_of_char()
        #: tokens as strings of one character per byte
        self.tokens = {"".join(chr(to_byte[c]) for c in text): i for text, i in model["vocab"].items()}
        self.text_of = {i: text for text, i in self.tokens.items()}
        self.width = {i: len(text) for text, i in self.tokens.items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: special strings with conditions are not supported")
        longest_first = sorted(self.special, key=len, reverse=True)
        self._special = regex.compile("(" + "|".join(map(regex.escape, longest_first)) + ")") if self.special else None
        self._pieces = regex.compile(PRE_TOKENS)
        self._edge = regex.compile(r"^\s|\s$")
        self._path = path
        self._shorter: dict[int, int | None] = {}
        self._pairs: dict[tuple[int, int], bool] = {}
        self._known = _Units(self._encode_piece, PIECE_CACHE)
        self.first = _Units(self._encode_unit, UNIT_CACHE // 10)
        self.spaced = _Units(lambda unit: self._encode_unit(" " + unit), UNIT_CACHE)

    @cached_property
    def _rules(self) -> tuple[dict[tuple[int, int], int], dict[int, int], dict[int, tuple[int, int]]]:
        """Ranks of the merges by pair of tokens; the rank and the two parts of each merged token."""
        with open(self._path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        merges: dict[tuple[int, int], int] = {}
        formed: dict[int, int] = {}
        parts: dict[int, tuple[int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b, whole = model["vocab"][left], model["vocab"][right], model["vocab"][left + right]
            merges.setdefault((a, b), rank)
            formed.setdefault(whole, rank)
            parts.setdefault(whole, (a, b))
        return merges, formed, parts

    @cached_property
    def _library(self):
        return Tokenizer.from_file(self._path).pre_tokenizer

    @cached_property
    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for text, i in self.tokens.items():
            found.add_word(text, (i, len(text) - 1))
        found.make_automaton()
        return found

    # --- pre-tokens ----------------------------------------------------------

    def pieces(self, text: str) -> Iterable[str]:
        """Pre-tokens of a text without special strings."""
        if not text.isascii() and recent_characters().search(text):
            return [text[a:b] for _, (a, b) in self._library.pre_tokenize_str(text)]
        if len(text) > LONG_TEXT:
            return (found.group() for found in self._pieces.finditer(text))
        return self._pieces.findall(text)

    # --- merges --------------------------------------------------------------

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the bytes of both tokens gives the two tokens again.

        Undoes the merges inside both, latest first, and looks at the two tokens that
        meet in between: a merge across them that is due before either is used up by
        the merge just undone would have come first. At equal ranks the left one does.
        """
        pair = (left, right)
        known = self._pairs.get(pair)
        if known is not None:
            return known
        merges, formed, parts = self._rules
        until_left = until_right = formed_left = formed_right = NEVER
        known = True
        while True:
            across = merges.get((left, right))
            if across is not None and across < until_left and across <= until_right:
                known = False
                break
            formed_left, formed_right = formed.get(left, -1), formed.get(right, -1)
            if formed_left > formed_right:
                until_left, left = formed_left, parts[left][1]
            elif formed_right >= 0:
                until_right, right = formed_right, parts[right][0]
            else:
                break
        if len(self._pairs) >= PAIR_CACHE:
            self._pairs.clear()
        self._pairs[pair] = known
        return known

    @cached_property
    def shorter(self) -> list[int | None]:
        """By token the longest token that is a proper prefix of it."""
        found: list[int | None] = [None] * (max(self.text_of) + 1)
        for text, token in self.tokens.items():
            prefixes = (self.tokens.get(text[:size]) for size in range(len(text) - 1, 0, -1))
            found[token] = next((p for p in prefixes if p is not None), None)
        return found

    def backtrack(self, text: str) -> list[int]:
        """Token ids of one pre-token, given as one character per byte."""
        longest, width, shorter = self.automaton.iter_long, self.width, self.shorter
        pairs, compatible = self._pairs, self.compatible
        dead: set[int] = set()
        ids: list[int] = []
        last = None
        scan = longest(text)
        while True:
            for end, (token, before) in scan:  # longest tokens as long as they go together
                if end in dead or last is not None and not (pairs.get((last, token)) or compatible(last, token)):
                    break
                ids.append(token)
                last = token
            else:
                return ids
            at = end - before
            token = shorter[token]
            while True:
                if token is None:  # nothing fits here after the tokens before
                    dead.add(at - 1)
                    token = ids.pop()
                    at -= width[token]
                    token = shorter[token]
                    last = ids[-1] if ids else None
                    continue
                end = at + width[token]
                if end - 1 not in dead and (last is None or pairs.get((last, token)) or compatible(last, token)):
                    break
                token = shorter[token]
            ids.append(token)
            last = token
            scan = longest(text, end) if end < len(text) else ()

    # --- texts ---------------------------------------------------------------

    def _encode_piece(self, piece: str) -> bytes:
        ids = self.backtrack(piece.encode("utf-8").decode("latin-1"))
        return struct.pack(f"<{len(ids)}I", *ids)

    def _encode_unit(self, unit: str) -> bytes:
        """Of a first unit, or of another one with its space; mostly a word, maybe with one sign after it."""
        word = unit[1:] if unit[:1] == " " else unit
        if word.isalpha() and (word.isascii() or max(word) < SETTLED):
            return self._encode_piece(unit)
        if word[:-1].isalpha() and word[-1] in ",." and (word.isascii() or max(word) < SETTLED):
            return (self._known[word[:-1]] if word is unit else self.spaced[word[:-1]]) + self._known[word[-1]]
        if not word or self._edge.search(word):
            raise Unsafe
        return b"".join(map(self._known.__getitem__, self.pieces(unit)))

    def _encode_plain(self, text: str) -> bytes:
        """Of a text without special strings."""
        if not text:
            return b""
        try:
            units = text.split(" ")
            return self.first[units[0]] + b"".join(map(self.spaced.__getitem__, islice(units, 1, None)))
        except Unsafe:
            return b"".join(map(self._known.__getitem__, self.pieces(text)))

    def has_special(self, text: str) -> bool:
        return any(string in text for string in self.special)

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if not self.has_special(text):
            return self._encode_plain(text)
        parts = self._special.split(text)
        return b"".join(
            struct.pack("<I", self.special[part]) if at % 2 else self._encode_plain(part)
            for at, part in enumerate(parts)
        )

    @cached_property
    def _table(self) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all tokens by id, and where each begins."""
        texts = {i: t.encode("latin-1") for i, t in self.text_of.items()}
        texts |= {i: t.encode("utf-8") for t, i in self.special.items()}
        size = max(texts) + 1
        lengths = np.zeros(size + 1, dtype=np.int64)
        for i, text in texts.items():
            lengths[i + 1] = len(text)
        whole = b"".join(texts.get(i, b"") for i in range(size))
        return np.frombuffer(whole, dtype=np.uint8), np.cumsum(lengths)

    def decode(self, ids: bytes) -> str:
        """The text of ids as ``encode`` gives them; bytes that are no UTF-8 become U+FFFD."""
        whole, offsets = self._table
        numbers = np.frombuffer(ids, dtype="<u4")
        parts = []
        for first in range(0, len(numbers), BLOCK):
            block = numbers[first : first + BLOCK]
            begin = offsets[block]
            length = offsets[block + 1] - begin
            ends = np.cumsum(length)
            places = np.repeat(begin - (ends - length), length) + np.arange(ends[-1])
            parts.append(whole[places].tobytes())
        return b"".join(parts).decode("utf-8", errors="replace")


@cache
def codec(path: str) -> BytePairCodec:
    """One codec per worker process and file."""
    return BytePairCodec(path)


def _encoded(path: str):
    @F.arrow_udf("binary")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        return in_parts(batches, codec(path).encode, pa.binary())

    return encode


def _decoded(path: str):
    @F.arrow_udf("string")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(path)
        return in_parts(batches, lambda ids: None if ids is None else own.decode(ids), pa.string())

    return decode


def _round_trip(path: str):
    @F.arrow_udf(StructType([StructField("ids", BinaryType()), StructField("decoded", StringType())]))
    def code(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = codec(path)
        for batch in batches:
            for ids in in_parts(iter([batch]), own.encode, pa.binary()):
                decoded = pa.array([own.decode(row.as_py()) for row in ids], pa.string())
                yield pa.StructArray.from_arrays([ids, decoded], names=["ids", "decoded"])

    return code


def encode_and_decode(
    df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """:func:`encode_texts` and :func:`decode_ids` of its ids in one pass through the workers."""
    coded, name = with_new(df, "coded", _round_trip(path)(F.col(text).cast("string")))
    return coded.withColumn(ids, F.col(f"{name}.ids")).withColumn(decoded, F.col(f"{name}.decoded")).drop(name)


def encode_texts(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """The rows with their token ids, a binary of little-endian unsigned 32-bit integers.

    A null or empty text gives no ids (an empty binary). Repeated rows stay. A column
    named like ``ids`` is replaced; other columns pass unchanged.
    """
    encoded, name = with_new(df, "encoded", _encoded(path)(F.col(text).cast("string")))
    return encoded.withColumn(ids, F.col(name)).drop(name)


def decode_ids(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """The rows with the text that ids stand for; null ids give null."""
    return df.withColumn(text, _decoded(path)(F.col(ids)))


def n_tokens(ids: str = "ids") -> Column:
    return (F.octet_length(ids) / 4).cast("long")
