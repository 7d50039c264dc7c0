"""Alignment of two tokenizers' tokens over the same texts, and how often their tokens meet.

Tokenizer A is a byte-level BPE file of the tokenizers library and reads a space and the
text; B is a sentencepiece model, which adds that space itself. Both report spans: A character
offsets, B those of its proto (bytes of the text). Spans are coarse, as tokens that split a character
share its span and bytes of a fallback have empty ones. So spans tell to which part of the
text a token belongs, and the decoded bytes of the tokens refine that to exact byte ends.

*Groups* are cut where tokens of both end at the same byte. *Links* are the pairs of an A and
a B token that share bytes: each stretch between two neighbouring token ends is one.

*Units.* A space between two characters that are no white space always starts a token of both
(A's pre-tokenizer splits there, no piece of B holds a space after something else; without
these two properties whole texts are units). So a text is cut there, and each worker tokenizes
a unit once, many at a time, and keeps its groups and links until its cache is full.

*Counts.* How many links of the corpus hold a pair of ids is counted by task, then summed by
pair. Documents need these counts back: each is stored with its pairs and how many links hold
them, so nothing is tokenized twice. The commonest pairs (at most 2^20) are broadcast with their
counts; the others are looked up by a join.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from seedloom.llm.bpe import byte_of_char
from seedloom.llm.frames import quoted
from seedloom.session import scratch

#: Units a worker keeps, units tokenized at once, bytes of text in a block, pairs broadcast, distinct pairs a task gathers.
UNITS, AT_ONCE, BLOCK, COMMON, GATHERED = 500_000, 400, 2 << 20, 1 << 20, 500_000
_SPACE = "▁"
_LOOSE = re.compile(r" \s|\s |\A | \Z")
_CUT = re.compile(r"(?<=\S) (?=\S)")


class _Slots(dict):
    """Numbers of units in the order they are first seen."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, unit: str) -> int:
        self.fresh.append(unit)
        slot = self[unit] = len(self)
        return slot


def grown(array: np.ndarray, size: int) -> np.ndarray:
    """The array with room for so many entries; the room at least doubles."""
    if size <= len(array):
        return array
    return np.concatenate([array, np.zeros(max(size, 2 * len(array)) - len(array), dtype=array.dtype)])


class Aligner:
    """Groups and links of units under two tokenizers, by slot."""

    def __init__(self, path_a: str, path_b: str):
        with open(path_a, encoding="utf-8") as file:
            spec = json.load(file)
        splitter = spec["pre_tokenizer"]
        if splitter["type"] != "ByteLevel" or spec.get("normalizer"):
            raise ValueError(f"{path_a}: not a byte-level tokenizer")
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        to_byte = byte_of_char()
        bytes_a = {i: bytes(to_byte[c] for c in text) for text, i in spec["model"]["vocab"].items()}
        self.bytes_a = [bytes_a.get(i, b"") for i in range(max(bytes_a) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace(_SPACE, " ").encode("utf-8")
            for i, piece in enumerate(pieces)
        ]
        self.width_a = np.array(list(map(len, self.bytes_a)))
        self.width_b = np.array(list(map(len, self.bytes_b)))
        self.n_b = len(pieces)
        self.names = list(map(str, range(max(len(self.bytes_a), self.n_b))))
        self.cuts = splitter.get("use_regex", True) and not any(_SPACE in piece.lstrip(_SPACE) for piece in pieces)
        self.clear()

    def clear(self) -> None:
        self.slots, self.groups = _Slots(), []
        #: by slot: tokens of A and B, groups, and where the unit's links end; -1 tokens mark bytes that differ
        self.counts = np.zeros((1 << 12, 3), dtype=np.int32)
        self.ends = np.zeros(1 << 12, dtype=np.int64)
        self.links = np.zeros(1 << 14, dtype=np.int64)
        self.n_links = 0

    def units(self, text: str) -> list[str]:
        if not self.cuts:
            return [text]
        return _CUT.split(text) if _LOOSE.search(text) else text.split(" ")

    def numbered(self, units: list[str]) -> np.ndarray:
        """The slots of units, which are tokenized where they are new."""
        found = np.fromiter(map(self.slots.__getitem__, units), dtype=np.int64, count=len(units))
        fresh, self.slots.fresh = self.slots.fresh, []
        at = 0
        while at < len(fresh):
            # Units with white space at an edge, or a lot of text, go alone.
            many = [unit for unit in fresh[at : at + AT_ONCE]]
            alone = next((i for i, unit in enumerate(many) if len(unit) > 1000 or unit != unit.strip()), len(many))
            self._add(many[: max(1, alone)])
            at += max(1, alone)
        return found

    def _add(self, units: list[str]) -> None:
        text = " ".join(units)
        whole = (" " + text).encode("utf-8")
        coded = self.a.encode(" " + text, add_special_tokens=False)
        pieces = list(self.b.encode(text, return_type="proto").pieces)
        list_a, list_b = coded.ids, [piece.id for piece in pieces]
        same = b"".join(map(self.bytes_a.__getitem__, list_a)) == whole == b"".join(map(self.bytes_b.__getitem__, list_b))
        ids_a, ids_b = np.array(list_a, dtype=np.int64), np.array(list_b, dtype=np.int64)
        ends_a, ends_b = np.cumsum(self.width_a[ids_a]), np.cumsum(self.width_b[ids_b])
        bounds = np.cumsum([1 + len(unit.encode("utf-8")) for unit in units])
        if same and len(units) > 1:  # the spans, as coarse cuts, must put all tokens into the units that the bytes do
            characters = np.cumsum([1 + len(unit) for unit in units])
            spans_a = np.array([end for _, end in coded.offsets])
            spans_b = np.array([piece.end for piece in pieces])
            same = np.array_equal(np.searchsorted(characters, spans_a), np.searchsorted(bounds, ends_a)) and np.array_equal(
                np.searchsorted(bounds - 1, spans_b), np.searchsorted(bounds, ends_b)
            )
        if not same:
            if len(units) > 1:
                self._add(units[: len(units) // 2])
                self._add(units[len(units) // 2 :])
            else:
                self._keep([b""], np.array([[-1, 0, 0]]), np.empty(0, dtype=np.int64), np.zeros(1, dtype=np.int64))
            return
        common = ends_b[np.searchsorted(ends_b, ends_a)] == ends_a  # both end with the last byte
        both = ends_a[common]
        cuts = np.sort(np.concatenate([ends_a[~common], ends_b]), kind="stable")
        links = ids_a[np.searchsorted(ends_a, cuts)] * self.n_b + ids_b[np.searchsorted(ends_b, cuts)]
        n = len(units)
        per_unit = [np.bincount(np.searchsorted(bounds, ends), minlength=n) for ends in (ends_a, ends_b, both)]
        n_links = np.bincount(np.searchsorted(bounds, cuts), minlength=n)
        names_a, names_b = (list(map(self.names.__getitem__, ids)) for ids in (list_a, list_b))
        to_a = (np.searchsorted(ends_a, both) + 1).tolist()
        to_b = (np.searchsorted(ends_b, both) + 1).tolist()
        groups = [
            f"{names_a[i] if j - i == 1 else ','.join(names_a[i:j])}|{names_b[k] if m - k == 1 else ','.join(names_b[k:m])}"
            for i, j, k, m in zip([0, *to_a], to_a, [0, *to_b], to_b)
        ]
        last = np.cumsum(per_unit[2]).tolist()
        self._keep(
            [";".join(groups[i:j]).encode("ascii") for i, j in zip([0, *last], last)], np.stack(per_unit, axis=1), links,
            np.cumsum(n_links),
        )

    def _keep(self, groups: list[bytes], counts: np.ndarray, links: np.ndarray, ends: np.ndarray) -> None:
        first, n = len(self.groups), len(self.groups) + len(groups)
        self.groups += groups
        self.counts, self.ends = grown(self.counts.ravel(), 3 * n).reshape(-1, 3), grown(self.ends, n)
        self.links = grown(self.links, self.n_links + len(links))
        self.counts[first:n] = counts
        self.ends[first:n] = self.n_links + ends
        self.links[self.n_links : self.n_links + len(links)] = links
        self.n_links += len(links)

    def links_of(self, slots: np.ndarray) -> np.ndarray:
        """The links of each of the slots one after another."""
        begin = np.where(slots > 0, self.ends[slots - 1], 0)
        n = self.ends[slots] - begin
        ends = np.cumsum(n)
        return self.links[np.repeat(begin - (ends - n), n) + np.arange(ends[-1] if len(ends) else 0)]


@cache
def aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker process and pair of files."""
    return Aligner(path_a, path_b)


# --- first pass: documents, each with its pairs ----------------------------------

NAMES = ("key", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "groups")
_DOC = "key long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, groups string"
_ROWS = pa.schema([
    ("row", pa.int64()), ("key", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
    ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("groups", pa.string()), ("own", pa.binary()), ("times", pa.binary()),
    ("pairs", pa.list_(pa.int64())), ("n", pa.list_(pa.int64())),
])
_SPARK_ROWS = f"row long, {_DOC}, own binary, times binary, pairs array<long>, n array<long>"


def packed(values: np.ndarray) -> bytes:
    """Sorted numbers as the steps between them, in as few bytes each as they all need."""
    steps = np.diff(values, prepend=0)
    width = next(w for w in (1, 2, 4, 8) if w == 8 or int(steps.max(initial=0)) < 1 << (8 * w))
    return bytes([width]) + steps.astype(f"<u{width}").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(data, dtype=f"<u{data[0]}", offset=1).astype(np.int64))


class _Pairs:
    """Counts by pair of one task, sorted arrays that are merged."""

    def __init__(self):
        self.parts, self.size = [], 0

    def add(self, pairs: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((pairs, counts))
        self.size += len(pairs)
        if self.size > GATHERED:
            self.merge()

    def merge(self) -> None:
        if len(self.parts) > 1:
            pairs, which = np.unique(np.concatenate([p for p, _ in self.parts]), return_inverse=True)
            total = np.zeros(len(pairs), dtype=np.int64)
            np.add.at(total, which, np.concatenate([n for _, n in self.parts]))
            self.parts, self.size = [(pairs, total)], len(pairs)

    def rows(self) -> Iterator[pa.RecordBatch]:
        self.merge()
        for pairs, counts in self.parts:
            for at in range(0, len(pairs), 1 << 18):
                row = dict.fromkeys(_ROWS.names) | {"pairs": pairs[at : at + (1 << 18)], "n": counts[at : at + (1 << 18)]}
                yield pa.record_batch([pa.array([row[f.name]], f.type) for f in _ROWS], schema=_ROWS)
        self.__init__()


def block_rows(own: Aligner, keys: list, texts: list[str], row: int, keep_groups: bool, total: _Pairs) -> pa.RecordBatch:
    """The rows of some documents, numbered from ``row`` on; their pairs are added to ``total``."""
    if len(own.slots) > UNITS:
        own.clear()
    lists = [own.units(text) if text else [] for text in texts]
    slots = own.numbered([unit for units in lists for unit in units])
    docs, at = [], 0
    for key, units in zip(keys, lists):
        mine = slots[at : at + len(units)]
        at += len(units)
        counts = own.counts[mine]
        doc = {"row": row, "key": key, "n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups_sha256": "", "groups": "" if keep_groups else None}
        row += 1
        docs.append(doc)
        if not len(mine) or (counts[:, 0] < 0).any():
            continue
        groups = b";".join(map(own.groups.__getitem__, mine.tolist()))
        links = own.links_of(mine)
        pairs, times = np.unique(links, return_counts=True)
        total.add(pairs, times)
        doc |= dict(zip(("n_a", "n_b", "n_groups"), counts.sum(axis=0, dtype=np.int64).tolist()))
        doc |= {
            "n_links": len(links), "groups_sha256": sha256(groups).hexdigest(), "own": packed(pairs),
            "times": packed(np.cumsum(times)),
        }
        if keep_groups:
            doc["groups"] = groups.decode("ascii")
    return pa.record_batch([pa.array([doc.get(f.name) for doc in docs], f.type) for f in _ROWS], schema=_ROWS)


def _documents(path_a: str, path_b: str, keep_groups: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, total = aligner(path_a, path_b), _Pairs()
        row = TaskContext.get().partitionId() << 33
        keys, texts, size = [], [], 0
        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                keys.append(key.as_py())
                texts.append(text.as_py() or "")
                size += len(texts[-1]) + 100
                if size >= BLOCK:
                    yield block_rows(own, keys, texts, row, keep_groups, total)
                    row, keys, texts, size = row + len(keys), [], [], 0
        yield block_rows(own, keys, texts, row, keep_groups, total)
        yield from total.rows()

    return read


# --- second pass: counts back to documents -------------------------------------------


def common_pairs(counts: DataFrame, most: int = COMMON) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted pairs, their counts and whether each is the best of its B id: all above the least count that leaves at most ``most``."""
    levels = counts.groupBy(F.floor(8 * F.log2("n")).alias("level")).count().collect()
    least, total = None, 0
    for row in sorted(levels, key=lambda row: -row["level"]):
        total += row["count"]
        if total > most:
            break
        least = row["level"]
    if least is None:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)
    table = counts.where(F.floor(8 * F.log2("n")) >= least).select("pair", "n", "best").toArrow()
    pairs, n, best = (table.column(name).to_numpy() for name in ("pair", "n", "best"))
    order = np.argsort(pairs)
    return pairs[order], n[order], best[order].astype(bool)


_SUMS = pa.struct([
    ("n_best", pa.int64()), ("count_sum", pa.int64()), ("rare", pa.list_(pa.int64())), ("times", pa.list_(pa.int64())),
])


def _sums(table):
    @F.arrow_udf("n_best long, count_sum long, rare array<long>, times array<long>")
    def add(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        aligner.cache_clear()  # a worker of the first pass no longer needs its units
        pairs, counts, best = table.value
        # One entry past the end, which no pair equals, so that every place can be looked at.
        pairs, counts, best = np.r_[pairs, -1], np.r_[counts, 0], np.r_[best, False]
        for owns, times in batches:
            found = []
            for own, n in zip(owns, times):
                if not own.is_valid:
                    found.append({"n_best": 0, "count_sum": 0, "rare": [], "times": []})
                    continue
                own, n = unpacked(own.as_py()), np.diff(unpacked(n.as_py()), prepend=0)
                place = np.searchsorted(pairs[:-1], own)
                known = pairs[place] == own
                found.append({
                    "n_best": int(n[known & best[place]].sum()), "count_sum": int((counts[place] * n)[known].sum()),
                    "rare": own[~known], "times": n[~known],
                })
            yield pa.array(found, _SUMS)

    return add


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pair_counts(documents: DataFrame, n_b: int) -> DataFrame:
    """``pair, n, best``: the links of the corpus per pair of ids, and whether no pair of the same B id has more."""
    found = documents.where(F.col("pairs").isNotNull()).select(F.explode(F.arrays_zip("pairs", "n")).alias("of"))
    counts = _stored(found.groupBy(F.col("of.pairs").alias("pair")).agg(F.sum("of.n").alias("n")), "pairs")
    by_b = counts.groupBy((F.col("pair") % n_b).alias("b")).agg(F.max("n").alias("most"))
    joined = counts.join(by_b, F.col("pair") % n_b == F.col("b"))
    return _stored(joined.select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "counts")


def align(
    df: DataFrame, path_a: str, path_b: str, *, key: str = "doc_id", text: str = "text", keep_groups: bool = True,
    common: int = COMMON,
) -> tuple[DataFrame, DataFrame]:
    """The alignment of every text, and the corpus's links per pair of ids.

    The first frame has one row per row of ``df``: ``key, n_a, n_b, n_groups, n_links, n_best, count_sum,
    groups_sha256`` and ``groups`` (``a1,a2|b1;a3|b2,b3``, decimal ids of A and B in order; null unless
    ``keep_groups``). ``n_best`` counts links whose pair no other pair of the same B id exceeds in the
    corpus, ``count_sum`` adds up the corpus counts of its links. The second frame has ``a, b, n, best``.

    Null and empty texts, and texts that the bytes of one tokenizer's tokens do not give back (such as
    those with U+2581), have no tokens: zeros, and empty groups. Special strings inside texts are plain
    text. Very long texts are cut into units like all others; one without spaces is one unit. Null keys and
    repeated rows stay, each a row that counts; an empty table gives empty frames; other columns are not
    read. Ties for the best pair all count.
    """
    spark = df.sparkSession
    rows = df.select(F.col(quoted([key])[0]).cast("long").alias("key"), F.col(quoted([text])[0]).cast("string").alias("text"))
    documents = _stored(rows.mapInArrow(_documents(path_a, path_b, keep_groups), _SPARK_ROWS), "aligned")
    n_b = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    counts = pair_counts(documents, n_b)
    table = spark.sparkContext.broadcast(common_pairs(counts, common))
    docs = documents.where(F.col("row").isNotNull()).select("row", *NAMES, _sums(table)("own", "times").alias("sums"))
    sums = _stored(docs.select("row", *NAMES, "sums.*"), "sums")
    rare = sums.where(F.size("rare") > 0).select("row", F.explode(F.arrays_zip("rare", "times")).alias("of"))
    rare = rare.select("row", F.col("of.rare").alias("pair"), F.col("of.times").alias("times"))
    found = rare.join(counts, "pair").groupBy("row").agg(
        F.sum(F.col("times") * F.col("n")).alias("more_sum"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best")
    )
    joined = sums.drop("rare", "times").join(found, "row", "left")
    total = lambda name, more: (F.col(name) + F.coalesce(F.col(more), F.lit(0))).alias(name)
    result = joined.select(
        "key", "n_a", "n_b", "n_groups", "n_links", total("n_best", "more_best"), total("count_sum", "more_sum"), "groups_sha256", "groups"
    )
    pair = F.col("pair")
    return result, counts.select(F.floor(pair / n_b).cast("int").alias("a"), (pair % n_b).cast("int").alias("b"), "n", "best")
