"""Removal of repeated passages: windows of words as edges of a de Bruijn graph, compacted to paths.

An *edge* is a window of 13 words, from the node of its first 12 words to that of its last 12. Each
edge has a *source*: the place of its smallest document where it first starts. A document's
consecutive edges are one path as long as their sources are consecutive too; where an
edge leads back to another source, or is not repeated, the path branches off and ends. What a
path of a document covers is removed if its source is a document with a smaller id.

1. Edges are grouped before they travel. A window's *anchor* is its five-word gram with
   the smallest hash; consecutive windows with one anchor form a run, and equal windows have equal
   anchors. A run is one row: the anchor and a few bytes (a mark) per window. Runs that a block of
   documents has twice are settled there: the later documents get the block's first as source, and
   only that one row goes on.
2. Rows meet by anchor. Anchors seen in two documents are unfolded to edges, each with the
   least of its places as source; edges of other anchors are in one document only. Frequent anchors, a
   bounded list found beforehand, are hot keys: their windows travel singly, each under a
   hash of its own words.
3. Edges with an earlier source compact along their diagonal (place less source place): first within
   a run, then by document across runs, to paths with source coordinates.
4. Paths join the texts, are cut out, and are verified: the words of a path and those at its source
   coordinates are digested piece by piece (cut at every 256th word of the source) and must be equal.
   If hashes ever made two passages equal that are not, all is done again with other hashes and wider
   marks.

Hashes and marks have 64 and 40 bits at first, and 64 and 128 in the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seedloom.llm.frames import quoted, stored
from seedloom.llm.jaccard_join import mixed

ANCHOR, PIECE = 5, 256
#: Bytes of a mark in the first and the further attempts.
MARKS = (5, 8, 16)
#: Anchors that make up this share of all, twice over, are frequent; rarer ones may be, so at most 2^17 are listed.
FREQUENT_ONE_IN, LEAST_FREQUENT = 1 << 17, 64
BLOCK, WORD_CACHE = 8 << 20, 400_000
#: A place holds 33 bits of the text's hash, which tells rows of one id apart, above 30 bits of the word's number.
PLACE_BITS, TAG_BITS = 30, 33
#: Null ids come after all others.
LAST = (1 << 63) - 1


class _Words(dict):
    """Hashes of words; forgets when full."""

    def __init__(self, seed: int):
        super().__init__()
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word, self.seed)
        return value


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").split()


@dataclass(frozen=True)
class Hashing:
    """The hash functions of an attempt."""

    attempt: int
    window: int

    @property
    def width(self) -> int:
        return MARKS[self.attempt]

    def factors(self, kind: int, n: int) -> np.ndarray:
        first = np.uint64((self.attempt * 8 + kind) * 1000 + 1)
        with np.errstate(over="ignore"):
            return mixed((first + np.arange(n, dtype=np.uint64)) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)

    def grams(self, words: np.ndarray, n: int, kind: int) -> np.ndarray:
        """Hashes of all runs of ``n`` words."""
        rows = max(0, len(words) - n + 1)
        total = np.zeros(rows, dtype=np.uint64)
        for at, factor in enumerate(self.factors(kind, n)):
            total += words[at : at + rows] * factor
        return mixed(total)

    def anchors(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all short grams, and for each window the place of the smallest, leftmost at ties."""
        size = min(ANCHOR, self.window)
        grams = self.grams(words, size, 0)
        rows = max(0, len(words) - self.window + 1)
        best, place = grams[:rows].copy(), np.arange(rows)
        for at in range(1, self.window - size + 1):
            other = grams[at : at + rows]
            smaller = other < best
            np.copyto(best, other, where=smaller)
            place[smaller] = np.flatnonzero(smaller) + at
        return grams, place

    def marks(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Window hashes: 64 bits of each, and its mark as a row of bytes."""
        hashes = [self.grams(words, self.window, 1 + i) for i in range(-(-self.width // 8))]
        whole = np.stack(hashes, axis=1).view(np.uint8) if len(hashes[0]) else np.empty((0, 8 * len(hashes)), np.uint8)
        return hashes[0], np.ascontiguousarray(whole[:, : self.width])


class Block:
    """Words of several documents, sorted by id, and their windows."""

    def __init__(self, hashing: Hashing, docs: list[tuple[int, int, np.ndarray]]):
        docs = sorted(docs, key=lambda doc: doc[:2])
        self.hashing = hashing
        self.ids = np.array([doc[0] for doc in docs], dtype=np.int64)
        self.tags = np.array([doc[1] for doc in docs], dtype=np.int64)
        sizes = np.array([len(doc[2]) for doc in docs], dtype=np.int64)
        self.words = np.concatenate([*(doc[2] for doc in docs), np.empty(0, np.uint64)])
        self.doc = np.repeat(np.arange(len(docs)), sizes)
        self.begin = np.cumsum(sizes) - sizes
        self.grams, place = hashing.anchors(self.words)
        rows = len(place)
        #: windows that lie within one document, and the places of their anchors
        self.windows = np.flatnonzero(self.doc[:rows] == self.doc[len(self.doc) - rows :])
        self.place = place[self.windows]

    def anchors(self) -> np.ndarray:
        """One hash per run."""
        return self.grams[self.place[np.flatnonzero(self._starts(np.zeros(len(self.place), bool)))]]

    def _starts(self, frequent: np.ndarray) -> np.ndarray:
        new = np.ones(len(self.place), dtype=bool)
        new[1:] = (np.diff(self.place) != 0) | (np.diff(self.windows) != 1) | frequent[1:] | frequent[:-1]
        return new

    def rows(self, frequent: np.ndarray) -> pa.RecordBatch:
        """Runs that ask for their sources, and paths whose source is in this block."""
        anchors = self.grams[self.place]
        at = np.minimum(np.searchsorted(frequent, anchors), max(0, len(frequent) - 1))
        hot = frequent[at] == anchors if len(frequent) else np.zeros(len(anchors), bool)
        new = self._starts(hot)
        starts = np.flatnonzero(new)
        lengths = np.diff(starts, append=len(new))
        hashes, marks = self.hashing.marks(self.words)
        hashes, marks = hashes[self.windows], marks[self.windows]
        keys = anchors[starts]
        if hot.any():
            single = self.hashing.grams(self.words, self.hashing.window, 5)[self.windows]
            keys = np.where(hot[starts], single[starts], keys)
        doc = self.doc[self.windows[starts]]
        first = self.windows[starts] - self.begin[doc]
        if len(starts):
            offset = np.arange(len(new)) - np.repeat(starts, lengths)
            digest = np.add.reduceat(hashes * self.hashing.factors(6, int(offset.max()) + 1)[offset], starts)
            same = mixed(keys + mixed(digest))
        else:
            same = keys
        # Documents come sorted by id, so the first of equal runs has the smallest.
        order = np.argsort(same, kind="stable")
        head = np.ones(len(order), dtype=bool)
        head[1:] = same[order][1:] != same[order][:-1]
        source = np.empty(len(order), dtype=np.int64)
        source[order] = order[np.flatnonzero(head)[np.cumsum(head) - 1]]
        settled = self.ids[doc] > self.ids[doc[source]]
        place = (self.tags[doc] << PLACE_BITS) | first
        asking = np.flatnonzero(~settled)
        ends = np.r_[starts, len(new)] * self.hashing.width
        data = pa.Array.from_buffers(
            pa.large_binary(), len(starts), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(marks.tobytes())]
        )
        # Settled runs that follow each other, with sources that do, are one path.
        mine = np.flatnonzero(settled)
        joined = np.zeros(len(mine), dtype=bool)
        if len(mine) > 1:
            a, b = mine[:-1], mine[1:]
            joined[1:] = (
                (b == a + 1) & (doc[a] == doc[b]) & (first[b] == first[a] + lengths[a])
                & (doc[source[a]] == doc[source[b]]) & (first[source[b]] == first[source[a]] + lengths[a])
            )
        heads = np.flatnonzero(~joined)
        n = np.add.reduceat(lengths[mine], heads) if len(heads) else np.empty(0, np.int64)
        path, of = mine[heads], source[mine[heads]]
        none = np.empty(0, np.int64)
        known = np.r_[np.zeros(len(asking), bool), np.ones(len(path), bool)]
        source_id = pa.array(np.r_[np.zeros(len(asking), np.int64), self.ids[doc[of]] if len(of) else none], mask=~known)
        source_at = pa.array(np.r_[np.zeros(len(asking), np.int64), place[of] if len(of) else none], mask=~known)
        scattered = mixed(place[path].astype(np.uint64) ^ self.ids[doc[path]].astype(np.uint64)) if len(path) else np.empty(0, np.uint64)
        binary = data.take(pa.array(asking)).cast(pa.binary())
        columns = [
            pa.array(np.r_[keys[asking], scattered].view(np.int64)), pa.array(np.r_[self.ids[doc[asking]], self.ids[doc[path]]]),
            pa.array(np.r_[place[asking], place[path]]), pa.array(np.r_[lengths[asking], n].astype(np.int32)),
            pa.concat_arrays([binary, pa.nulls(len(path), pa.binary())]), source_id, source_at,
        ]
        return pa.record_batch(columns, names=["anchor", "doc", "at", "n", "marks", "source_doc", "source_at"])


_ROWS = "anchor long, doc long, at long, n int, marks binary, source_doc long, source_at long"


def blocks(batches: Iterator[pa.RecordBatch], hashing: Hashing) -> Iterator[Block]:
    """Blocks of the documents of a task: columns id, tag and text."""
    hashes = _Words(hashing.attempt)
    docs, size = [], 0
    for batch in batches:
        for key, tag, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            words = words_of(text.as_py())
            if len(words) >= hashing.window:
                docs.append((key, tag, np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))))
                size += 6 * len(words)
            if size >= BLOCK:
                yield Block(hashing, docs)
                docs, size = [], 0
    if docs:
        yield Block(hashing, docs)


def frequent_anchors(texts: DataFrame, hashing: Hashing) -> np.ndarray:
    """Sorted hashes of anchors that are a hot key: at most ``FREQUENT_ONE_IN``, and all of twice that share.

    A block reports what has the share among its own runs; an anchor of twice the share of all runs
    has it summed up over the blocks that report it.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, hashing):
            found, n = np.unique(block.anchors(), return_counts=True)
            total = int(n.sum())
            often = n >= max(4, total / FREQUENT_ONE_IN)
            yield pa.record_batch(
                [pa.array(np.r_[found[often].view(np.int64), 0]), pa.array(np.r_[n[often], 0]), pa.array(np.r_[n[often] * 0, total])],
                names=["anchor", "n", "total"],
            )

    counted = stored(texts.mapInArrow(count, "anchor long, n long, total long").groupBy("anchor").agg(
        F.sum("n").alias("n"), F.sum("total").alias("total")
    ), "anchors")
    total = counted.agg(F.sum("total")).head()[0] or 0
    kept = counted.where(F.col("n") >= max(LEAST_FREQUENT, total / FREQUENT_ONE_IN)).select("anchor").toArrow()
    return np.sort(kept.column("anchor").to_numpy().view(np.uint64))


def repeated_paths(texts: DataFrame, hashing: Hashing) -> DataFrame:
    """``doc, tag, start, n, source_doc, source_tag, source_start``: paths of ``n`` windows and their sources; stored."""
    frequent = texts.sparkSession.sparkContext.broadcast(frequent_anchors(texts, hashing))
    width = hashing.width

    def run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, hashing):
            yield block.rows(frequent.value)

    runs = texts.mapInArrow(run_rows, _ROWS)
    asking = F.col("marks").isNotNull()
    by_anchor = Window.partitionBy("anchor")
    least, most = (kind(F.when(asking, F.col("doc"))).over(by_anchor) for kind in (F.min, F.max))
    met = runs.withColumn("least", least).withColumn("most", most).where(~asking | (F.col("least") < F.col("most")))
    marks = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.substring("marks", i * width + 1, F.lit(width)))
    edges = met.select(
        "anchor", "doc", "at", "n", "source_doc", "source_at",
        F.posexplode(F.when(asking, marks).otherwise(F.array(F.lit(None).cast("binary")))).alias("i", "mark"),
    )
    first = F.struct("doc", (F.col("at") + F.col("i")).alias("at"))
    edges = edges.withColumn("first", F.min(first).over(Window.partitionBy("anchor", "mark")))
    edges = edges.where(F.col("mark").isNull() | (F.col("first.doc") < F.col("doc"))).select(
        "anchor", "doc", (F.col("at") + F.col("i")).alias("at"), F.when(F.col("mark").isNull(), F.col("n")).otherwise(1).alias("n"),
        F.col("at").alias("run"), F.coalesce("source_doc", "first.doc").alias("source_doc"),
        F.coalesce("source_at", "first.at").alias("source_at"),
    )
    # Windows of a run on one diagonal overlap, so all in between lie on it as well.
    edges = edges.withColumn("diagonal", F.col("source_at") - F.col("at"))
    stop = F.col("at") + F.col("n")
    pieces = edges.groupBy("anchor", "run", "doc", "source_doc", "diagonal").agg(F.min("at").alias("at"), F.max(stop).alias("stop"))
    tag = F.shiftrightunsigned("at", PLACE_BITS).alias("tag")
    pieces = pieces.select("doc", tag, "source_doc", "diagonal", "at", "stop").repartition("doc", "tag")
    line = Window.partitionBy("doc", "tag", "source_doc", "diagonal").orderBy("at")
    before = F.max("stop").over(line.rowsBetween(Window.unboundedPreceding, -1))
    parts = pieces.withColumn("new", (F.coalesce(before, F.lit(-1)) < F.col("at")).cast("int")).withColumn("path", F.sum("new").over(line))
    paths = parts.groupBy("doc", "tag", "source_doc", "diagonal", "path").agg(F.min("at").alias("at"), F.max("stop").alias("stop"))
    source, mask = F.col("at") + F.col("diagonal"), (1 << PLACE_BITS) - 1
    return stored(paths.select(
        "doc", "tag", F.col("at").bitwiseAND(mask).alias("start"), (F.col("stop") - F.col("at")).alias("n"), "source_doc",
        F.shiftrightunsigned(source, PLACE_BITS).alias("source_tag"), source.bitwiseAND(mask).alias("source_start"),
    ), "paths")


def source_pieces(start: int, size: int) -> Iterator[tuple[int, int]]:
    """The pieces of ``size`` words from ``start`` on, cut before every 256th word."""
    stop = start + size
    while start < stop:
        cut = min(stop, (start // PIECE + 1) * PIECE)
        yield start, cut - start
        start = cut


_DONE = (
    "key long, n_words long, n_removed long, kept string, kept_sha256 string, "
    "checks array<struct<doc: long, tag: long, start: long, n: long, is_source: boolean, digest: binary>>"
)


def without_paths(texts: DataFrame, paths: DataFrame, window: int, keep_text: bool) -> DataFrame:
    """Each document without its paths, and digests of its paths' pieces and of those others have their source in."""
    own = paths.groupBy("doc", "tag").agg(
        F.collect_list(F.struct("start", "n", "source_doc", "source_tag", "source_start")).alias("own")
    )
    begin, stop = F.col("source_start"), F.col("source_start") + F.col("n") + (window - 1)
    numbers = F.sequence(F.floor(begin / PIECE), F.floor((stop - 1) / PIECE))
    cut = paths.select("source_doc", "source_tag", begin.alias("begin"), stop.alias("stop"), F.explode(numbers).alias("i"))
    left = F.greatest(F.col("begin"), F.col("i") * PIECE)
    right = F.least(F.col("stop"), (F.col("i") + 1) * PIECE)
    asked = cut.select(F.col("source_doc").alias("doc"), F.col("source_tag").alias("tag"), left.alias("start"), (right - left).alias("n"))
    asked = asked.distinct().groupBy("doc", "tag").agg(F.collect_list(F.struct("start", "n")).alias("asked"))
    work = own.join(asked, ["doc", "tag"], "full")
    rows = texts.join(work, ["doc", "tag"], "left").select("key", "doc", "tag", "text", "own", "asked")
    kind = pa.list_(pa.struct([
        ("doc", pa.int64()), ("tag", pa.int64()), ("start", pa.int64()), ("n", pa.int64()), ("is_source", pa.bool_()), ("digest", pa.binary()),
    ]))
    schema = pa.schema([
        ("key", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string()), ("kept_sha256", pa.string()), ("checks", kind),
    ])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, size = [], 0
        for batch in batches:
            for row in zip(*batch.columns):
                key, doc, tag, text, cuts, pieces = (value.as_py() for value in row)
                words = words_of(text)
                total, checks = len(words), []

                def digest(start: int, n: int) -> bytes:
                    return xxhash.xxh3_128_digest(b" ".join(words[start : start + n]))  # noqa: B023

                for piece in pieces or ():
                    checks.append((doc, tag, piece["start"], piece["n"], True, digest(piece["start"], piece["n"])))
                gone = np.zeros(total + 1, dtype=np.int32)
                for path in cuts or ():
                    start, n = path["start"], path["n"] + window - 1
                    gone[start] += 1
                    gone[start + n] -= 1
                    away = start - path["source_start"]
                    for at, part in source_pieces(path["source_start"], n):
                        checks.append((path["source_doc"], path["source_tag"], at, part, False, digest(at + away, part)))
                if cuts:
                    left = np.flatnonzero(np.cumsum(gone[:-1]) == 0)
                    words = list(map(words.__getitem__, left.tolist()))
                kept = b" ".join(words)
                found.append({
                    "key": key, "n_words": total, "n_removed": total - len(words), "kept": kept.decode("utf-8") if keep_text else None,
                    "kept_sha256": sha256(kept).hexdigest(),
                    "checks": [dict(zip(("doc", "tag", "start", "n", "is_source", "digest"), check)) for check in checks],
                })
                size += len(kept) + 100 * len(checks) + 200
                if size > BLOCK:
                    yield pa.RecordBatch.from_pylist(found, schema)
                    found, size = [], 0
        yield pa.RecordBatch.from_pylist(found, schema)

    return stored(rows.mapInArrow(finish, _DONE), "cut")


def verified(done: DataFrame) -> bool:
    """Whether all paths have the words of their sources."""
    pieces = done.select(F.explode("checks").alias("of")).select("of.*").groupBy("doc", "tag", "start", "n").agg(
        F.min("digest").alias("least"), F.max("digest").alias("most"), F.max("is_source").alias("answered")
    )
    return pieces.where((F.col("least") != F.col("most")) | ~F.col("answered")).isEmpty()


def remove_repeats(
    df: DataFrame, *, key: str = "doc_id", text: str = "text", window: int = 13, keep_text: bool = True
) -> tuple[DataFrame, DataFrame]:
    """The documents without words that a document with a smaller id has in a passage of ``window`` words or more.

    The first frame has one row per row of ``df``: ``key, n_words, n_removed, kept`` (the kept words joined
    by a space; null unless ``keep_text``) and ``kept_sha256``. The second lists the removed paths: ``doc, tag,
    start, n, source_doc, source_tag, source_start`` in words, ``n`` windows each; ``tag`` is a hash of the text.
    Windows are judged on the input. Words are what white space of ASCII separates.

    Null and empty texts have no words; texts of fewer than ``window`` words lose none. A passage a document
    repeats in itself stays, as does one that rows of one id share (repeated rows, or one id with two texts).
    Null ids come after all others and don't remove from each other. Very long texts are one document like others.
    An empty table gives empty frames; other columns are not read.
    """
    if window < 1:
        raise ValueError("a window has at least one word")
    value = F.col(quoted([text])[0]).cast("string")
    texts = df.select(
        F.coalesce(F.col(quoted([key])[0]).cast("long"), F.lit(LAST)).alias("doc"),
        F.xxhash64(value).bitwiseAND((1 << TAG_BITS) - 1).alias("tag"), value.alias("text"), F.col(quoted([key])[0]).cast("long").alias("key"),
    )
    for attempt in range(len(MARKS)):
        hashing = Hashing(attempt, window)
        paths = repeated_paths(texts.select("doc", "tag", "text"), hashing)
        done = without_paths(texts, paths, window, keep_text)
        if verified(done):
            return done.drop("checks"), paths
    raise RuntimeError("passages of different words have equal hashes of 192 bits")
