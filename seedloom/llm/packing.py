"""Vector bin packing of examples into training sequences.

An example is a row of token ids, of which those from ``loss_start`` on bear loss. Each
sequence has room for so many tokens, segments and loss-bearing tokens at once. Whole
sequences' worth of a long example are cut off first and stand alone; what is left over
is placed by the dot-product heuristic: into the open sequence goes the waiting example
whose needs, weighed by the sequence's remaining room, add up to most. Where no whole
example fits any more, one is cut to fill the gap, as examples may be cut freely. A sequence
that stays underfull, as the last of a block or because its segments or loss-bearing tokens
are used up, is cut into parts of a power of two, which need no padding.

Each task packs the rows it reads, block by block, so nothing is shuffled, a block's size
bounds memory, and a task that runs again gives the same sequences. Sequence numbers
hold the task's number in the upper bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedloom.llm.rank_ids import rank_encoder

#: Examples that wait together and bytes of their ids; places for sequence numbers below a task's number.
BLOCK_EXAMPLES, BLOCK_BYTES, SEQUENCE_BITS = 4096, 64 << 20, 33


@dataclass(frozen=True)
class Limits:
    """What a sequence has room for."""

    tokens: int = 2048
    segments: int = 256
    loss_tokens: int = 2048


@dataclass(frozen=True)
class Piece:
    """Tokens ``start`` to ``start + length`` of the block's example number ``example``."""

    example: int
    start: int
    length: int


def loss_of(start: int, length: int, loss_start: int) -> int:
    return max(0, start + length - max(start, loss_start))


def fitting(start: int, want: int, loss_start: int, loss_room: int) -> int:
    """The longest piece of at most ``want`` tokens whose loss tokens fit."""
    return min(want, max(0, loss_start - start) + loss_room)


def place(lengths: list[int], loss_starts: list[int], limits: Limits) -> list[list[Piece]]:
    """Sequences of pieces that hold every token of the block's examples once."""
    done: list[list[Piece]] = []
    waiting: list[Piece] = []
    alone = limits.tokens
    for example, (length, loss_start) in enumerate(zip(lengths, loss_starts)):
        start = 0
        while length - start >= alone:
            size = fitting(start, alone, loss_start, limits.loss_tokens)
            done.append([Piece(example, start, size)])
            start += size
        if length > start:
            waiting.append(Piece(example, start, length - start))
    if not waiting:
        return [part for pieces in done for part in powers_of_two(pieces, limits)]

    loss_bears = [loss_starts[p.example] for p in waiting]
    pack = pack_by_length if not any(loss_bears) else pack_by_product
    done += pack(waiting, loss_bears, limits)
    return [part for pieces in done for part in powers_of_two(pieces, limits)]


def pack_by_length(waiting: list[Piece], loss_starts: list[int], limits: Limits) -> list[list[Piece]]:
    """The heuristic where every token bears loss: the dot product grows with the length, so the longest fits best.

    Waiting pieces lie by length, and the bits of one number tell which lengths there are.
    """
    order = sorted(waiting, key=lambda p: -p.length)
    by_length: dict[int, list[int]] = {}
    for at, piece in enumerate(order):
        by_length.setdefault(piece.length, []).append(at)  # rising, so a heap already
    there, first, closed, done = 0, 0, bytearray(len(order)), []
    for length in by_length:
        there |= 1 << length

    def taken(length: int) -> int:
        nonlocal there
        at = heappop(by_length[length])
        if not by_length[length]:
            del by_length[length]
            there ^= 1 << length
        return at

    while there:
        pieces: list[Piece] = []
        left, segments = min(limits.tokens, limits.loss_tokens), limits.segments
        while left > 0 and segments > 0 and there:
            fits = (there & ((2 << left) - 1)).bit_length() - 1
            if fits > 0:
                at = taken(fits)
                pieces.append(order[at])
                closed[at] = True
                left -= fits
            else:  # cut the first, i.e. longest, one
                while closed[first]:
                    first += 1
                piece = order[first]
                by_length[piece.length].remove(first)
                heapify(by_length[piece.length])
                if not by_length[piece.length]:
                    del by_length[piece.length]
                    there ^= 1 << piece.length
                pieces.append(Piece(piece.example, piece.start, left))
                rest = order[first] = Piece(piece.example, piece.start + left, piece.length - left)
                heappush(by_length.setdefault(rest.length, []), first)
                there |= 1 << rest.length
                left = 0
            segments -= 1
        done.append(pieces)
    return done


def pack_by_product(waiting: list[Piece], loss_starts: list[int], limits: Limits) -> list[list[Piece]]:
    """The heuristic in three dimensions, over arrays of what still waits."""
    done: list[list[Piece]] = []
    example = np.array([p.example for p in waiting])
    start = np.array([p.start for p in waiting])
    tokens = np.array([p.length for p in waiting])
    loss_start = np.array(loss_starts, dtype=np.int64)
    room = np.array([limits.tokens, limits.segments, max(1, limits.loss_tokens)], dtype=np.float64)
    open_ = np.ones(len(waiting), dtype=bool)
    order = np.argsort(-tokens, kind="stable")
    example, start, tokens, loss_start = example[order], start[order], tokens[order], loss_start[order]
    n_open = len(order)
    while n_open:
        if n_open < len(open_) // 2:  # what is closed is looked at no more
            example, start, tokens, loss_start = (a[open_] for a in (example, start, tokens, loss_start))
            open_ = np.ones(n_open, dtype=bool)
        pieces: list[Piece] = []
        left = [limits.tokens, limits.segments, limits.loss_tokens]
        while left[0] > 0 and left[1] > 0 and n_open:
            loss = np.maximum(0, start + tokens - np.maximum(start, loss_start))
            fits = open_ & (tokens <= left[0]) & (loss <= left[2])
            if fits.any():
                share = np.array(left, dtype=np.float64) / room
                score = share[0] * tokens / room[0] + share[1] / room[1] + share[2] * loss / room[2]
                at = int(np.argmax(np.where(fits, score, -1.0)))
                size = int(tokens[at])
            else:  # cut the first, i.e. longest, one that has a token that fits
                most = np.minimum(left[0], np.maximum(0, loss_start - start) + left[2])
                can = open_ & (most > 0)
                if not can.any():
                    break
                at = int(np.argmax(can))
                size = int(most[at])
            own_loss = loss_of(int(start[at]), size, int(loss_start[at]))
            pieces.append(Piece(int(example[at]), int(start[at]), size))
            left = [left[0] - size, left[1] - 1, left[2] - own_loss]
            start[at] += size
            tokens[at] -= size
            if not tokens[at]:
                open_[at] = False
                n_open -= 1
        done.append(pieces)
    return done


def powers_of_two(pieces: list[Piece], limits: Limits) -> list[list[Piece]]:
    """One underfull sequence as sequences whose lengths are powers of two, longest first."""
    total, waiting, out = sum(p.length for p in pieces), list(pieces), []
    if total == limits.tokens:
        return [pieces]
    while total:
        size = 1 << (total.bit_length() - 1)
        total -= size
        sequence = []
        while size:
            piece = waiting.pop(0)
            if piece.length > size:
                waiting.insert(0, Piece(piece.example, piece.start + size, piece.length - size))
                piece = Piece(piece.example, piece.start, size)
            sequence.append(piece)
            size -= piece.length
        out.append(sequence)
    return out


PIECES = pa.schema(
    [
        ("key", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
        ("doc_tokens", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()), ("loss_tokens", pa.int64()),
    ]
)
_SPARK_PIECES = (
    "key long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long, loss_tokens long"
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(PIECES)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, PIECES)], schema=PIECES)


class _Block:
    """Examples that wait to be packed together."""

    def __init__(self, limits: Limits, first_sequence: int):
        self.limits, self.sequence = limits, first_sequence
        self.keys, self.ids, self.loss, self.size = [], [], [], 0

    def add(self, key, ids: bytes, loss_start: int) -> None:
        self.size += len(ids)
        self.keys.append(key)
        self.ids.append(ids)
        self.loss.append(loss_start)

    def packed(self) -> Iterator[tuple]:
        lengths = [len(ids) // 4 for ids in self.ids]
        for pieces in place(lengths, self.loss, self.limits):
            offset = 0
            for p in pieces:
                ids = self.ids[p.example][4 * p.start : 4 * (p.start + p.length)]
                loss = loss_of(p.start, p.length, self.loss[p.example])
                yield self.keys[p.example], p.start, p.length, ids, lengths[p.example], self.sequence, offset, loss
                offset += p.length
            self.sequence += 1
        self.keys, self.ids, self.loss, self.size = [], [], [], 0


def pack_texts(
    df: DataFrame, path: str, end_id: int, *, key: str = "doc_id", text: str = "text", loss_from: str | None = None,
    limits: Limits = Limits(), block: int = BLOCK_EXAMPLES,
) -> DataFrame:
    """Pieces of all texts, encoded by the tokenizer at ``path`` and closed by ``end_id``.

    ``loss_from`` names a column with the number of leading characters without loss (the
    prompt of instruction data); without it every token bears loss. Columns of the result:
    ``key``, ``start``, ``length``, ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``,
    ``sequence_id``, ``offset``, ``loss_tokens``.

    A null or empty text is the end id alone; a very long one fills sequences of its own first; null
    keys and repeated rows stay, each row an example of its own; an empty frame gives none. Ties go to
    the example that came first. Other columns are not read.
    """
    if min(limits.tokens, limits.segments, limits.loss_tokens) < 1:
        raise ValueError("a sequence needs room for a token, a segment and a loss-bearing token")
    prompt = F.coalesce(F.col(loss_from).cast("long"), F.lit(0)) if loss_from else F.lit(0).cast("long")
    rows = df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"), prompt.alias("prompt"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = rank_encoder(path), end_id.to_bytes(4, "little")
        waiting = _Block(limits, TaskContext.get().partitionId() << SEQUENCE_BITS)
        for batch in batches:
            keys, prompts = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for row_key, value, row_prompt in zip(keys, batch.column(1), prompts):
                row_text = value.as_py()
                loss_start = len(own.encode(row_text[:row_prompt])) // 4 if row_prompt and row_text else 0
                waiting.add(row_key, own.encode(row_text) + end, loss_start)
                if len(waiting.keys) >= block or waiting.size >= BLOCK_BYTES:
                    yield _batch(list(waiting.packed()))
        yield _batch(list(waiting.packed()))

    return rows.mapInArrow(pack, _SPARK_PIECES)

