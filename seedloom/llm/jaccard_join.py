"""Exact Jaccard self-join on word n-grams by buckets that similar sets have in common, and its components.

A text's set are the hashes of its distinct word n-grams (59 bits and a rank). Two sets that
are similar enough differ in size by no more than the threshold allows, and in a number of
elements that is bounded by their sizes: d at most. Dealt into more than d buckets by their hashes,
they have a whole bucket in common. The join

1. keeps one set per group of equal texts;
2. links sets to a few hubs they share a minimum hash with, at a cost that is linear in their number;
3. keys each set by d + 1 of its buckets, and compares it with one set for each key it shares: the one
   whose keys are the most common. The text that copies were made from has all the keys they share, so
   the near ones of a large family become one component, at a linear cost again;
4. joins the sets of *different* components on the keys that few sets share, each pair once or nearly so, and
   those that many share on their rarest n-grams. Pairs pass filters on size and sketch, and what is left is verified exactly.

Steps 2 and 3 only spare work: step 4 looks at every pair of sets that may be similar and is
not connected already, so no link between components is lost. Copies too far from their center to link
with it still share keys of unchanged words with one another, as many pairs as the square of their number. So sets that meet
more than CROWD others at a key are not paired there. Their n-grams are sorted by the number of crowded sets that
have them, rare ones first: similar sets share one of the first few, and what a far copy has of its own comes before what it shares.

A key stands for all n-grams of a bucket, eight or so at the threshold of 90 to 100, so two sets seldom
share one by chance: pairs grow with the number of near copies, where single n-grams would
meet as often as the square of their frequency.

Sets of a range of sizes (a level) have the same number of buckets. A pair meets at the level of its smaller
set, so a set near the lower end of a level is keyed for the level below as well. There are
some buckets more than d + 1, and a set's weakest go: those whose n-grams have frequent words only, or
few n-grams. Buckets in common are equally strong in both sets, so the strongest of them stays in both.

The strength of a bucket follows the document frequency of its n-grams' rarest word. Words that at
least one document in 4,000 has are counted; their number is bounded by 8,000 times the mean number
of words in a document, and only these are broadcast, as hashes. Any order gives the same result.

Sketches are the parities of 1,024 hash buckets, and of 16,384 for large sets: two sets
differ in at least as many elements as their sketches in bits.

Null texts, and texts without words, have empty sets and link with nothing. Ids may be null
or repeated: rows are told apart by their sets. A component of null ids only is null. Very long
texts have large sets, which are verified whole like all others. Extra columns are not read; an
empty frame gives an empty frame.
"""

from __future__ import annotations

from array import array
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    LongType,
    StructField,
    StructType,
)

from seedloom.llm.components import components
from seedloom.llm.frames import free_name, small_batches, stored

RANK_BITS, HASH_BITS = 5, 59
SKETCH_BITS, N_HASHES = 1024, 3
#: Hubs per shared minimum hash.
HUBS = 3
#: Keys before a shared one that are looked at for others in common.
N_BEFORE = 4
#: Sets of a key that are paired there.
CROWD = 8
#: Of so many needed buckets there is one more, so that weak ones can go.
SPARE_ONE_IN = 4
#: 64-bit numbers of a sketch that travel with every n-gram; folded, it still differs in no more bits than the sets do.
NARROW = 4
#: Texts whose sets are handed on at once.
SLICE = 500
#: Sets above this size have a second, wider sketch; the first is full for them.
WIDE_FROM, WIDE_BITS = 1800, 16384
#: A word is frequent if one document in so many has it.
FREQUENT_ONE_IN = 4000
#: Ids of texts to verify are broadcast up to this many (16 bytes each), and joined otherwise.
BROADCAST_ROWS = 200_000
WORD_CACHE = 200_000
_MASK = np.uint64((1 << HASH_BITS) - 1)


@dataclass(frozen=True)
class Threshold:
    """Jaccard similarity of at least ``over / under``, in whole numbers."""

    over: int = 90
    under: int = 100

    def prefix(self, n: int) -> int:
        """Elements of a set's prefix: any similar set shares one of them."""
        return n - -(-self.over * n // self.under) + 1

    def differing(self, n: int) -> int:
        """Elements in which a set of up to this size and a similar one of at least its own size may differ, at most."""
        return (n + n * self.under // self.over) * (self.under - self.over) // (self.under + self.over)

    def places(self, n: Column, m: Column) -> Column:
        """Of n elements in an order that holds for all sets, the first so many have one in common with a similar set of m."""
        return n - self.needed(n, m) + 1

    def next_level(self, start: int) -> int:
        """First size of the level after the one that starts here: similar sets are of one level or of neighbours."""
        return max(start + 1, -(-start * self.under // self.over), start * self.under**2 // self.over**2)

    def needed(self, n: Column, m: Column) -> Column:
        """Elements that sets of these sizes must share: the least whole number of at least over (n + m) / (over + under)."""
        both = self.over + self.under
        return F.floor((F.lit(self.over) * (n + m) + F.lit(both - 1)) / both).cast("long")

    def sizes_fit(self, n: Column, m: Column) -> Column:
        return (F.lit(self.under) * n >= F.lit(self.over) * m) & (F.lit(self.under) * m >= F.lit(self.over) * n)

    def linked(self, shared: Column, n: Column, m: Column) -> Column:
        return F.lit(self.under) * shared >= F.lit(self.over) * (n + m - shared)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8").lower().split()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers (multiply and shift)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# --- frequent words ----------------------------------------------------------


def frequent_words(texts: DataFrame, one_in: int = FREQUENT_ONE_IN) -> tuple[np.ndarray, np.ndarray]:
    """Sorted word hashes and their ranks 1 to 31, 9 bytes a word: how often, in powers of two, a frequent word is found in documents.

    A task reports the words that the wanted share of its own rows has, two at least; a word
    that is frequent on the whole is frequent in some task, so it is reported.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[bytes] = Counter()
        rows, room = 0, WORD_CACHE
        for batch in batches:
            for text in batch.column(0):
                found.update(set(words_of(text.as_py())))
                rows += 1
                if len(found) > room:  # lossy counting: what is rare so far goes
                    least = max(1, rows // (2 * one_in))
                    found = Counter({word: n for word, n in found.items() if n > least})
                    room = len(found) + WORD_CACHE
        often = [(xxhash.xxh3_64_intdigest(word), n) for word, n in found.items() if n >= max(2, rows / one_in)]
        hashes = np.array([h for h, _ in often], dtype=np.uint64).view(np.int64)
        yield pa.record_batch(
            [pa.array(hashes), pa.array([n for _, n in often], pa.int64()), pa.array([rows] * len(often), pa.int64())],
            names=["word", "n", "rows"],
        )

    counted = texts.select("text").mapInArrow(count, "word long, n long, rows long")
    total = texts.count()
    kept = counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") * (2 * one_in) >= total)
    ranks = kept.select("word", F.least(F.lit(31), 1 + F.floor(F.log2(F.col("n") * (2.0 * one_in) / max(total, 1)))).alias("rank"))
    table = ranks.select("word", F.col("rank").cast("int").alias("rank")).toArrow()
    words, order = table.column("word").to_numpy().view(np.uint64), table.column("rank").to_numpy()
    by_hash = np.argsort(words)
    return words[by_hash], order[by_hash].astype(np.uint8)


class Words(dict):
    """Hash and rank of a word as one number, by word; forgets when full."""

    def __init__(self, ranks: tuple[np.ndarray, np.ndarray]):
        super().__init__()
        self.hashes, self.ranks = array("Q", ranks[0].tobytes()), ranks[1].tobytes()

    def rank(self, digest: int) -> int:
        at = bisect_left(self.hashes, digest)
        return self.ranks[at] if at < len(self.hashes) and self.hashes[at] == digest else 0

    def __missing__(self, word: bytes) -> int:
        digest = xxhash.xxh3_64_intdigest(word)
        value = self.rank(digest) << HASH_BITS | digest & (1 << HASH_BITS) - 1
        if len(self) >= WORD_CACHE:
            self.clear()
        self[word] = value
        return value


def elements(text: str | None, words: Words, size: int) -> np.ndarray:
    """The sorted set of a text: rank of the rarest word above, hash of the n-gram below."""
    found = words_of(text)
    if not found:
        return np.empty(0, dtype=np.uint64)
    numbers = np.fromiter(map(words.__getitem__, found), dtype=np.uint64, count=len(found))
    length = min(size, len(numbers))
    rows = len(numbers) - length + 1
    total, rank = np.full(rows, length, dtype=np.uint64), np.full(rows, 31, dtype=np.uint64)
    for at in range(length):
        part = numbers[at : at + rows]
        total = mixed(total + (part & _MASK))
        rank = np.minimum(rank, part >> np.uint64(HASH_BITS))
    return np.unique(rank << np.uint64(HASH_BITS) | total >> np.uint64(RANK_BITS))


# --- sets --------------------------------------------------------------------

_SET = StructType([
    StructField("node", BinaryType()), StructField("n", LongType()), StructField("keys", ArrayType(LongType())),
    StructField("group", BinaryType()), StructField("sketch", ArrayType(LongType())),
    StructField("hashes", ArrayType(LongType())), StructField("wide", ArrayType(LongType())),
])


def sketch_of(found: np.ndarray, bits: int = SKETCH_BITS) -> np.ndarray:
    """Whether each of so many hash buckets holds an odd number of elements, as 64-bit numbers."""
    odd = np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view("<i8")


def minima(found: np.ndarray) -> list[int]:
    """Minimum hashes, each kind marked by its number so that kinds don't meet."""
    seeds = [np.uint64((k + 1) * 0x9E3779B97F4A7C15 & 2**64 - 1) for k in range(N_HASHES)]
    hashes = (mixed(found + seed).min() for seed in seeds)
    return [int((h & ~np.uint64(3) | np.uint64(k)).view(np.int64)) for k, h in enumerate(hashes)]


class Levels:
    """The levels of sizes, made as far as they are asked for."""

    def __init__(self, threshold: Threshold):
        self.threshold, self.starts = threshold, [1, threshold.next_level(1)]

    def of(self, n: int) -> list[int]:
        """Levels at which a set of ``n`` elements may meet similar ones."""
        while self.starts[-1] <= n:
            self.starts.append(self.threshold.next_level(self.starts[-1]))
        own = bisect_right(self.starts, n) - 1
        least = -(-self.threshold.over * n // self.threshold.under)
        return [own - 1, own] if least < self.starts[own] else [own]

    def differing(self, level: int) -> int:
        return self.threshold.differing(self.starts[level + 1] - 1)


def bucket_keys(found: np.ndarray, level: int, differing: int) -> np.ndarray:
    """Keys of a set's strongest ``differing + 1`` buckets: similar sets of the level share one. No keys where only equal sets are similar."""
    if not differing:
        return np.empty(0, dtype=np.uint64)
    n_buckets = differing + 1 + differing // SPARE_ONE_IN
    hashes = mixed(found + np.uint64(level + 1))
    bucket = ((hashes >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(bucket)
    first = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    which = bucket[order][first]
    sums, sizes, ranks = np.zeros(n_buckets, dtype=np.uint64), np.bincount(bucket, minlength=n_buckets), np.full(n_buckets, 32, dtype=np.int64)
    sums[which] = np.add.reduceat(hashes[order], first)
    ranks[which] = np.minimum.reduceat((found >> np.uint64(HASH_BITS)).astype(np.int64)[order], first)
    keys = mixed(sums + mixed(np.arange(n_buckets, dtype=np.uint64) + np.uint64(level + 1 << 32)))
    return keys[np.lexsort((keys, -sizes, ranks))[: differing + 1]]


def keys_of(found: np.ndarray, levels: Levels) -> np.ndarray:
    return np.concatenate([bucket_keys(found, level, levels.differing(level)) for level in levels.of(len(found))])


def list_array(parts: list[np.ndarray]) -> pa.Array:
    """One list per part, built without a Python object per number."""
    ends = np.cumsum([0, *map(len, parts)], dtype=np.int32)
    values = np.concatenate([*parts, np.empty(0, dtype=np.int64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))


def set_rows(texts: pa.Array, words: Words, size: int, threshold: Threshold) -> pa.Array:
    """The structs of :data:`_SET` for texts, null where there are no words."""
    nodes, sizes, keys, groups, sketches, hashes, wide = [], [], [], [], [], [], []
    none, levels = np.empty(0, dtype=np.int64), Levels(threshold)
    for text in texts:
        found = elements(text.as_py(), words, size)
        sizes.append(len(found))
        if len(found):
            prefix = found[: threshold.prefix(len(found))]
            nodes.append(xxhash.xxh3_128_digest(found.tobytes()))
            keys.append(keys_of(found, levels).view(np.int64))
            groups.append(xxhash.xxh3_128_digest(prefix.tobytes() + len(found).to_bytes(8, "little")))
            sketches.append(sketch_of(found))
            hashes.append(np.array(minima(found), dtype=np.int64))
            wide.append(sketch_of(found, WIDE_BITS) if len(found) > WIDE_FROM else none)
        else:
            nodes.append(None)
            groups.append(None)
            for lists in (keys, sketches, hashes, wide):
                lists.append(none)
    columns = [
        pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), list_array(keys), pa.array(groups, pa.binary()),
        list_array(sketches), list_array(hashes), list_array(wide),
    ]
    return pa.StructArray.from_arrays(columns, names=[f.name for f in _SET], mask=pa.array([n is None for n in nodes]))


def _sets_udf(ranks, size: int, threshold: Threshold):
    @F.arrow_udf(_SET)
    def sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = Words(ranks.value)
        for texts in batches:
            for at in range(0, len(texts), SLICE):
                yield set_rows(texts.slice(at, SLICE), words, size, threshold)

    return sets


_CONTENTS = StructType([StructField("node", BinaryType()), StructField("contents", BinaryType())])


def _contents_udf(ranks, size: int):
    @F.arrow_udf(_CONTENTS)
    def contents(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = Words(ranks.value)
        for batch in batches:
            for at in range(0, len(batch), SLICE):
                sets = [elements(text.as_py(), words, size).tobytes() for text in batch.slice(at, SLICE)]
                nodes = pa.array([xxhash.xxh3_128_digest(found) for found in sets], pa.binary())
                yield pa.StructArray.from_arrays([nodes, pa.array(sets, pa.binary())], names=["node", "contents"])

    return contents


@F.arrow_udf(ArrayType(LongType()))
def numbers(contents: pa.Array) -> pa.Array:
    return list_array([np.frombuffer(found.as_py(), np.int64) for found in contents])


@F.arrow_udf(LongType())
def n_shared(left: pa.Array, right: pa.Array) -> pa.Array:
    counts = []
    for a, b in zip(left, right):
        a, b = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
        counts.append(len(a) + len(b) - len(np.union1d(a, b)))
    return pa.array(counts, pa.int64())


def differ(left: str, right: str, words: int = SKETCH_BITS // 64) -> Column:
    """Bits in which two sketches differ."""
    return sum((F.bit_count(F.col(left)[i].bitwiseXOR(F.col(right)[i])) for i in range(words)), F.lit(0))


def apart() -> Column:
    """Labels differ, and not both are the main one where two sets meet: a pair comes once, the minor one as ``b``."""
    return (F.col("label_a") < F.col("label_b")) | (~F.col("minor_a") & (F.col("label_a") != F.col("label_b")))


def folded(sketch: str) -> Column:
    """The sketch of a quarter of the buckets: parities of buckets that are taken together."""
    n = SKETCH_BITS // 64
    return F.array(*[reduce(Column.bitwiseXOR, [F.col(sketch)[j] for j in range(i, n, NARROW)]) for i in range(NARROW)])


def two_links(links: DataFrame) -> DataFrame:
    """``node, label`` of sets with links: a small one among those at most two links away, so equal labels are of one component."""
    ends = links.union(links.select("b", "a")).union(links.select("a", "a")).union(links.select("b", "b"))
    least = stored(ends.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least")), "least")
    return ends.join(least, F.col("b") == F.col("node")).groupBy(F.col("a").alias("node")).agg(F.min("least").alias("label"))


class JaccardJoin:
    """One self-join: the texts, their sets, links between sets, and components."""

    def __init__(self, df: DataFrame, *, key: str = "doc_id", text: str = "text", size: int = 3, threshold: Threshold = Threshold()):
        self.df, self.key, self.text = df, key, text
        self.texts = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
        self.size, self.threshold = size, threshold
        with small_batches(df.sparkSession):
            self.ranks = df.sparkSession.sparkContext.broadcast(frequent_words(self.texts))
            row = F.xxhash64("text")
            found = _sets_udf(self.ranks, size, threshold)(F.col("text")).alias("set")
            self.sets = stored(self.texts.select("key", row.alias("text_hash"), found).select("key", "text_hash", "set.*"), "sets")

    def nodes(self) -> DataFrame:
        """One row per distinct set, with a row of the input that has it."""
        return self.sets.where(F.col("node").isNotNull()).groupBy("node").agg(
            F.min(F.struct("key", "text_hash")).alias("sample"), F.first("n").alias("n"), F.first("group").alias("group"),
            F.first("sketch").alias("sketch"), F.first("hashes").alias("hashes"), F.first("wide").alias("wide"),
        )

    def verified(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """The pairs ``a, b`` of sets that are linked, by their whole contents; stored."""
        pairs = stored(self.by_wide_sketch(pairs, nodes), "pairs")
        ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
        contents = self.contents(nodes.join(ends, "node", "left_semi"))
        left = contents.select(F.col("node").alias("a"), F.col("contents").alias("in_a"))
        right = contents.select(F.col("node").alias("b"), F.col("contents").alias("in_b"))
        compared = pairs.select("a", "b").join(left, "a").join(right, "b")
        n, m = F.octet_length("in_a") / 8, F.octet_length("in_b") / 8
        compared = compared.select("a", "b", n.cast("long").alias("n"), m.cast("long").alias("m"), n_shared("in_a", "in_b").alias("shared"))
        linked = self.threshold.linked(F.col("shared"), F.col("n"), F.col("m"))
        with small_batches(self.df.sparkSession):
            return stored(compared.where(linked).select("a", "b", "shared"), "links")

    def contents(self, some: DataFrame) -> DataFrame:
        """``node, contents`` of some of the sets, made anew from their texts."""
        asked = stored(some.select("node", "sample"), "asked").select(
            F.col("sample.key").alias("of_key"), F.col("sample.text_hash").alias("of_text")
        )
        few = asked.count() <= BROADCAST_ROWS
        rows = self.texts.withColumn("text_hash", F.xxhash64("text")).join(
            F.broadcast(asked) if few else asked,
            (F.col("text_hash") == F.col("of_text")) & F.col("key").eqNullSafe(F.col("of_key")), "left_semi",
        )
        rows = rows.groupBy("text_hash", "key").agg(F.first("text").alias("text"))
        contents = rows.select(_contents_udf(self.ranks, self.size)(F.col("text")).alias("set"))
        return contents.select("set.*").dropDuplicates(["node"])

    def by_wide_sketch(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """The pairs without those of two large sets whose wide sketches differ too much."""
        large = nodes.where(F.size("wide") > 0)
        left = large.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("wide").alias("wide_a"))
        right = large.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("wide").alias("wide_b"))
        both = pairs.join(left, "a", "left").join(right, "b", "left")
        bits = F.zip_with("wide_a", "wide_b", lambda x, y: F.bit_count(x.bitwiseXOR(y)))
        apart = F.aggregate(bits, F.lit(0), lambda total, x: total + x)
        n, m = F.col("n_a"), F.col("n_b")
        too_far = apart > n + m - 2 * self.threshold.needed(n, m)
        return both.where(~F.coalesce(too_far, F.lit(False))).select("a", "b")

    def may_link(self, sketches: tuple[str, str], n: Column, m: Column) -> Column:
        """Filters on size and sketch: similar sets differ in at most n + m - 2 needed elements."""
        allowed = n + m - 2 * self.threshold.needed(n, m)
        return self.threshold.sizes_fit(n, m) & (differ(*sketches) <= allowed)

    def by_sketch(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """The pairs ``a, b`` of sets that size and sketch allow."""
        side = nodes.select("node", "n", "sketch")
        left = side.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("sketch").alias("sketch_a"))
        right = side.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
        both = pairs.join(left, "a").join(right, "b")
        return both.where(self.may_link(("sketch_a", "sketch_b"), F.col("n_a"), F.col("n_b"))).select("a", "b")

    def hub_pairs(self, nodes: DataFrame) -> DataFrame:
        """Step 2: each set with a few of those that share a minimum hash or a group: the first sets in as many orders."""
        keyed = nodes.select("node", F.explode(F.array_append("hashes", F.xxhash64("group"))).alias("shared"))
        first = [F.min(F.struct(F.xxhash64("node", F.lit(i)).alias("order"), "node")).alias(f"hub{i}") for i in range(HUBS)]
        hubs = keyed.groupBy("shared").agg(F.count(F.lit(1)).alias("sets"), *first).where(F.col("sets") > 1)
        # Stored, so that the join reads it through an exchange of its own and a hot minimum can be split.
        hubs = stored(hubs.select("shared", F.array_distinct(F.array(*[f"hub{i}.node" for i in range(HUBS)])).alias("hubs")), "hubs")
        met = keyed.join(hubs, "shared").select("node", F.explode("hubs").alias("hub")).where(F.col("node") != F.col("hub"))
        return self.by_sketch(met.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct(), nodes)

    def linked(self, labels: DataFrame) -> DataFrame:
        """``id, linked``: 64-bit hashes of the sets whose label is another set, and of the label; a hint where they are few."""
        linked = labels.where(F.col("node") != F.col("label")).select(F.xxhash64("node").alias("id"), F.xxhash64("label").alias("linked"))
        linked = stored(linked.dropDuplicates(["id"]), "linked")
        return F.broadcast(linked) if linked.count() <= BROADCAST_ROWS else linked

    def keyed(self, labels: DataFrame) -> DataFrame:
        """``key, id, label`` of all sets; sets and labels are 64-bit hashes. Should two ever share one, both are looked at."""
        sets = self.sets.where(F.size("keys") > 0).select(F.xxhash64("node").alias("id"), "keys")
        sets = sets.join(self.linked(labels), "id", "left")
        return sets.select(F.explode("keys").alias("key"), "id", F.coalesce("linked", "id").alias("label"))

    def shared_keys(self, labels: DataFrame, nodes: DataFrame) -> DataFrame:
        """The keys that sets of different labels share, with these sets; stored.

        ``before`` are the set's last few keys before this one, ``score`` says in how many rows its keys are found.
        All keys are shuffled once. A row of the input has a key once, and many keys, so no key has a large share of them.
        """
        of_key, of_set = Window.partitionBy("key"), Window.partitionBy("id")
        ends = {"least": F.min("label").over(of_key), "most": F.max("label").over(of_key), "rows": F.count(F.lit(1)).over(of_key)}
        met = self.keyed(labels).withColumns(ends).where(F.col("least") != F.col("most"))
        index = met.select("key", "id", "label", "rows").distinct()
        before = [F.lag("key", i).over(of_set.orderBy("key")) for i in range(1, N_BEFORE + 1)]
        index = index.withColumns({"score": F.sum("rows").over(of_set), "before": F.array_compact(F.array(*before))}).drop("rows")
        members = nodes.select("n", folded("sketch").alias("sketch"), F.xxhash64("node").alias("id"))
        return stored(index.join(members, "id"), "shared")

    def centers(self, shared: DataFrame) -> DataFrame:
        """``key, center``: for each key the set that has most in common with others; stored, as the hubs are."""
        center = F.max(F.struct("score", F.col("id").alias("center")))
        return stored(shared.groupBy("key").agg(center.alias("best")).select("key", "best.center"), "centers")

    def center_pairs(self, shared: DataFrame, centers: DataFrame, nodes: DataFrame) -> DataFrame:
        """Step 3: each set with the centers of its keys, unless they have its label."""
        of_center = shared.select(F.col("id").alias("center"), F.col("label").alias("center_label")).distinct()
        met = shared.select("key", "id", "label").join(centers, "key").select("id", "label", "center").distinct()
        met = met.join(of_center, "center").where(F.col("label") != F.col("center_label"))
        return self.of_ids(met.select(F.least("id", "center").alias("id_a"), F.greatest("id", "center").alias("id_b")), nodes)

    def of_ids(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """The pairs ``a, b`` of sets with these hashes that size and sketch allow."""
        side = nodes.select(F.xxhash64("node").alias("id"), "node", "n", "sketch")
        left, right = (side.toDF(*[f"{c}_{end}" for c in side.columns]) for end in "ab")
        both = pairs.distinct().join(left, "id_a").join(right, "id_b")
        fits = self.may_link(("sketch_a", "sketch_b"), F.col("n_a"), F.col("n_b"))
        return both.where(fits).select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()

    def relabelled(self, labels: DataFrame, shared: DataFrame, centers: DataFrame) -> DataFrame:
        """``shared`` with the labels of now, at keys that sets of several labels have; stored.

        ``minor`` says that a set has not the label of the key's center, ``sets`` how many sets have the key.
        """
        linked, of_key = self.linked(labels), Window.partitionBy("key")
        shared = shared.drop("label").join(linked, "id", "left").withColumn("label", F.coalesce("linked", "id")).drop("linked", "score")
        of_center = centers.join(linked, F.col("center") == F.col("id"), "left").select("key", F.coalesce("linked", "center").alias("of_center"))
        shared = shared.join(of_center, "key").withColumn("minor", F.col("label") != F.col("of_center")).drop("of_center")
        shared = shared.withColumns({"sets": F.count(F.lit(1)).over(of_key), "any": F.max("minor").over(of_key)})
        return stored(shared.where("any").drop("any"), "relabelled")

    def key_pairs(self, labels: DataFrame, shared: DataFrame, centers: DataFrame) -> DataFrame:
        """``id_a, id_b``: pairs of sets of different labels that share a key, where size and the folded sketch allow it.

        Sets that have the label of a key's center are not paired with one another there. A pair comes at
        the first of its keys, and not at others where one of the last few keys before is shared as well.
        Sets that share a crowded key are paired by their n-grams.
        """
        shared = self.relabelled(labels, shared, centers)
        columns = ("id", "label", "n", "sketch", "before", "minor")
        rest = shared.where(F.col("sets") <= CROWD)
        left = rest.select("key", *[F.col(c).alias(f"{c}_a") for c in columns])
        right = rest.where("minor").select("key", *[F.col(c).alias(f"{c}_b") for c in columns])
        n, m = F.col("n_a"), F.col("n_b")
        near = differ("sketch_a", "sketch_b", NARROW) <= n + m - 2 * self.threshold.needed(n, m)
        fits = apart() & self.threshold.sizes_fit(n, m) & near & ~F.arrays_overlap("before_a", "before_b")
        pairs = left.join(right, (left["key"] == right["key"]) & fits)
        pairs = pairs.select(F.least("id_a", "id_b").alias("id_a"), F.greatest("id_a", "id_b").alias("id_b"))
        crowded = stored(shared.where(F.col("sets") > CROWD).select("id", "label").distinct(), "crowded")
        return pairs if crowded.isEmpty() else pairs.union(self.crowded_pairs(crowded))

    def crowded_pairs(self, crowded: DataFrame) -> DataFrame:
        """``id_a, id_b``: pairs of these sets, of different labels, that share an n-gram among the first so many of both."""
        few = crowded.count() <= BROADCAST_ROWS
        rows = self.sets.select("key", "text_hash", "node", F.xxhash64("node").alias("id")).join(F.broadcast(crowded) if few else crowded, "id")
        named = stored(rows.groupBy("node", "label").agg(F.min(F.struct("key", "text_hash")).alias("sample")), "named")
        found = self.contents(named).select("node", numbers("contents").alias("grams")).join(named.select("node", "label"), "node")
        each = found.select("node", "label", F.size("grams").cast("long").alias("n"), F.explode("grams").alias("gram"))
        of_gram, of_set = Window.partitionBy("gram"), Window.partitionBy("node")
        each = each.withColumn("sets", F.count(F.lit(1)).over(of_gram)).where(F.col("sets") > 1)
        alone = F.col("n") - F.count(F.lit(1)).over(of_set)  # n-grams of this set only come first
        each = each.withColumn("place", alone + F.row_number().over(of_set.orderBy("sets", "gram")))
        n = F.col("n")
        longest = n - F.ceil(F.lit(self.threshold.over) * n / self.threshold.under) + 1
        each = each.where(F.col("place") <= longest).withColumn("minor", F.col("label") != F.mode("label").over(of_gram))
        with small_batches(self.df.sparkSession):
            each = stored(each.select("gram", "node", "label", "n", "place", "minor"), "grams")
        columns = ("node", "label", "n", "place", "minor")
        left = each.select("gram", *[F.col(c).alias(f"{c}_a") for c in columns])
        right = each.where("minor").select("gram", *[F.col(c).alias(f"{c}_b") for c in columns])
        n, m = F.col("n_a"), F.col("n_b")
        first = (F.col("place_a") <= self.threshold.places(n, m)) & (F.col("place_b") <= self.threshold.places(m, n))
        pairs = left.join(right, (left["gram"] == right["gram"]) & apart() & self.threshold.sizes_fit(n, m) & first)
        a, b = F.xxhash64("node_a"), F.xxhash64("node_b")
        return pairs.select(F.least(a, b).alias("id_a"), F.greatest(a, b).alias("id_b")).distinct()

    def far_pairs(self, labels: DataFrame, labelled: DataFrame, shared: DataFrame | None = None, centers: DataFrame | None = None) -> DataFrame:
        """Step 4: pairs of sets of different components that share a key."""
        shared = self.shared_keys(labels, labelled) if shared is None else shared
        centers = self.centers(shared) if centers is None else centers
        return self.of_ids(self.key_pairs(labels, shared, centers), labelled)

    @cached_property
    def labels(self) -> DataFrame:
        """``node, label`` of the sets that have links; the label is the component's smallest node."""
        nodes = stored(self.nodes(), "nodes")
        links = self.verified(self.hub_pairs(nodes), nodes).select("a", "b")
        shared = self.shared_keys(two_links(links), nodes)
        centers = self.centers(shared)
        central = self.verified(self.center_pairs(shared, centers, nodes), nodes).select("a", "b")
        labels = components(links.union(central))
        far = self.verified(self.far_pairs(labels, nodes, shared, centers), nodes).select("a", "b")
        if far.isEmpty():
            return labels
        stars = labels.where(F.col("node") != F.col("label")).select(F.col("node").alias("a"), F.col("label").alias("b"))
        return components(stars.union(far))

    def labelled_rows(self) -> DataFrame:
        """The input's rows by key and text hash with size and label; no label without words."""
        rows = self.sets.select("key", "text_hash", "n", "node").join(self.labels, "node", "left")
        return rows.withColumn("label", F.coalesce("label", "node")).drop("node")

    def components(self) -> DataFrame:
        """``key, n, component`` per row of the input: its set's size and the smallest key in reach."""
        rows = self.labelled_rows()
        smallest = rows.where(F.col("label").isNotNull()).groupBy("label").agg(F.min("key").alias("smallest"))
        smallest = stored(smallest, "smallest")  # read through an exchange of its own, so a hot label can be split
        return rows.join(smallest, "label", "left").select(
            "key", F.coalesce("n", F.lit(0)).cast("long").alias("n"),
            F.when(F.col("label").isNull(), F.col("key")).otherwise(F.col("smallest")).alias("component"),
        )

    def representatives(self) -> DataFrame:
        """The input's rows with one row per component: the smallest key's, null keys last.

        Rows that share key and text count as one, whatever their other columns; any of them
        stays. Rows without words have no links, so all of them stay.
        """
        rows = self.labelled_rows().where(F.col("label").isNotNull())
        order = F.struct(F.col("key").isNull(), "key", "text_hash")
        best = stored(rows.groupBy("label").agg(F.min(order).alias("best")), "best")
        marked = rows.join(best, "label").groupBy("key", "text_hash").agg(
            F.max(order == F.col("best")).alias("stays"), F.count(F.lit(1)).alias("rows")
        )
        changed = stored(marked.where(~F.col("stays") | (F.col("rows") > 1)), "changed").select(
            F.col("key").alias("of_key"), F.col("text_hash").alias("of_text"), "stays"
        )
        few = changed.count() <= BROADCAST_ROWS
        name = free_name(self.df, "text_hash")
        hashed = self.df.withColumn(name, F.xxhash64(F.col(self.text).cast("string")))

        def having(some: DataFrame, kind: str) -> DataFrame:
            same = (F.col(name) == F.col("of_text")) & F.col(self.key).eqNullSafe(F.col("of_key"))
            some = some.select(F.col("of_key"), F.col("of_text"))
            return hashed.join(F.broadcast(some) if few else some, same, kind)

        once = having(changed.where("stays"), "left_semi").dropDuplicates([self.key, name])
        return having(changed, "left_anti").unionByName(once).drop(name)
