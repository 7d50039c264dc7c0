"""Positions in a hash order without sorting the data in one place.

A sample, a split or a per-level quota only asks which rows come before the k-th
one. :class:`KeyOrder` finds the k-th key itself: it counts rows per key prefix,
walks into the prefix that holds position k, and repeats with longer prefixes
until few enough rows are left to rank. Every pass reads two narrow columns and
returns a bounded number of rows, and the sample is then a plain filter
``key <= cut``: the data are not shuffled at all.

:func:`global_rank` numbers every row, where the numbers themselves are wanted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seedloom.session import scratch
from seedloom.sources.files import small_table, store

# At most this many levels pass through the driver and a broadcast table; beyond
# it the callers rank in the cluster (see level_rank).
MAX_LEVELS = 1000
# A prefix with at most this many rows is ranked in one window partition.
EDGE_ROWS = 100_000
PREFIX_STEP = 2
FANOUT = 16**PREFIX_STEP
KEY_LENGTH = 32
BUCKET_ROWS = 1_000_000

# Above every md5 text and below none: cuts that keep all rows or no row.
ALL, NONE = "~", ""


class TooManyLevels(Exception):
    """There are more levels than the driver should hold."""


class _Search:
    """The search for one position: the rows it lies among and how many come before."""

    def __init__(self, level: str, slot: int, rank: int) -> None:
        self.level, self.slot, self.rank, self.prefix = level, slot, rank, ""

    def enter(self, counts: dict[str, int]) -> int:
        """Go into the prefix that holds the position; returns its number of rows."""
        for prefix in sorted(counts):
            if self.rank <= counts[prefix]:
                self.prefix = prefix
                return counts[prefix]
            self.rank -= counts[prefix]
        raise AssertionError("position beyond the counted rows")


class KeyOrder:
    """The rows of each level in the order of their keys.

    ``key`` is an md5 text (see ``order_key``), ``by`` a level that is not null;
    without it there is the single level ``""``. Making one counts the rows.
    """

    def __init__(self, df: DataFrame, key: Column, by: Column | None = None) -> None:
        level = F.lit("") if by is None else by.cast("string")
        self._keyed = df.select(level.alias("level"), key.alias("key"))
        # Only then are the counts few enough to collect: MAX_LEVELS x FANOUT.
        if by is not None and self._keyed.select("level").distinct().limit(MAX_LEVELS + 1).count() > MAX_LEVELS:
            raise TooManyLevels
        self._counts: dict[str, dict[str, int]] = {} if by is not None else {"": {}}
        for row in self._prefix_counts(self._keyed, PREFIX_STEP).collect():
            self._counts.setdefault(row.level, {})[row.prefix] = row.n
        self.sizes = {name: sum(counts.values()) for name, counts in self._counts.items()}

    @property
    def size(self) -> int:
        return sum(self.sizes.values())

    def cut(self, rank: int) -> str:
        """Key of the row at ``rank`` where there is a single level."""
        return self.cuts({"": [rank]})[""][0]

    def cuts(self, ranks: dict[str, list[int]]) -> dict[str, list[str]]:
        """Keys at the wanted positions (1 is first) of each level.

        A position of 0 gives a cut below all rows, one at or past the end a cut
        above all rows.
        """
        cuts: dict[str, list[str]] = {}
        searches: list[_Search] = []
        for name, wanted in ranks.items():
            cuts[name] = [NONE if rank <= 0 else ALL for rank in wanted]
            for slot, rank in enumerate(wanted):
                if 0 < rank < self.sizes.get(name, 0):
                    searches.append(_Search(name, slot, rank))

        found = {(name, ""): counts for name, counts in self._counts.items()}
        width = PREFIX_STEP
        while searches:
            narrow, wide = [], []
            for search in searches:
                left = search.enter(found[(search.level, search.prefix)])
                (wide if left > EDGE_ROWS and width < KEY_LENGTH else narrow).append(search)
            for search, cut in zip(narrow, self._keys_at(narrow)):
                cuts[search.level][search.slot] = cut
            searches, found = wide, {}
            if wide:
                width += PREFIX_STEP
                for row in self._prefix_counts(self._within(wide), width).collect():
                    place = (row.level, row.prefix[:-PREFIX_STEP])
                    found.setdefault(place, {})[row.prefix] = row.n
        return cuts

    @staticmethod
    def _prefix_counts(keyed: DataFrame, width: int) -> DataFrame:
        prefix = F.substring("key", 1, width).alias("prefix")
        return keyed.groupBy("level", prefix).agg(F.count(F.lit(1)).alias("n"))

    def _within(self, searches: list[_Search]) -> DataFrame:
        """Rows in the prefixes the searches stand at (all of one width)."""
        places = {f"{search.prefix}|{search.level}" for search in searches}
        prefix = F.substring("key", 1, len(searches[0].prefix))
        return self._keyed.where(F.concat_ws("|", prefix, "level").isin(*sorted(places)))

    def _keys_at(self, searches: list[_Search]) -> list[str]:
        """The keys the searches end at: ranks among at most ``EDGE_ROWS`` rows each."""
        if not searches:
            return []
        targets = {f"{search.prefix}|{search.rank}|{search.level}" for search in searches}
        prefix = F.substring("key", 1, len(searches[0].prefix)).alias("prefix")
        order = Window.partitionBy("level", "prefix").orderBy("key")
        edge = self._within(searches).select("level", "key", prefix)
        place = F.concat_ws("|", "prefix", F.row_number().over(order).cast("string"), "level")
        hits = edge.select("key", place.alias("place")).where(F.col("place").isin(*sorted(targets)))
        keys = {row.place: row.key for row in hits.collect()}
        return [keys[f"{s.prefix}|{s.rank}|{s.level}"] for s in searches]


def up_to(key: Column, cut: str) -> Column:
    """Condition: the row is at or before the cut."""
    if cut in (ALL, NONE):
        return F.lit(cut == ALL)
    return key <= F.lit(cut)


def with_cut(df: DataFrame, cuts: dict[str, list[str]], by: Column, name: str = "_cut") -> DataFrame:
    """Adds each row's first cut of its level, from a table of at most ``MAX_LEVELS`` rows."""
    rows = [(level, cut[0]) for level, cut in sorted(cuts.items())]
    if len(rows) > MAX_LEVELS:
        raise TooManyLevels
    if not rows:
        return df.withColumn(name, F.lit(NONE))
    table = small_table(df.sparkSession, rows, ("_level", name))
    return df.join(F.broadcast(table), by.cast("string") == F.col("_level"), "left").drop("_level")


def bucket_digits(rows: int) -> int:
    """Key digits that give buckets of about a million rows (256 to 65,536 buckets)."""
    digits = 2
    while digits < 4 and rows > BUCKET_ROWS * 16**digits:
        digits += 1
    return digits


def _numbered(df: DataFrame, key: Column, levels: list[Column], digits: int, name: str, bounded: bool) -> DataFrame:
    """Rank inside ``(levels, key prefix)`` buckets plus the rows of the buckets before."""
    level_names = [f"_level{at}" for at in range(len(levels))]
    keyed = df.withColumns(dict(zip(level_names, levels)) | {"_key": key})
    keyed = keyed.withColumn("_bucket", F.substring("_key", 1, digits))
    bucket = [*level_names, "_bucket"]
    counts = keyed.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_n"))
    before = (
        Window.partitionBy(*level_names).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = counts.select(*bucket, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    if bounded:
        offsets = F.broadcast(offsets)
    inside = F.row_number().over(Window.partitionBy(*bucket).orderBy("_key"))
    return (
        keyed.withColumn("_position", inside)
        .join(offsets, bucket)
        .withColumn(name, F.col("_offset") + F.col("_position"))
        .drop(*bucket, "_key", "_position", "_offset")
    )


def global_rank(df: DataFrame, key: Column, name: str = "rank", rows: int | None = None) -> DataFrame:
    """Number all rows 1, 2, … in hash order, without a single-task sort.

    Rows are ranked inside key-prefix buckets, which a hash keeps equally full,
    and each bucket's offset comes from the bucket counts (at most 65,536 rows).
    """
    digits = bucket_digits(df.count() if rows is None else rows)
    return _numbered(df, key, [], digits, name, bounded=True)


def level_rank(df: DataFrame, key: Column, by: Column, name: str = "rank", rows: int | None = None) -> DataFrame:
    """Number rows 1, 2, … within each level, for any number and size of levels.

    Levels are cut into hash buckets as well, as many as all rows in one level would
    need, so one that holds a third of them is spread like the others.
    """
    digits = bucket_digits(df.count() if rows is None else rows)
    return _numbered(df, key, [by.cast("string")], digits, name, bounded=False)


def value_rank(df: DataFrame, value: Column, name: str = "rank") -> DataFrame:
    """Number rows 1, 2, … in the order of a hash that equal rows share.

    Which of the equal rows gets which number depends on the partitions; the numbers of
    a value do not. Distinct values are summed up in hash buckets, and equal rows, which
    may be a third of all, are numbered in buckets of their own.
    """
    # Stored before they are counted: both branches below must see the same numbers for equal rows.
    valued = df.withColumn("_value", value).withColumn("_id", F.monotonically_increasing_id())
    valued = store(valued, scratch(df.sparkSession, "valued"))
    counts = valued.groupBy("_value").agg(F.count(F.lit(1)).alias("_n"))
    sizes = counts.agg(F.count(F.lit(1)).alias("values"), F.coalesce(F.sum("_n"), F.lit(0)).alias("rows")).first()
    bucket = F.substring("_value", 1, bucket_digits(sizes["values"]))
    counts = counts.withColumn("_bucket", bucket)
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = counts.groupBy("_bucket").agg(F.sum("_n").alias("_total"))
    totals = totals.select("_bucket", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_bucket").orderBy("_value").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.withColumn("_inside", F.coalesce(F.sum("_n").over(inside), F.lit(0)))
    firsts = firsts.join(F.broadcast(totals), "_bucket").select("_value", (F.col("_offset") + F.col("_inside")).alias("_first"))
    copy = F.md5(F.col("_id").cast("string"))
    numbered = level_rank(valued, copy, F.col("_value"), "_copy", sizes["rows"])
    return numbered.join(firsts, "_value").withColumn(name, F.col("_first") + F.col("_copy")).drop("_value", "_first", "_copy", "_id")
