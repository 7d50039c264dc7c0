"""Exact top-k search by term-at-a-time accumulation.

Vectors become sparse rows of whole numbers, floor(scale * x). Every candidate is scored
for every query: rows are dealt into blocks of bounded size, and each pair of a query
block and a candidate block is one group. Inside, the candidates' postings, one list of
(row, weight) per component, are built once; each query scatters its weighted postings
into a dense array of scores, from which the best k are selected. The k best of each block
pair are merged per query over at most as many rows as there are candidate blocks times k.

Blocks follow the rows' running numbers, so copies of one vector spread over all blocks.
Queries are part of the input and every row is a candidate, so the number of scores grows
with both; no filter leaves any out.

Vectors that are null, empty or hold a null or non-finite component take no part, neither
as query nor as candidate, nor do queries with a null id. Vectors of other lengths count
as ending in zeros. Repeated rows are rows of their own: each answers and is found, and a
query's own row alone is left out. Equal scores go by the smaller id, null ids last. Other
columns are not read, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows in a block; 64 components of 8 bytes make 4 MB of candidates.
QUERY_BLOCK, CANDIDATE_BLOCK = 4096, 8192
_BEST = "query_row long, query_id long, row long, id long, score long"
_DENSE = 0.5


def whole_numbers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component as double arithmetic gives it."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))))


def usable(vector: Column) -> Column:
    """Not null, not empty, and every component a finite number."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf"))
    )
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


class Postings:
    """For each component the rows of a block where it is not zero, and their weights."""

    def __init__(self, rows: list[np.ndarray]):
        self.n = len(rows)
        dense = as_matrix(rows)
        self.lists: list[tuple[np.ndarray | None, np.ndarray]] = []
        for column in dense.T:
            used = np.flatnonzero(column)
            full = len(used) > _DENSE * self.n
            self.lists.append((None, np.ascontiguousarray(column)) if full else (used, column[used]))

    def scores(self, query: np.ndarray) -> np.ndarray:
        """Inner products of a query with all rows, one component after the other."""
        total = np.zeros(self.n, dtype=np.int64)
        for term in np.flatnonzero(query[: len(self.lists)]):
            used, weights = self.lists[term]
            if used is None:
                total += query[term] * weights
            else:
                total[used] += query[term] * weights
        return total


def as_matrix(rows: list[np.ndarray]) -> np.ndarray:
    width = max(map(len, rows), default=0)
    dense = np.zeros((len(rows), width), dtype=np.int64)
    for at, row in enumerate(rows):
        dense[at, : len(row)] = row
    return dense


def select(scores: np.ndarray, ids: np.ndarray, tie: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best by score, then id, then ``tie``: a partition first, then a sort of what may be in."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        above = np.flatnonzero(scores > least)
        even = np.flatnonzero(scores == least)
        even = even[np.lexsort((tie[even], ids[even]))[: k - len(above)]]
        places = np.concatenate([above, even])
    else:
        places = np.arange(len(scores))
    return places[np.lexsort((tie[places], ids[places], -scores[places]))][:k]


def _best_of(k: int):
    last = np.iinfo(np.int64).max

    def best(table: pa.Table) -> pa.Table:
        is_query = table.column("is_query").to_numpy(zero_copy_only=False).astype(bool)
        ids = table.column("id").to_pylist()
        rows = table.column("row").to_numpy()
        vectors = [np.asarray(v, dtype=np.int64) for v in table.column("vector").to_pylist()]
        among, asked = np.flatnonzero(~is_query), np.flatnonzero(is_query)
        postings = Postings([vectors[i] for i in among])
        order = np.array([last if ids[i] is None else ids[i] for i in among], dtype=np.int64)
        numbers = rows[among]
        out: list[tuple] = []
        for q in asked if len(among) else ():
            scores = postings.scores(vectors[q])
            places = select(scores, order, numbers, k + 1)
            places = places[numbers[places] != rows[q]][:k]
            out += [(rows[q], ids[q], numbers[p], ids[among[p]], scores[p]) for p in places]
        columns = list(zip(*out)) if out else [()] * 5
        return pa.table({
            name: pa.array([None if v is None else int(v) for v in column], pa.int64())
            for name, column in zip(("query_row", "query_id", "row", "id", "score"), columns)
        })

    return best


def top_k(
    df: DataFrame, is_query: Column, k: int = 5, *, key: str = "vec_id", vector: str = "embedding", scale: int = 256,
    query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k highest inner products of every query row."""
    rows = df.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"),
        F.coalesce(is_query, F.lit(False)).alias("asks"), F.col(vector).alias("vector"),
    ).where(usable(F.col("vector")))
    rows = rows.select("row", "id", "asks", whole_numbers(F.col("vector"), scale).alias("vector"))
    sizes = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("asks").alias("asked")).head()
    candidate_blocks = -(-sizes["n"] // candidate_block) or 1
    query_blocks = -(-sizes["asked"] // query_block) or 1

    def block(n: int) -> Column:
        return F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")

    def all_blocks(n: int) -> Column:
        return F.sequence(F.lit(0), F.lit(n - 1))

    def place(q: Column, c: Column, asks: bool) -> Column:
        return F.struct(q.alias("q"), c.alias("c"), F.lit(asks).alias("is_query"))

    as_candidate = F.transform(all_blocks(query_blocks), lambda q: place(q, block(candidate_blocks), False))
    as_query = F.transform(all_blocks(candidate_blocks), lambda c: place(block(query_blocks), c, True))
    places = F.when(F.col("asks"), F.concat(as_candidate, as_query)).otherwise(as_candidate)
    dealt = rows.withColumn("place", F.explode(places))
    dealt = dealt.select("place.q", "place.c", "place.is_query", "row", "id", "vector")
    best = dealt.groupBy("q", "c").applyInArrow(_best_of(k), _BEST)

    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias("vec_id"), "score")
