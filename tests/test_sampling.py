import hashlib
from collections import Counter

import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from seedloom.functions.keys import order_key
from seedloom.operators import ranking, reports, sampling
from seedloom.operators.ranking import KeyOrder


def md5(purpose, key, seed=42):
    return hashlib.md5(f"{seed}|{purpose}|{key}".encode()).hexdigest()


def first_keys(keys, purpose, n):
    return sorted(sorted(keys, key=lambda key: md5(purpose, key))[:n])


@pytest.fixture
def hot(spark):
    """3,000 rows; one level holds a third of them and another has a single row."""
    level = (
        F.when(F.col("ex_id") % 3 == 0, "hot").when(F.col("ex_id") == 1, "lone")
        .otherwise(F.concat(F.lit("l"), (F.col("ex_id") % 7).cast("string")))
    )
    return spark.range(3000).select(F.col("id").alias("ex_id")).withColumn("complexity", level)


@pytest.mark.parametrize("n", [0, 1, 7, 2999, 3000, 5000])
def test_exact_sample_is_the_head_of_the_hash_order(hot, n):
    got = [r[0] for r in rows_of(sampling.exact_sample(hot.select("ex_id"), n))]
    assert got == first_keys(range(3000), "sample", n)


def test_sample_does_not_depend_on_partitions(spark, hot):
    found = set()
    for partitions in (1, 4, 37):
        spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
        spread = hot.repartition(partitions)
        found.add(
            (
                tuple(rows_of(sampling.exact_sample(spread, 100))),
                tuple(rows_of(sampling.stratified_sample(spread, 400, top_up_by="key"))),
                tuple(rows_of(sampling.split_rows(spread, "ex_id"))),
                tuple(rows_of(sampling.assign_batches(spread))),
            )
        )
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert len(found) == 1


@pytest.mark.parametrize("edge", [1, 5, 100])
def test_long_prefixes(hot, monkeypatch, edge):
    monkeypatch.setattr(ranking, "EDGE_ROWS", edge)
    key = order_key("ex_id", 42, "x")
    ordered = sorted(md5("x", k) for k in range(3000))
    order = KeyOrder(hot, key)
    assert order.sizes == {"": 3000}
    ranks = [0, 1, 2, 1500, 2999, 3000]
    assert order.cuts({"": ranks})[""] == [ranking.NONE, *[ordered[r - 1] for r in ranks[1:5]], ranking.ALL]


def levels_of(df):
    return {row.complexity: row["count"] for row in df.groupBy("complexity").count().collect()}


@pytest.mark.parametrize("many_levels", [False, True])
def test_stratified(hot, monkeypatch, many_levels):
    if many_levels:
        monkeypatch.setattr(ranking, "MAX_LEVELS", 2)
    sampled = sampling.stratified_sample(hot, 90, top_up_by="key")
    sizes = levels_of(hot)
    quota = 90 // len(sizes)
    got = levels_of(sampled)
    assert sampled.count() == 90
    assert got["lone"] == 1
    assert all(n >= quota for name, n in got.items() if name != "lone")
    hot_keys = [r[0] for r in hot.where("complexity = 'hot'").select("ex_id").collect()]
    kept = {r[0] for r in sampled.where("complexity = 'hot'").select("ex_id").collect()}
    assert set(first_keys(hot_keys, "level", quota)) <= kept


def test_many_levels_draw_the_same_rows(hot, monkeypatch):
    few = rows_of(sampling.stratified_sample(hot, 400, top_up_by="key"))
    monkeypatch.setattr(ranking, "MAX_LEVELS", 2)
    assert rows_of(sampling.stratified_sample(hot, 400, top_up_by="key")) == few


def test_levels_are_counted_before_they_are_collected(spark):
    """Very many levels over many partitions never reach the driver."""
    df = spark.range(0, 60_000, 1, 48).selectExpr("id AS ex_id", "concat('level ', id) AS complexity")
    with pytest.raises(ranking.TooManyLevels):
        KeyOrder(df, order_key("ex_id", 1, "x"), F.col("complexity"))
    assert sampling.stratified_sample(df, 100, top_up_by="key").count() == 100


@pytest.mark.parametrize("limit", [10, 10**9])
def test_buckets_do_not_change_ranks(hot, monkeypatch, limit):
    monkeypatch.setattr(ranking, "BUCKET_ROWS", limit)
    got = rows_of(ranking.level_rank(hot, order_key("ex_id", 1, "x"), F.col("complexity")).select("complexity", "rank"))
    assert got == [(level, n) for level, rows in sorted(levels_of(hot).items()) for n in range(1, rows + 1)]


def test_broadcast_or_join_draw_the_same_rows(hot, monkeypatch):
    few = rows_of(sampling.stratified_sample(hot, 400))
    monkeypatch.setattr(sampling, "BROADCAST_ROWS", 0)
    assert rows_of(sampling.stratified_sample(hot, 400)) == few


def test_fewer_rows_wanted_than_levels(hot):
    assert sampling.stratified_sample(hot, 4).count() == 4
    assert len(levels_of(sampling.stratified_sample(hot, 4))) == 4


def test_more_rows_wanted_than_there_are(spark):
    df = spark.range(30).selectExpr("id AS ex_id", "cast(id % 2 as string) AS complexity", "id AS value")
    assert sampling.stratified_sample(df, 100).count() == 30


def test_top_up_leaves_out_copies(spark):
    # ten copies of one row and twenty rows of their own; the level quota is met by nine of them
    df = spark.range(30).selectExpr(
        "id AS ex_id", "CASE WHEN id < 10 THEN 'same' ELSE 'own' END AS complexity",
        "CASE WHEN id < 10 THEN 0 ELSE id END AS value",
    )
    by_key = sampling.stratified_sample(df, 29, top_up_by="key")
    by_value = sampling.stratified_sample(df, 29, top_up_by="value")
    assert levels_of(by_key) == {"same": 10, "own": 19}
    assert levels_of(by_value) == {"same": 10, "own": 19}
    small = sampling.stratified_sample(df, 6, top_up_by="value")
    assert levels_of(small) == {"same": 3, "own": 3}
    skewed = df.where("complexity = 'same' OR ex_id < 12")
    got = levels_of(sampling.stratified_sample(skewed, 12, top_up_by="value"))
    assert got == {"same": 6, "own": 2}  # the other copies equal a drawn row
    assert levels_of(sampling.stratified_sample(skewed, 12, top_up_by="key")) == {"same": 10, "own": 2}


def test_null_levels_are_one_level(spark):
    df = spark.range(20).selectExpr("id AS ex_id", "CASE WHEN id < 10 THEN 'a' END AS complexity")
    assert levels_of(sampling.stratified_sample(df, 8)) == {"a": 4, None: 4}


def test_exclude(spark):
    pool = spark.range(10).selectExpr("id AS ex_id", "id % 5 AS value")
    drawn = pool.where("ex_id < 2")
    assert [r[0] for r in rows_of(sampling.exclude(pool, drawn))] == list(range(2, 10))
    assert [r[0] for r in rows_of(sampling.exclude(pool, drawn, by="value").select("ex_id"))] == [2, 3, 4, 7, 8, 9]


def numbered(spark, n, kind):
    return spark.range(n).selectExpr(f"concat('{kind}/', id) AS example_id", f"'{kind}' AS source")


def test_mix_and_split_sizes(spark):
    mixed = sampling.mix(numbered(spark, 2000, "seed"), numbered(spark, 2250, "made"))
    assert Counter(r.source for r in mixed.collect()) == {"seed": 1700, "made": 2250}
    sizes = {r.split: r.n for r in reports.split_sizes(sampling.split_rows(mixed)).collect()}
    assert sizes == {"train": 3555, "eval": 197, "test": 198}


def test_splits_are_not_tied_to_the_draw(spark):
    mixed = sampling.mix(numbered(spark, 4000, "seed"), numbered(spark, 2000, "made"))
    rows = sampling.split_rows(mixed, train_ratio=0.5, eval_ratio=0.25)
    share = rows.where("source = 'seed'").agg(F.avg((F.col("split") == "train").cast("int"))).first()[0]
    assert 0.45 < share < 0.55


def test_mix_without_synthetic_rows(spark):
    assert sampling.mix(numbered(spark, 50, "seed"), numbered(spark, 0, "made")).count() == 50


@pytest.mark.parametrize("n, sizes", [(10, {"train": 9, "test": 1}), (0, {}), (20, {"train": 18, "eval": 1, "test": 1})])
def test_small_splits(spark, n, sizes):
    rows = sampling.split_rows(numbered(spark, n, "seed"))
    assert {r.split: r.n for r in reports.split_sizes(rows).collect() if r.n} == sizes


def test_groups_stay_together(spark):
    df = spark.range(1000).selectExpr("id AS ex_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('g', id % 40) END AS g")
    rows = sampling.split_groups(df, "g")
    assert rows.groupBy("g").agg(F.count_distinct("split").alias("n")).where("n > 1").isEmpty()
    groups = {r.split: r.n for r in rows.groupBy("split").agg(F.count_distinct("g").alias("n")).collect()}
    assert groups == {"train": 36, "eval": 2, "test": 3}


def test_batches(spark):
    sizes = Counter(r.batch_idx for r in sampling.assign_batches(spark.range(750).toDF("ex_id")).collect())
    assert len(sizes) == 38 and sizes[37] == 10 and set(sizes.values()) == {20, 10}


def test_level_rank_is_dense(hot):
    ranked = ranking.level_rank(hot, order_key("ex_id", 1, "r"), F.col("complexity"))
    for _, top, n, distinct in ranked.groupBy("complexity").agg(
        F.max("rank"), F.count("rank"), F.count_distinct("rank")
    ).collect():
        assert top == n == distinct


def test_shuffled_keeps_all_rows(hot):
    rows = [r.ex_id for r in sampling.shuffled(hot).collect()]
    assert rows == sorted(range(3000), key=lambda key: md5("shuffle", key))


def test_draws_are_narrow_filters(hot, spark):
    stored = spark.read.parquet(_written(hot))
    for df in (sampling.exact_sample(stored, 50), sampling.split_rows(stored, "ex_id")):
        assert "Exchange" not in plan_of(df)
    assert "hashpartitioning" not in plan_of(sampling.stratified_sample(stored, 400, top_up_by="key"))
    ranked = plan_of(ranking.global_rank(stored, order_key("ex_id", 1, "r")))
    assert "hashpartitioning(_bucket" in ranked and ranked.count("SinglePartition") == 1  # the bucket counts


def _written(df):
    from seedloom.session import scratch

    path = scratch(df.sparkSession, "hot")
    df.write.parquet(path)
    return path
