"""JSON lines in and out, named tables, splits and reports."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from seedloom.functions.chat import training_text
from seedloom.session import scratch

CORRUPT = "_corrupt"


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(name, T.StringType()) for name in names])


RAW = T.StructType([T.StructField("ex_id", T.LongType())]).add(
    "sql_prompt", "string"
).add("sql_context", "string").add("sql", "string").add("sql_explanation", "string").add(
    "domain", "string"
).add("sql_complexity", "string").add("sql_task_type", "string")

SEED = T.StructType(
    [T.StructField("ex_id", T.LongType())]
    + _strings(
        "question", "schema", "sql", "explanation", "domain", "complexity", "task_type", "source", "split"
    ).fields
)

ENRICHED = T.StructType(
    SEED.fields
    + [T.StructField("choice_idx", T.IntegerType())]
    + _strings(
        "upgraded_question", "upgraded_sql", "upgraded_complexity",
        "variant_schema", "variant_question", "variant_sql", "reasoning_trace",
    ).fields
    + [T.StructField("quality_score", T.DoubleType())]
)

EXAMPLE = T.StructType(
    _strings("example_id", "question", "schema", "sql", "thinking", "complexity", "domain", "source").fields
    + [T.StructField("quality_score", T.DoubleType())]
)

MESSAGES = T.ArrayType(_strings("role", "content"))
META = T.StructType(
    _strings("complexity", "domain", "source").fields + [T.StructField("has_thinking", T.BooleanType())]
)
CHAT = T.StructType([T.StructField("messages", MESSAGES), T.StructField("_meta", META)])


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One row per line; blank lines give none, and a bad line fails the query."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl_lenient(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The same, but a bad line becomes a row with its text in ``_corrupt``."""
    wide = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    return (
        spark.read.schema(wide)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> None:
    """A folder of JSON lines files, null fields written out.

    Examples in chat form repeat their instructions in every line: ``compression="gzip"`` leaves a small
    part of them. The readers here see it by the files' names; one task then reads a file.
    """
    df.write.mode(mode).option("ignoreNullFields", "false").option("compression", compression).json(path)


def load_table(spark: SparkSession, path: str, split: str | None = None, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet or JSON lines table, by file name, narrowed to one split if asked."""
    if path.rstrip("/").endswith((".json", ".jsonl")):
        df = read_jsonl(spark, path, schema) if schema else spark.read.json(path)
    else:
        df = spark.read.parquet(path)
    return df if split is None else df.where(F.col("split") == split)


def small_table(spark: SparkSession, rows: list[tuple], names: tuple[str, ...]) -> DataFrame:
    """A few literal rows as a frame, without a Python worker."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


def store(df: DataFrame, path: str) -> DataFrame:
    """The rows as a Parquet table at ``path``, read back: cuts the lineage and survives executors.

    Compressed with ``zstd``: stored texts take about half of what Spark's default leaves.
    """
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store_by_key(df: DataFrame, key: str, buckets: int, name: str = "by_key") -> DataFrame:
    """The rows as an external table in the scratch folder, in ``buckets`` files by key and sorted by it.

    Joins and groupings by ``key`` of tables with as many buckets then need no exchange. One
    bucket should hold what a task can sort: a hundred megabytes or a few.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    table = path.rsplit("/", 1)[1].replace("-", "_")
    parts = df.repartition(buckets, key)
    parts.write.option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return spark.table(table)


def with_positions(df: DataFrame, keep: Column | None = None) -> DataFrame:
    """The rows of a file read with ``position``, their place from 0 on in the files' order.

    Files are ordered by folder, part number and name, rows as they stand in them; with ``keep``
    only rows that fulfil it count and stay. Rows are numbered inside the piece of a file that one
    task reads, and pieces by running sums over their row counts, so no task sees all rows. The rows
    are stored once, as a second read might cut the files otherwise.
    """
    placed = df.select(
        "*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
    )
    placed = placed.where(keep) if keep is not None else placed
    placed = store(placed.withColumn("_id", F.monotonically_increasing_id()), scratch(df.sparkSession, "placed"))
    pieces = placed.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_id").alias("_least"))
    number = F.regexp_extract("_file", r"part-([0-9]+)[^/]*$", 1).try_cast("long")
    order = Window.orderBy(F.regexp_extract("_file", "^(.*)/", 1), number, "_file", "_block")
    before = F.coalesce(F.sum("_n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    pieces = pieces.select("_file", "_block", (before - F.col("_least")).alias("_shift"))
    numbered = placed.join(pieces, ["_file", "_block"])
    return numbered.select(*df.columns, (F.col("_id") + F.col("_shift")).alias("position"))


_TESTS = T.StructType(EXAMPLE.fields + [T.StructField("messages", MESSAGES)])


def read_tests(spark: SparkSession, path: str) -> DataFrame:
    """Test examples; rows that are in chat form already are left out."""
    return read_jsonl(spark, path, _TESTS).where(F.col("messages").isNull()).drop("messages")


def read_tests_in_order(spark: SparkSession, path: str) -> DataFrame:
    """The same with each test's ``position`` among those that stay."""
    return with_positions(read_jsonl(spark, path, _TESTS), F.col("messages").isNull()).drop("messages")


def read_training_text(spark: SparkSession, chat_path: str, raw_path: str) -> DataFrame:
    """``text`` of the chat file, or of the raw file where there is no chat file."""
    schema = T.StructType(CHAT.fields + _strings("question", "schema", "sql").fields)
    for path in (chat_path, raw_path):
        try:
            return read_jsonl(spark, path, schema).select(training_text().alias("text"))
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"neither {chat_path} nor {raw_path} exists")


def write_splits(df: DataFrame, path: str, mode: str = "overwrite", compression: str = "none") -> None:
    """JSON lines with one folder per split; ``compression`` as in :func:`write_jsonl`."""
    writer = df.write.mode(mode).option("ignoreNullFields", "false").option("compression", compression)
    writer.partitionBy("split").json(path)


def read_split(spark: SparkSession, path: str, split: str, schema: T.StructType = EXAMPLE) -> DataFrame:
    """One split of :func:`write_splits`; an absent split is an empty frame."""
    wide = T.StructType(schema.fields + [T.StructField("split", T.StringType())])
    return read_jsonl(spark, path, wide).where(F.col("split") == split).drop("split")


def write_report(report: DataFrame, path: str) -> None:
    """A small report as JSON; the per-example table is a sink of its own."""
    write_jsonl(report, path)
