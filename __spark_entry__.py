
from __future__ import annotations

import functools
import importlib
import os
import sys
from collections.abc import Callable
from types import ModuleType

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import oracles  # noqa: E402
from seedloom import fixed  # noqa: E402
from seedloom.functions import chat, score, text  # noqa: E402
from seedloom.functions.keys import order_key  # noqa: E402
from seedloom.functions.sql_names import register_sql_functions  # noqa: E402
from seedloom.operators import (  # noqa: E402
    compare,
    enrich,
    examples,
    prepare,
    ranking,
    reports,
    responses,
    sampling,
)
from seedloom.plans import blocks, steps  # noqa: E402
from seedloom.session import scratch  # noqa: E402
from seedloom.sources import files  # noqa: E402
from seedloom.streaming.answers import first_deliveries, join_answers  # noqa: E402
from seedloom.streaming.batches import dealt, file_stream, run_batches, write_batches  # noqa: E402
from workload import is_stored, passing, stored_frame, stored_path, table  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}


def query(make: Query) -> Query:
    _QUERIES[make.__name__] = make
    return make


def entry(spark: SparkSession) -> DataFrame:
    """Seed rows kept by the quality filter, per difficulty level."""
    return seed_level_report(spark, "/root/testdata/sf0.001")


def _optional(name: str) -> ModuleType | None:
    """A module of the optional subpackage ``llm``; None only where the module itself is absent."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as absent:
        if absent.name not in (name, "seedloom.llm"):
            raise
        return None


_llm = _optional("seedloom.llm.queries")
_pipeline = _optional("corpus_pipeline") if _llm else None


def core_queries() -> dict[str, Query]:
    """The queries without those of the optional subpackage."""
    return dict(_QUERIES)


def _with_modules(make: Query) -> Query:
    """The query in a session whose Python workers find this folder's modules, wherever they were started."""

    @functools.wraps(make)
    def run(spark: SparkSession, sf: str) -> DataFrame:
        here, environment = os.path.dirname(os.path.abspath(__file__)), spark.sparkContext.environment
        known = environment.get("PYTHONPATH", "").split(os.pathsep)
        if here not in known:
            environment["PYTHONPATH"] = os.pathsep.join([here, *filter(None, known)])
        return make(spark, sf)

    return run


def queries() -> dict[str, Query]:
    more = dict(_llm.QUERIES) if _llm else {}
    if _pipeline:
        more["pipeline"] = _pipeline.run
    return core_queries() | {name: _with_modules(make) for name, make in more.items()}


def oracle_sql() -> dict[str, str]:
    more = dict(_llm.SQL) if _llm else {}
    if _pipeline and _pipeline.ORACLE_SQL:
        more["pipeline"] = _pipeline.ORACLE_SQL
    return oracles.build() | more


# --- seed rows ---------------------------------------------------------------


def _good_seed(spark: SparkSession, sf: str) -> DataFrame:
    return prepare.normalize_seed(prepare.seed_filter(table(spark, sf, "raw_examples")))


@query
def seed_quality_filter(spark, sf):
    return prepare.seed_filter(table(spark, sf, "raw_examples"))


@query
def seed_normalize(spark, sf):
    return prepare.normalize_seed(table(spark, sf, "raw_examples"))


@query
def seed_kept_ratio(spark, sf):
    return reports.kept_ratio(table(spark, sf, "raw_examples"), prepare.seed_quality())


@query
def seed_kept_ratio_written(spark, sf):
    """The same counts, made while the good rows are stored."""
    seen = reports.watched(table(spark, sf, "raw_examples"), **reports.kept_counts(prepare.seed_quality()))
    files.store(prepare.normalize_seed(prepare.seed_filter(seen.rows)), scratch(spark, "good-seed"))
    return reports.with_ratio(seen.report())


@query
def seed_level_report(spark, sf):
    return reports.level_report(_good_seed(spark, sf))


@query
def doc_length_filter(spark, sf):
    kept = prepare.seed_filter(
        table(spark, sf, "documents"),
        sql="text", context="text", prompt="source", sql_length=(200, 5000), max_context=5000,
        min_prompt=4, context_mark="THE ", bad_words=("tion ", "###"),
    )
    return kept.select("doc_id", "lang", "n_chars")


# --- scores ------------------------------------------------------------------


@query
def sql_feature_count(spark, sf):
    return table(spark, sf, "enriched").select(
        "ex_id",
        score.feature_count("sql").alias("gold_features"),
        score.feature_count("upgraded_sql").alias("upgraded_features"),
    )


@query
def sql_plausible(spark, sf):
    return table(spark, sf, "enriched").select(
        "ex_id",
        score.plausible_sql("upgraded_sql").alias("upgraded_ok"),
        score.plausible_sql("variant_sql").alias("variant_ok"),
    )


@query
def trace_score(spark, sf):
    return table(spark, sf, "enriched").select(
        "ex_id", score.trace_score("reasoning_trace").alias("trace_score")
    )


@query
def trace_score_documents(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        score.keyword_count("text").alias("keywords"),
        score.step_count("text").alias("steps"),
        score.trace_score("text").alias("trace_score"),
    )


@query
def quality_score(spark, sf):
    return enrich.score_enriched(table(spark, sf, "enriched"), threshold=None).select("ex_id", "quality_score")


@query
def quality_score_exact(spark, sf):
    scored = enrich.score_enriched(table(spark, sf, "enriched"), threshold=None, exact=True)
    return scored.select("ex_id", "quality_score")


@query
def quality_mark(spark, sf):
    return enrich.score_enriched(table(spark, sf, "enriched")).select("ex_id", "quality_score")


@query
def quality_mark_drop(spark, sf):
    marked = enrich.score_enriched(table(spark, sf, "enriched"))
    return examples.expand_enriched(marked).select("example_id", "source", "quality_score")


@query
def stream_score(spark, sf):
    """The marked scores again, with the table read as a stream of files."""
    schema = table(spark, sf, "enriched").schema
    rows = file_stream(
        spark, stored_path(spark, sf, "enriched"), schema, files_per_batch=4, file_format="parquet"
    )
    out = scratch(spark, "stream-score")
    run_batches(
        rows,
        lambda batch: enrich.score_enriched(dealt(batch)).select("ex_id", "quality_score"),
        out, scratch(spark, "stream-score-checkpoint"), pause_seconds=None,
    ).awaitTermination()
    return spark.read.schema("ex_id long, quality_score double").parquet(out)


# --- samples and splits ------------------------------------------------------


@query
def sample_exact(spark, sf):
    return sampling.exact_sample(table(spark, sf, "documents"), 400, "doc_id").select("doc_id", "lang")


@query
def unsampled_rows(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id", "text", "lang")
    drawn = sampling.exact_sample(documents, 400, "doc_id")
    return sampling.exclude(documents, drawn, "doc_id", by="value").select("doc_id", "lang")


@query
def stratified_docs(spark, sf):
    documents = table(spark, sf, "documents").withColumnRenamed("doc_id", "ex_id")
    return sampling.stratified_sample(documents, 400, "lang").select("ex_id", "lang")


@query
def stratified_topup(spark, sf):
    return sampling.stratified_sample(_good_seed(spark, sf), 9000)


@query
def stratified_topup_by_key(spark, sf):
    return sampling.stratified_sample(_good_seed(spark, sf), 9000, top_up_by="key").select("ex_id", "complexity")


@query
def stratified_many_levels(spark, sf):
    """More levels than pass through the driver: one per customer of the orders."""
    cases = table(spark, sf, "cases").select("ex_id", "cust")
    return sampling.stratified_sample(cases, 5000, "cust", top_up_by="key")


@query
def keyless_sample(spark, sf):
    """An exact sample of rows that have no key, most of them equal to others."""
    rows = table(spark, sf, "labels").select("quality", "toxic")
    return sampling.exact_sample(prepare.with_row_keys(rows, scratch(spark, "keyed")), 100)


@query
def stratum_report(spark, sf):
    return reports.stratum_report(table(spark, sf, "documents"), 400, "lang")


@query
def global_split(spark, sf):
    return sampling.split_rows(table(spark, sf, "documents"), "doc_id").select("doc_id", "split")


@query
def split_by_group(spark, sf):
    return sampling.split_groups(table(spark, sf, "conversations"), "conv_id").select("conv_id", "turn", "split")


@query
def shuffle_rank(spark, sf):
    documents = table(spark, sf, "documents").select("doc_id")
    return ranking.global_rank(documents, order_key("doc_id", 42, "shuffle"))


@query
def batch_assign(spark, sf):
    return sampling.assign_batches(table(spark, sf, "documents").select("doc_id"), key="doc_id")


# --- examples and mixing -----------------------------------------------------


@query
def expand_examples(spark, sf):
    return examples.expand_enriched(table(spark, sf, "enriched"))


@query
def seed_examples(spark, sf):
    return examples.seed_examples(_good_seed(spark, sf))


@query
def mix_ratio(spark, sf):
    return sampling.mix(seed_examples(spark, sf), expand_examples(spark, sf))


def _mixed(spark: SparkSession, sf: str) -> DataFrame:
    """The mix with its splits, of tables with whole texts inside that need not be stored for it."""
    good = prepare.normalize_seed(prepare.seed_filter(passing(spark, sf, "raw_examples")))
    expanded = examples.expand_enriched(passing(spark, sf, "enriched"))
    drawn = sampling.draw_mix(examples.seed_examples(good), expanded)
    return sampling.split_rows(drawn.rows, keys=drawn.keys)


def _labelled(spark: SparkSession, sf: str) -> DataFrame:
    """The mix with its splits, stored once: the reports and files below start from it."""
    return stored_frame(spark, sf, "labelled", lambda: _mixed(spark, sf))


def _train(spark: SparkSession, sf: str) -> DataFrame:
    return _labelled(spark, sf).where(F.col("split") == "train")


@query
def mix_split(spark, sf):
    drawn = sampling.draw_mix(seed_examples(spark, sf), expand_examples(spark, sf))
    return sampling.split_rows(drawn.rows, keys=drawn.keys).select("example_id", "source", "split")


@query
def mix_split_sizes(spark, sf):
    return reports.split_sizes(_labelled(spark, sf))


@query
def mix_source_shares(spark, sf):
    return reports.source_shares(_train(spark, sf))


@query
def mix_complexity_bars(spark, sf):
    return reports.complexity_bars(_train(spark, sf))


@query
def thinking_share(spark, sf):
    """Read where the mix is stored, else counted on the way: of its texts only the reasoning is made."""
    stored = is_stored(spark, sf, "labelled")
    train = _train(spark, sf) if stored else _mixed(spark, sf).where(F.col("split") == "train")
    return reports.thinking_share(train)


# --- enrichment --------------------------------------------------------------


def _messages(rows: DataFrame, key: str, messages) -> DataFrame:
    exploded = rows.select(key, F.posexplode(messages).alias("pos", "message"))
    return exploded.select(key, "pos", "message.role", "message.content")


def _prompts(stage: str) -> Query:
    def render(spark, sf):
        return _messages(table(spark, sf, "doc_rows"), "ex_id", chat.stage_prompt(stage))

    return render


for _stage in fixed.STAGES:
    _QUERIES[f"render_prompts_{_stage}"] = _prompts(_stage)


@query
def stage_requests(spark, sf):
    return enrich.stage_requests(table(spark, sf, "doc_rows")).select(
        "ex_id", "stage", "max_tokens", "temperature", F.col("messages")[1]["content"].alias("user_text")
    )


@query
def stream_requests(spark, sf):
    """The prompts again, seed rows coming in as a stream of files and going out as JSON lines."""
    schema = table(spark, sf, "doc_rows").schema
    rows = file_stream(
        spark, stored_path(spark, sf, "doc_rows"), schema, files_per_batch=4, file_format="parquet"
    )
    out = scratch(spark, "stream-requests")
    run_batches(
        rows, enrich.stage_requests, out, scratch(spark, "stream-requests-checkpoint"),
        pause_seconds=None, file_format="json",
    ).awaitTermination()
    requests = files.read_jsonl(spark, out, enrich.stage_requests(table(spark, sf, "doc_rows")).schema)
    return requests.select(
        "ex_id", "stage", "max_tokens", "temperature", F.col("messages")[1]["content"].alias("user_text")
    )


@query
def stream_batches(spark, sf):
    """Rows that come in batches of 20, with the number of rows in each row's batch."""
    items = table(spark, sf, "benchmark")
    path, out = scratch(spark, "batches"), scratch(spark, "stream-batches")
    write_batches(items, path, key="item_id")
    rows = file_stream(spark, path, T.StructType([*items.schema.fields, T.StructField("batch_idx", T.LongType())]))
    run_batches(rows, lambda batch: batch, out, scratch(spark, "batches-checkpoint"), pause_seconds=None).awaitTermination()
    done = spark.read.schema(rows.schema).parquet(out)
    sizes = done.groupBy("batch_idx").agg(F.count(F.lit(1)).alias("n"))
    return done.join(sizes, "batch_idx").select("item_id", "batch_idx", "n")


@query
def stream_answers(spark, sf):
    """Requests with the answers that come while they go out: two stretches of time, the query started again for each."""
    asked, came = table(spark, sf, "asked"), passing(spark, sf, "came")
    ends = asked.agg(F.min("sent_at").alias("first"), F.max("sent_at").alias("last")).first()
    middle = ends["first"] + (ends["last"] - ends["first"]) / 2
    folders = [scratch(spark, name) for name in ("asked-stream", "came-stream")]
    out, checkpoint = scratch(spark, "stream-answers"), scratch(spark, "stream-answers-checkpoint")
    # Rows far in the future close the stretch before: what has no answer by then gets none.
    later = F.lit(ends["last"]) + F.expr("INTERVAL 1 YEAR")
    closing = asked.limit(1).select(F.lit(None).cast("long").alias("ex_id"), F.lit("end").alias("stage"), later.alias("sent_at"))
    closed = closing.select("ex_id", "stage", F.lit(0).alias("choice_idx"), F.lit("").alias("content"), F.col("sent_at").alias("came_at"))
    for low, high in ((ends["first"], middle), (middle, None), (None, None)):
        parts = [(asked, "sent_at", closing), (came, "came_at", closed)]
        for (rows, time, last), folder in zip(parts, folders):
            part = rows.where((F.col(time) >= low) & (F.col(time) < high if high else F.lit(True))) if low else last
            part.write.mode("append").option("compression", "zstd").parquet(folder)
        streams = [file_stream(spark, folder, rows.schema, 1000, "parquet") for (rows, _, _), folder in zip(parts, folders)]
        run_batches(
            streams[0], lambda requests: join_answers(requests, first_deliveries(streams[1])), out, checkpoint, pause_seconds=None,  # noqa: B023
        ).awaitTermination()
    schema = "ex_id long, stage string, sent_at timestamp, choice_idx int, content string, came_at timestamp"
    waited = (F.unix_timestamp("came_at") - F.unix_timestamp("sent_at")).alias("waited")
    return spark.read.schema(schema).parquet(out).where(F.col("ex_id").isNotNull()).select("ex_id", "stage", "choice_idx", "content", waited)


@query
def contract_check(spark, sf):
    rows = prepare.check_keys(prepare.check_contract(table(spark, sf, "doc_rows")))
    return rows.groupBy("complexity").agg(
        F.count(F.lit(1)).alias("n")
    )


def _completions(spark: SparkSession, sf: str) -> DataFrame:
    """Completions out of response objects, as a chat service returns them."""

    def choice(column: str):
        return F.struct(F.struct(F.lit("assistant").alias("role"), F.col(column).alias("content")).alias("message"))

    answers = table(spark, sf, "answers")
    choices = F.filter(
        F.array(choice("first_answer"), choice("second_answer")),
        lambda c: c["message"]["content"].isNotNull(),
    )
    return enrich.expand_choices(answers.select("ex_id", "stage", choices.alias("choices")))


@query
def explode_choices(spark, sf):
    return _completions(spark, sf)


@query
def raw_responses(spark, sf):
    """Answers out of response bodies as text, some in batch result lines, some in parts."""
    return responses.read_responses(table(spark, sf, "bodies")).completions


@query
def raw_response_errors(spark, sf):
    return responses.read_responses(table(spark, sf, "bodies"), cut_off=False).errors


@query
def attach_raw_responses(spark, sf):
    answers = responses.read_responses(table(spark, sf, "bodies")).completions
    return enrich.attach_completions(table(spark, sf, "doc_rows"), answers)


@query
def parse_tags(spark, sf):
    parsed = enrich.parse_completions(_completions(spark, sf))
    return parsed.select("ex_id", "choice_idx", *[text.text(c).alias(c) for c in enrich.FIELDS])


@query
def parse_tags_all(spark, sf):
    return _completions(spark, sf).select(
        "ex_id", "stage", "choice_idx", F.posexplode(text.tagged_all("content", "SQL")).alias("pos", "sql")
    )


@query
def attach_completions(spark, sf):
    return enrich.attach_completions(table(spark, sf, "doc_rows"), _completions(spark, sf))


@query
def required_fields(spark, sf):
    attached = enrich.attach_completions(
        table(spark, sf, "doc_rows"), _completions(spark, sf), keep_missing=False
    )
    return enrich.required_fields(attached)


@query
def enrichment_chain(spark, sf):
    parts = steps.answer_chain(_completions(spark, sf), score=True)
    scored = steps.chain(table(spark, sf, "doc_rows"), *parts)
    row = F.concat_ws("/", F.col("ex_id").cast("string"), F.col("choice_idx").cast("string"))
    return scored.select(row.alias("ex_id"), "quality_score")


#: The enrichment after its answers, as data; listed out of order.
DECLARED = [
    {"kind": "score", "inputs": ["upgraded_sql", "variant_sql", "reasoning_trace"], "outputs": ["quality_score"], "after": ["required"]},
    {"kind": "required", "name": "required", "inputs": list(fixed.REQUIRED_FIELDS)},
    {
        "kind": "answers", "name": "answers", "inputs": list(fixed.REQUIRED_COLUMNS), "outputs": ["choice_idx", *enrich.FIELDS],
        "params": {"completions": "$completions", "keep_missing": False},
    },
]
KINDS = {"answers": enrich.attach_completions, "required": enrich.required_fields, "score": enrich.score_enriched}


@query
def declared_chain(spark, sf):
    """The enrichment chain from its declaration."""
    declared = blocks.declared(DECLARED, KINDS, completions=_completions(spark, sf))
    scored = blocks.run_blocks(table(spark, sf, "doc_rows"), declared)
    row = F.concat_ws("/", F.col("ex_id").cast("string"), F.col("choice_idx").cast("string"))
    return scored.select(row.alias("ex_id"), "quality_score")


@query
def generation_summary(spark, sf):
    return reports.generation_summary(required_fields(spark, sf))


@query
def dry_run_mock(spark, sf):
    return enrich.dry_run(table(spark, sf, "doc_rows"))


# --- chat rows ---------------------------------------------------------------


@query
def chat_rows(spark, sf):
    rows = examples.chat_rows(expand_examples(spark, sf), keep=("example_id",))
    return _messages(rows, "example_id", "messages")


@query
def chat_meta(spark, sf):
    return examples.chat_rows(expand_examples(spark, sf), keep=("example_id",)).select("example_id", "_meta.*")


@query
def format_stats(spark, sf):
    return reports.format_stats(examples.flag_chat(expand_examples(spark, sf)))


@query
def format_stats_written(spark, sf):
    """The same counts, made while the chat rows are written."""
    return steps.format_examples(expand_examples(spark, sf), scratch(spark, "chat"), compression="gzip").stats


@query
def training_text(spark, sf):
    rows = examples.valid_messages(expand_examples(spark, sf))
    return rows.select("example_id", chat.training_text().alias("text"))


@query
def inference_messages(spark, sf):
    return _messages(table(spark, sf, "doc_rows"), "ex_id", chat.inference_messages())


@query
def inference_text(spark, sf):
    return table(spark, sf, "doc_rows").select(
        "ex_id", chat.messages_text(chat.inference_messages(), opening=fixed.TURN_OPENING).alias("text")
    )


@query
def serve_requests(spark, sf):
    return table(spark, sf, "doc_rows").select("ex_id", chat.serve_request().alias("request"))


@query
def conversation_turn_text(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", chat.turn_text("role", "text").alias("text")
    )


# --- evaluation --------------------------------------------------------------


@query
def drop_reasoning(spark, sf):
    return table(spark, sf, "predictions").select("ex_id", text.drop_reasoning("pred_sql").alias("pred_sql"))


@query
def canonical_sql(spark, sf):
    return table(spark, sf, "predictions").select("ex_id", text.canonical_sql("pred_sql").alias("pred_sql"))


@query
def canonical_documents(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.canonical_sql("text").alias("text"))


def _aligned(spark: SparkSession, sf: str) -> DataFrame:
    cases = table(spark, sf, "cases")
    tests = cases.select("ex_id", "question", "schema", F.col("gold").alias("sql"), "complexity")
    return compare.align_predictions(tests, table(spark, sf, "predictions"))


@query
def align_predictions(spark, sf):
    return _aligned(spark, sf)


@query
def exact_match(spark, sf):
    return compare.with_exact_match(_aligned(spark, sf)).select("ex_id", "exact_match")


@query
def align_by_position(spark, sf):
    """Tests and predictions as JSON lines without keys, in the order of their orders."""
    found = table(spark, sf, "predictions")
    cases = table(spark, sf, "cases").join(found.select("ex_id"), "ex_id", "left_semi")
    tests = cases.select("ex_id", "question", "schema", F.col("gold").alias("sql"), "complexity")
    parts = []
    for name, rows in (("tests", tests), ("predictions", found)):
        path = scratch(spark, f"{name}-in-order")
        files.write_jsonl(rows.orderBy("ex_id").drop("ex_id"), path)
        parts.append(files.with_positions(files.read_jsonl(spark, path, rows.drop("ex_id").schema)))
    return compare.align_by_position(*parts)


@query
def align_stored_by_key(spark, sf):
    """The alignment of tables that lie in buckets by key: no exchange."""
    cases = table(spark, sf, "cases")
    tests = cases.select("ex_id", "question", "schema", F.col("gold").alias("sql"), "complexity")
    stored = [files.store_by_key(rows, "ex_id", 8, name) for name, rows in (("tests", tests), ("predictions", table(spark, sf, "predictions")))]
    return compare.align_predictions(*stored)


@query
def ddl_statements(spark, sf):
    return table(spark, sf, "runs").select(
        "ex_id", F.posexplode(text.ddl_statements("schema")).alias("pos", "statement")
    )


def _executions(spark: SparkSession, sf: str) -> DataFrame:
    return compare.executions_from_tables(table(spark, sf, "result_rows"), table(spark, sf, "run_status"))


@query
def result_match(spark, sf):
    return compare.match_results(_executions(spark, sf))


@query
def result_match_nonempty(spark, sf):
    return compare.match_results(_executions(spark, sf), empty_is_match=False)


@query
def result_match_fingerprints(spark, sf):
    return compare.match_fingerprints(_executions(spark, sf))


@query
def result_match_verified(spark, sf):
    return compare.match_fingerprints(_executions(spark, sf), empty_is_match=False, verify=True)


@query
def bag_difference(spark, sf):
    rows = table(spark, sf, "result_rows")
    return compare.bag_difference(
        rows.where(F.col("side") == "pred").drop("side"), rows.where(F.col("side") == "gold").drop("side")
    )


@query
def eval_report(spark, sf):
    aligned = compare.with_exact_match(_aligned(spark, sf))
    return reports.eval_report(compare.with_execution_match(aligned, result_match(spark, sf)))


@query
def eval_ordered(spark, sf):
    return reports.ordered_report(eval_report(spark, sf))


# --- files -------------------------------------------------------------------


@query
def jsonl_roundtrip(spark, sf):
    pages = table(spark, sf, "pages")
    path = scratch(spark, "pages")
    files.write_jsonl(pages, path)
    return files.read_jsonl(spark, path, pages.schema)


@query
def jsonl_lenient_stats(spark, sf):
    """Documents as JSON lines, the Spanish ones cut off before the closing brace."""
    whole = F.to_json(
        F.struct(
            F.col("text").alias("question"), F.col("text").alias("schema"),
            F.col("text").alias("sql"), F.col("text").alias("thinking"),
        )
    )
    line = F.when(F.col("lang") == "es", F.rtrim(whole, F.lit("}"))).otherwise(whole)
    path = scratch(spark, "lenient")
    table(spark, sf, "documents").select(line.alias("value")).write.text(path)
    rows = files.read_jsonl_lenient(spark, path, files.EXAMPLE)
    return reports.format_stats(examples.flag_chat(rows), files.CORRUPT)


@query
def split_files(spark, sf):
    path = scratch(spark, "splits")
    files.write_splits(sampling.shuffled(_labelled(spark, sf), "example_id"), path, compression="gzip")
    return files.read_split(spark, path, "test")


@query
def raw_tests_only(spark, sf):
    """English documents in chat form and the others raw, in one folder of JSON lines."""
    documents = table(spark, sf, "documents")
    messages = F.when(F.col("lang") == "en", F.array(chat.message("user", F.col("text"))))
    path = scratch(spark, "tests")
    files.write_jsonl(
        documents.select(
            F.concat(F.lit("doc/"), "doc_id").alias("example_id"), F.col("text").alias("question"),
            messages.alias("messages"),
        ),
        path,
    )
    return files.read_tests(spark, path).select("example_id", "question")


@query
def training_file_text(spark, sf):
    path = scratch(spark, "train-chat")
    files.write_jsonl(examples.chat_rows(expand_examples(spark, sf)), path, compression="gzip")
    return files.read_training_text(spark, path, scratch(spark, "train-raw"))


@query
def report_file(spark, sf):
    path = scratch(spark, "report")
    report = eval_report(spark, sf)
    files.write_report(report, path)
    return files.read_jsonl(spark, path, report.schema)


@query
def named_split(spark, sf):
    path = scratch(spark, "turns")
    table(spark, sf, "conversations").withColumnRenamed("role", "split").write.partitionBy("split").parquet(path)
    return files.load_table(spark, path, split="assistant").drop("split")


# --- SQL names ---------------------------------------------------------------


@query
def sql_functions(spark, sf):
    register_sql_functions(spark)
    return spark.sql(
        """SELECT ex_id, canonical_sql(upgraded_sql) AS upgraded, sql_feature_count(upgraded_sql) AS features,
                  plausible_sql(upgraded_sql) AS plausible, trace_keywords(reasoning_trace) AS keywords,
                  trace_steps(reasoning_trace) AS steps, py_strip(reasoning_trace) AS trace,
                  trace_score(reasoning_trace) AS trace_score,
                  quality_score(sql, upgraded_sql, variant_sql, upgraded_question, variant_question, reasoning_trace)
                  AS quality_score
           FROM {enriched}""",
        enriched=table(spark, sf, "enriched"),
    )


@query
def sql_training_examples(spark, sf):
    """The expansion as a table function, joined laterally."""
    register_sql_functions(spark)
    return spark.sql(
        """SELECT made.* FROM {enriched} e, LATERAL training_examples(
               string(e.ex_id), e.question, e.schema, e.sql, e.complexity, e.domain, e.reasoning_trace, e.upgraded_question,
               e.upgraded_sql, e.upgraded_complexity, e.variant_schema, e.variant_question, e.variant_sql, e.quality_score) made""",
        enriched=table(spark, sf, "enriched"),
    )


@query
def sql_tagged_texts(spark, sf):
    """All texts of a tag as a table function."""
    register_sql_functions(spark)
    return spark.sql(
        """SELECT c.ex_id, c.stage, c.choice_idx, t.pos, t.body AS sql
           FROM {completions} c, LATERAL tagged_texts(c.content, 'SQL') t""",
        completions=_completions(spark, sf),
    )


@query
def sql_answer_fields(spark, sf):
    """The fields of every answer as rows, by a table function that knows each stage's tags."""
    register_sql_functions(spark)
    return spark.sql(
        """SELECT c.ex_id, c.stage, c.choice_idx, md5(c.content) AS answer, f.field, f.value
           FROM {completions} c, LATERAL answer_fields(c.stage, c.content) f""",
        completions=_completions(spark, sf),
    )
