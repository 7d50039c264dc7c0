"""Around the model calls: prompts out, completions in, enriched rows."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from seedloom import fixed
from seedloom.functions import chat, score
from seedloom.functions.text import fill_template, filled, tagged, text
from seedloom.session import scratch
from seedloom.sources.files import store

FIELDS = {
    column: (stage, tag)
    for stage, (_, _, _, parsers) in fixed.STAGES.items()
    for column, tag in parsers.items()
}

#: Answers or seed rows of one key that a task may hold at once.
MANY = 1000


def stage_requests(rows: DataFrame, key: str = "ex_id") -> DataFrame:
    """One request per row and stage: ``(key, stage, messages, max_tokens, temperature)``.

    The three stages read only seed columns, so they are independent and go out
    in one narrow pass.
    """
    requests = F.array(
        *[
            F.struct(
                F.lit(stage).alias("stage"),
                chat.stage_prompt(stage).alias("messages"),
                F.lit(max_tokens).alias("max_tokens"),
                F.lit(temperature).alias("temperature"),
            )
            for stage, (max_tokens, temperature, _, _) in fixed.STAGES.items()
        ]
    )
    return rows.select(key, F.inline(requests))


def expand_choices(responses: DataFrame, choices: str = "choices") -> DataFrame:
    """One row per answer of a response: ``choice_idx`` and ``content`` replace the array."""
    kept = [name for name in responses.columns if name != choices]
    exploded = responses.select(*kept, F.posexplode(choices).alias("choice_idx", "_choice"))
    return exploded.select(*kept, "choice_idx", F.col("_choice.message.content").alias("content"))


def parse_completions(completions: DataFrame, key: str = "ex_id") -> DataFrame:
    """Completions ``(key, stage, choice_idx, content)`` as one row per key and choice.

    An answer's fields stay together. Answers of one choice number make one row, and
    where a stage has none of that number the key's first answer of that stage stands
    in, as all stages are asked about the same seed row: two upgrades and one trace make
    two rows with that trace. Further answers of the same key, stage and choice (a
    request sent twice) get numbers of their own above those given, so none is lost.

    Answers are shuffled once, by key. Keys with very many of them go another way
    (:func:`_many_answers`), which no task has to hold; they are found by counting keys.
    """
    asked = _asked(completions, key)
    busy = _busy(key, asked)
    if busy is None:
        return _few_answers(asked, key)
    same = F.col(key) == F.col("_busy")
    few = _few_answers(asked.join(busy, same, "left_anti"), key)
    return few.unionByName(_many_answers(asked.join(busy, same, "left_semi"), key))


def _asked(completions: DataFrame, key: str) -> DataFrame:
    """The answers that can belong to a seed row."""
    known = F.col("stage").isin(*fixed.STAGES) & F.col(key).isNotNull()
    return completions.where(known).select(key, "stage", "choice_idx", "content")


def _busy(key: str, *frames: DataFrame) -> DataFrame | None:
    """Keys with more than ``MANY`` rows in one of the frames, as ``_busy``; None where there are none.

    They are fewer than one in ``MANY`` rows and are broadcast: a join by shuffle would bring all rows of
    such a key into one task.
    """
    counted = [
        frame.groupBy(F.col(key).alias("_busy")).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > MANY).select("_busy")
        for frame in frames
    ]
    path = scratch(frames[0].sparkSession, "busy")
    found = store(reduce(DataFrame.unionByName, counted).where(F.col("_busy").isNotNull()).distinct(), path)
    return None if found.isEmpty() else F.broadcast(found)


def _answer(stage: str) -> Column:
    """The fields of an answer, where it is one of this stage."""
    parsers = fixed.STAGES[stage][3]
    return F.when(
        F.col("stage") == stage, F.struct(*[tagged("content", tag).alias(column) for column, tag in parsers.items()])
    ).alias(stage)


def _fields(key: str) -> list[Column]:
    """A row per choice out of its slot's answers and, after underscores, the key's first ones."""
    return [
        F.col(key),
        (F.col("choice_idx") + F.col("_again") * (F.col("_last") + 1)).alias("choice_idx"),
        *[F.coalesce(stage, f"_{stage}")[column].alias(column) for column, (stage, _) in FIELDS.items()],
    ]


def _firsts() -> dict[str, Column]:
    """Over all slots of a key: its last choice, and its first answer of each stage."""
    place = F.struct("choice_idx", "_again")
    firsts = {f"_{stage}": F.min_by(stage, F.when(F.col(stage).isNotNull(), place)) for stage in fixed.STAGES}
    return {"_last": F.max("choice_idx"), **firsts}


def _few_answers(asked: DataFrame, key: str) -> DataFrame:
    """The rows of keys with few answers: whole answers come together by key, and all that follows happens there."""
    slot = (key, "stage", "choice_idx")
    order = Window.partitionBy(*slot).orderBy("content")
    placed = asked.repartition(key).withColumn("_again", F.row_number().over(order) - 1)
    parsed = placed.select(key, "choice_idx", "_again", *[_answer(stage) for stage in fixed.STAGES])
    slots = parsed.groupBy(key, "choice_idx", "_again").agg(*[F.max(stage).alias(stage) for stage in fixed.STAGES])
    of_key = Window.partitionBy(key)
    firsts = {name: made.over(of_key) for name, made in _firsts().items()}
    return slots.withColumns(firsts).select(*_fields(key))


def _many_answers(asked: DataFrame, key: str) -> DataFrame:
    """The same rows for keys with any number of answers: several passes, in none of which a key is hot.

    Tags are read before anything is shuffled, each only in the stage it belongs to, and
    the fields are stored once for the passes that follow. Whole answers travel only where a
    slot (key, stage and choice) is repeated: slots are counted first, without any text.
    """
    stages = list(fixed.STAGES)
    spark, slot = asked.sparkSession, (key, "stage", "choice_idx")
    repeated = asked.groupBy(*slot).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
    repeated = store(repeated.select(*[F.col(name).alias(f"_{name}") for name in slot]), scratch(spark, "repeated"))
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in slot])
    parsed = asked.select(*slot, "content", *[_answer(stage) for stage in stages])
    single = parsed.drop("content").join(repeated, same, "left_anti").withColumn("_again", F.lit(0))
    order = Window.partitionBy(*slot).orderBy("content")
    several = parsed.join(repeated, same, "left_semi").withColumn("_again", F.row_number().over(order) - 1)
    parsed = store(single.unionByName(several.drop("content")).drop("stage"), scratch(spark, "answers"))
    # Maxima of one struct per slot, and minima by (choice, repeat): partial sums go first, so no key is hot.
    slots = parsed.groupBy(key, "choice_idx", "_again").agg(*[F.max(stage).alias(stage) for stage in stages])
    firsts = parsed.groupBy(F.col(key).alias("_of")).agg(*[made.alias(name) for name, made in _firsts().items()])
    # Both sides of the join come through exchanges of their own, which lets it be split.
    firsts = store(firsts, scratch(spark, "first-answers"))
    return slots.join(firsts, F.col(key) == F.col("_of")).select(*_fields(key))


def attach_completions(
    rows: DataFrame, completions: DataFrame, key: str = "ex_id", keep_missing: bool = True
) -> DataFrame:
    """Seed rows with the fields of their completions, one row per choice.

    See :func:`parse_completions` for what makes a choice. Rows without any completion
    stay with empty fields, unless ``keep_missing`` is off. Seed rows and answers meet in one
    shuffle by key; keys with very many of either are joined apart, by an inner join that adaptive
    execution can split, with an anti join for those of them without any completion.
    """
    asked = _asked(completions, key)
    busy = _busy(key, asked, rows)
    few, few_rows = asked, rows
    if busy is not None:
        same = F.col(key) == F.col("_busy")
        few, few_rows = asked.join(busy, same, "left_anti"), rows.join(busy, same, "left_anti")
    found = few_rows.join(_few_answers(few, key), key, "left" if keep_missing else "inner")
    if busy is not None:
        # Both sides of the join come through exchanges of their own, which lets it be split.
        many_rows = store(rows.join(busy, same, "left_semi"), scratch(rows.sparkSession, "busy-rows"))
        fields = _many_answers(asked.join(busy, same, "left_semi"), key)
        # Dealt out to all cores, as a task that reads them is the least that a key is split into.
        fields = fields.repartition(rows.sparkSession.sparkContext.defaultParallelism)
        fields = store(fields, scratch(rows.sparkSession, "choices"))
        found = found.unionByName(many_rows.join(fields, key))
        if keep_missing:
            missing = many_rows.join(fields.select(key).distinct(), key, "left_anti")
            found = found.unionByName(missing, allowMissingColumns=True)
    return found.select(
        *rows.columns,
        F.coalesce("choice_idx", F.lit(0)).alias("choice_idx"),
        *[text(column).alias(column) for column in FIELDS],
    )


def required_fields(rows: DataFrame, fields: tuple[str, ...] = fixed.REQUIRED_FIELDS) -> DataFrame:
    """Rows whose required fields hold more than white space."""
    for name in fields:
        rows = rows.where(filled(name))
    return rows


def score_enriched(
    rows: DataFrame, threshold: float | None = fixed.MIN_SCORE, exact: bool = False
) -> DataFrame:
    """Adds ``quality_score``; scores below the threshold become the reject mark.

    ``exact=True`` rounds halves up in whole numbers and not as doubles do. The
    columns are made in stages, because each stage names those of the one before
    several times.
    """
    trace = "reasoning_trace"
    _, variant, questions, _ = score.score_parts()
    staged = rows.withColumns(
        {
            "_old": F.upper(text("sql")),
            "_new": F.upper(text("upgraded_sql")),
            "_variant": variant,
            "_questions": questions,
            "_long": score.long_enough(trace),
            "_length": F.length(text(trace)),
            "_keywords": score.keyword_count(trace),
            "_steps": score.step_count(trace),
        }
    )
    gain = score.upper_feature_count(F.col("_new")) - score.upper_feature_count(F.col("_old"))
    staged = staged.withColumn("_gain", gain)
    staged = staged.withColumn(
        "_upgrade", score.upgrade_part(score.plausible_sql("upgraded_sql"), F.col("_gain"))
    )
    parts = (F.col("_upgrade"), F.col("_variant"), F.col("_questions"))
    counts = [F.col(name) for name in ("_long", "_length", "_keywords", "_steps")]
    if exact:
        whole = score.weigh_exactly(parts, *counts)
    else:
        whole = score.weigh((*parts, score.trace_points(*counts)))
    scored = staged.withColumn("_score", whole)
    marked = F.col("_score") if threshold is None else score.mark_rejected(F.col("_score"), threshold)
    kept = [name for name in rows.columns if name != "quality_score"]
    return scored.select(*kept, marked.alias("quality_score"))


def dry_run(rows: DataFrame, key: str = "ex_id", n: int = fixed.MOCK_ROWS) -> DataFrame:
    """The first rows by key with mock enrichment columns, to try the next steps; columns there are replaced."""
    made = {
        "upgraded_question": fill_template(fixed.MOCK_QUESTION, question="question"),
        "upgraded_sql": fill_template(fixed.MOCK_SQL, sql="sql"),
    }
    constants = {name: F.lit(value) for name, value in fixed.MOCK_CONSTANTS.items()}
    return rows.orderBy(key).limit(n).withColumns(made | constants)
