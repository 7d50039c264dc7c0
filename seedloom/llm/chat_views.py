"""Multi-party dialogues from everyone's point of view.

For every participant of a conversation the whole dialogue is rendered once more: the
participant speaks as the assistant, the others are users with their names, context roles
(the system) stay what they are. Loss is on what the assistant says and the mark that ends
it, so each view trains one speaker.

A rendered dialogue comes as its segments, one row per turn: the text, where it starts in
the dialogue and which part bears loss, in characters. So a conversation of any length is
never gathered. Starts are running sums in two levels: rows are dealt by ranges of
(conversation, participant, turn), summed inside each range, and the ranges' totals, a
row per range and dialogue, are summed on top. A hot conversation spans many ranges.

Turns are ordered by number, then speaker, then text, nulls first. Repeated rows are turns
of their own. A null text is empty; a null speaker is a user without a name and has a view
like any other; rows without a conversation id form one conversation; one with context
roles only has no view. An empty frame gives none. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seedloom.llm.frames import stored

# --- fixed values of the template ---------------------------------------------
OPEN, CLOSE, END = "<|im_start|>", "<|im_end|>", "\n"
# ------------------------------------------------------------------------------
CONTEXT_ROLES = ("system",)


def header(speaker: Column, is_assistant: Column, context_roles: tuple[str, ...]) -> Column:
    user = F.concat(F.lit("user"), F.coalesce(F.concat(F.lit(" name="), speaker), F.lit("")))
    role = F.when(is_assistant, F.lit("assistant")).when(speaker.isin(*context_roles), speaker).otherwise(user)
    return F.concat(F.lit(OPEN), role, F.lit(END))


def views(
    df: DataFrame, *, conversation: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text",
    context_roles: tuple[str, ...] = CONTEXT_ROLES,
) -> DataFrame:
    """``conversation, perspective, turn, speaker, segment, start, length, loss_start, loss_length``.

    ``loss_start`` counts from the dialogue's start and is null where nothing bears loss.
    """
    turns = df.select(
        F.col(conversation).alias("conversation"), F.col(turn).alias("turn"), F.col(speaker).cast("string").alias("speaker"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    in_context = F.coalesce(F.col("speaker").isin(*context_roles), F.lit(False))
    people = turns.where(~in_context).select(
        F.col("conversation").alias("of"), F.col("speaker").alias("perspective")
    ).distinct()
    paired = turns.join(people, F.col("conversation").eqNullSafe(F.col("of"))).drop("of")
    is_assistant = F.col("speaker").eqNullSafe(F.col("perspective"))
    head = header(F.col("speaker"), is_assistant, context_roles)
    rendered = paired.select(
        "conversation", "perspective", "turn", "speaker", "text",
        F.concat(head, "text", F.lit(CLOSE + END)).alias("segment"),
        F.when(is_assistant, F.length(head)).alias("lead"),
    )

    dialogue, order = ["conversation", "perspective"], ["turn", "speaker", "text"]
    dealt = rendered.withColumn("row", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(*dialogue, *order, "row").withColumn("range", F.spark_partition_id())
    dealt = stored(dealt.withColumn("length", F.length("segment").cast("long")), "chat-ranges")

    inside = Window.partitionBy("range", *dialogue).orderBy(*order, "row").rowsBetween(Window.unboundedPreceding, -1)
    across = Window.partitionBy(*dialogue).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("range", *dialogue).agg(F.sum("length").alias("total")).select(
        F.col("range").alias("at"), *[F.col(c).alias(f"of_{c}") for c in dialogue],
        F.coalesce(F.sum("total").over(across), F.lit(0)).alias("before"),
    )
    same = (F.col("range") == F.col("at")) & F.col("conversation").eqNullSafe(F.col("of_conversation"))
    same = same & F.col("perspective").eqNullSafe(F.col("of_perspective"))
    placed = dealt.withColumn("local", F.coalesce(F.sum("length").over(inside), F.lit(0))).join(totals, same)
    start = F.col("before") + F.col("local")
    return placed.select(
        *dialogue, "turn", "speaker", "segment", start.alias("start"), "length",
        (start + F.col("lead")).alias("loss_start"),
        F.when(F.col("lead").isNotNull(), F.length("text") + len(CLOSE)).otherwise(0).cast("long").alias("loss_length"),
    )
