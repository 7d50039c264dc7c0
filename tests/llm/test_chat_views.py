"""Dialogues from every participant's point of view against a plain rendering."""

from collections import defaultdict

from seedloom.llm import chat_views

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        talks[conv].append((turn, role, text))
    low = lambda v: (v is not None, v if v is not None else 0)
    out = []
    for conv, turns in talks.items():
        turns.sort(key=lambda t: (low(t[0]), (t[1] is not None, t[1] or ""), t[2] or ""))
        for who in {t[1] for t in turns if t[1] != "system"}:
            start = 0
            for turn, role, text in turns:
                own = role == who
                kind = "assistant" if own else "system" if role == "system" else "user" + (f" name={role}" if role is not None else "")
                head = f"<|im_start|>{kind}\n"
                segment = f"{head}{text or ''}<|im_end|>\n"
                loss = (start + len(head), len(text or "") + 10) if own else (None, 0)
                out.append((conv, who, turn, role, segment, start, len(segment), *loss))
                start += len(segment)
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in chat_views.views(df).collect()), key=repr)


ODD = [
    (1, 0, "system", "Be kind."), (1, 1, "ann", "Hi é\U0001f600"), (1, 2, "bob", None), (1, 3, "ann", ""),
    (2, 0, "system", "alone"), (None, 0, "ann", "x"), (None, 1, "bob", "y"), (3, None, "ann", "late"), (3, 0, None, "who?"),
    (4, 0, "ann", "same"), (4, 0, "ann", "same"), (4, 0, "bob", "same"), (5, 1, "ann", "w " * 100_000), (5, 1, "bob", "b"),
]


def test_odd_conversations(spark):
    assert found(spark.createDataFrame(ODD, SCHEMA)) == plain(ODD)


def test_extra_columns_and_no_rows(spark):
    wide = spark.createDataFrame([row + ("x", "y", "z") for row in ODD], SCHEMA + ", Perspective string, `range` string, ROW string")
    assert found(wide) == plain(ODD)
    assert found(wide.limit(0)) == []


def test_hot_conversation_spans_ranges(spark):
    rows = [(7, turn, f"p{turn % 3}", f"turn {turn} " * (turn % 5)) for turn in range(3000)]
    rows += [(i, t, "ann" if t % 2 else "bob", "short") for i in range(100, 200) for t in range(4)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert found(spark.createDataFrame(rows, SCHEMA).repartition(5)) == plain(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)


def test_equal_turns_are_spread(spark):
    """A turn that fills a third of the rows is dealt to several ranges."""
    rows = [(1, 0, "ann", "same")] * 3000 + [(1, 1, "bob", "other")] * 10
    got = found(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert got == plain(rows)
