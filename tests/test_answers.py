"""Answers joined with requests, as tables and as streams that are started again."""

import random
from datetime import datetime, timedelta

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from seedloom.streaming.answers import Waiting, first_deliveries, join_answers
from seedloom.streaming.batches import file_stream, run_batches

START = datetime(2024, 1, 1)
ASKED = "ex_id long, stage string, sent_at timestamp, note string"
CAME = "ex_id long, stage string, choice_idx int, content string, came_at timestamp"


def at(seconds):
    return None if seconds is None else START + timedelta(seconds=seconds)


def frames(values, asked, came):
    return values(ASKED, [(k, s, at(t), "n") for k, s, t in asked]), values(CAME, [(k, s, c, x, at(t)) for k, s, c, x, t in came])


def test_tables(values):
    asked = [(1, "a", 0), (2, "a", 0), (3, "a", 0), (4, "a", 100), (None, "a", 0), (5, None, 0), (6, "a", None)]
    came = [
        (1, "a", 0, "x", 5), (1, "a", 1, "y", 3600), (2, "a", 0, "late", 3601), (4, "a", 0, "early", 99), (None, "a", 0, "z", 5),
        (5, None, 0, "z", 5), (6, "a", 0, "z", 5), (9, "a", 0, "nobody", 5), (1, "b", 0, "other stage", 5),
    ]
    joined = join_answers(*frames(values, asked, came))
    assert joined.columns == ["ex_id", "stage", "sent_at", "note", "choice_idx", "content", "came_at"]
    found = sorted((r.ex_id or 0, r.choice_idx, r.content) for r in joined.collect() if r.content)
    assert found == [(1, 0, "x"), (1, 1, "y")]
    assert sum(r.content is None for r in joined.collect()) == 6


@pytest.mark.parametrize("restarts", [1, 5])
def test_streams_give_the_rows_of_tables(spark, values, tmp_path, restarts):
    draw = random.Random(restarts)
    asked = [(k, s, draw.randint(0, 20_000)) for k in range(60) for s in "ab"]
    came = []
    for k, s, t in asked:
        for choice in range(draw.randint(0, 2)):
            came.append((k, s, choice, f"{k}{s}{choice}", t + draw.randint(0, 5000)))
            came += [came[-1]] * draw.randint(0, 2)
    expected = join_answers(*frames(values, asked, sorted(set(came))))
    cuts = [0, *(20_000 * i // restarts for i in range(1, restarts)), 10**9]
    folders, out, checkpoint = (str(tmp_path / "asked"), str(tmp_path / "came")), str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for low, high in [*zip(cuts, cuts[1:]), (None, None)]:
        part = [r for r in asked if low <= r[2] < high] if high else [(None, "end", 10**8)]
        later = [r for r in came if low <= r[4] < high] if high else [(None, "end", 0, "", 10**8)]
        for df, folder in zip(frames(values, part, later), folders):
            df.write.mode("append").parquet(folder)
        streams = [file_stream(spark, folder, schema, 100, "parquet") for folder, schema in zip(folders, (ASKED, CAME))]
        run_batches(
            streams[0], lambda rows: join_answers(rows, first_deliveries(streams[1])), out, checkpoint, pause_seconds=None  # noqa: B023
        ).awaitTermination()
    found = spark.read.schema(expected.schema).parquet(out).where(F.col("ex_id").isNotNull())
    assert rows_of(found.drop("came_at", "choice_idx").fillna("")) == rows_of(expected.drop("came_at", "choice_idx").fillna(""))
    assert found.count() == expected.count()


def test_state_is_bounded(spark, values, tmp_path):
    """A row behind the watermark is dropped: what a timeout and the disorder cover is all that state keeps."""
    waiting = Waiting(timeout="10 seconds", disorder="1 second")
    folders = [str(tmp_path / name) for name in ("asked", "came")]
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for asked, came in ([(1, "a", 0)], []), ([(2, "a", 1000)], [(9, "a", 0, "x", 1000)]), ([(3, "a", 2000)], [(1, "a", 0, "x", 5), (9, "a", 0, "y", 2000)]):
        for df, folder in zip(frames(values, asked, came), folders):
            df.write.mode("append").parquet(folder)
        streams = [file_stream(spark, folder, schema, 100, "parquet") for folder, schema in zip(folders, (ASKED, CAME))]
        run_batches(streams[0], lambda rows: join_answers(rows, streams[1], waiting), out, checkpoint, pause_seconds=None).awaitTermination()  # noqa: B023
    found = spark.read.parquet(out).collect()
    assert (1, None) in [(r.ex_id, r.content) for r in found] and all(r.content is None for r in found)
