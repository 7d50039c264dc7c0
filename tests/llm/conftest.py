import random

import pytest

#: Columns that operators name inside themselves, in various cases.
CLASHING = ("Encoded", "counted", "COUNTS", "verdict", "row", "Node", "label", "text_hash", "key", "n", "score", "parsed")


@pytest.fixture(scope="session")
def prose():
    """Texts of invented words, the same ones every time."""
    draw = random.Random(7)
    words = ["".join(draw.choice(["ka", "lo", "mi", "ter", "é", "un", "sto"]) for _ in range(draw.randint(1, 4))) for _ in range(400)]

    def make(n_words, seed):
        own = random.Random(seed)
        return " ".join(own.choice(words) for _ in range(n_words))

    return make


@pytest.fixture(scope="session")
def odd_documents(spark, prose):
    """Null ids and texts, empty and very long texts, repeated rows, and columns with clashing names."""
    rows = [
        (1, prose(60, 1)), (1, prose(60, 1)), (2, prose(60, 1)), (None, prose(60, 1)), (None, None), (3, None), (4, ""),
        (5, " \n\t "), (6, prose(40_000, 2)), (7, "x" * 300_000), (8, prose(30, 3)), (8, prose(30, 4)), (9, "a"),
        (10, prose(60, 1) + " Ka<|endoftext|>lo \U0001f600"), (11, "ka lo " * 50),
    ]
    schema = "doc_id long, text string, " + ", ".join(f"`{name}` string" for name in CLASHING)
    return spark.createDataFrame([row + (None,) * len(CLASHING) for row in rows], schema)


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
