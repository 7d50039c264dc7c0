"""Order keys: a seeded hash per row stands in for a random shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from seedloom.functions.text import as_column


def order_key(key: Column | str, seed: int, purpose: str) -> Column:
    """md5 of ``seed|purpose|key``: sorting by it is a reproducible shuffle.

    ``key`` must be unique and not null. Each draw needs a purpose of its own:
    with a shared one, the rows of an earlier draw would also come first in the
    next, and, say, all sampled rows would land in the training split.
    """
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(purpose), as_column(key).cast("string")))


def value_key(*columns: str) -> Column:
    """Hash that two rows share exactly when the columns are equal by value."""
    return F.sha2(F.to_json(F.struct(*[F.col(name) for name in columns])), 256)
