"""A chain declared as data: blocks with named inputs and outputs, run in the order these imply.

A block reads columns and gives columns. Which block comes before which follows from the names, so
blocks may be listed in any order; a column that nobody gives, one that two blocks give, and a circle
are errors before anything runs. What runs is one DataFrame: the blocks are narrow or joins, and
Catalyst sees the whole chain.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import partial
from graphlib import CycleError, TopologicalSorter
from typing import Any

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class Block:
    """One step: what it does, the columns it reads, the columns it gives, and the blocks it comes after in any case."""

    name: str
    run: Callable[[DataFrame], DataFrame]
    inputs: tuple[str, ...] = ()
    outputs: tuple[str, ...] = ()
    after: tuple[str, ...] = field(default=())


def declared(spec: Iterable[Mapping[str, Any]], kinds: Mapping[str, Callable[..., DataFrame]], **given: Any) -> list[Block]:
    """Blocks from plain data, as it comes out of a configuration file.

    Each entry has a ``kind``, one of ``kinds``, and may have a ``name``, ``inputs``, ``outputs``, ``after``
    and ``params``, passed to the kind by name. A parameter ``"$answers"`` stands for ``given["answers"]``,
    so that frames need not be data.
    """
    blocks = []
    for entry in spec:
        unknown = set(entry) - {"kind", "name", "inputs", "outputs", "after", "params"}
        if unknown or entry.get("kind") not in kinds:
            raise ValueError(f"no such block: {entry.get('kind')!r} with {sorted(unknown)}")
        params = {
            name: given[value[1:]] if isinstance(value, str) and value.startswith("$") else value
            for name, value in entry.get("params", {}).items()
        }
        name = entry.get("name", entry["kind"])
        columns = (tuple(entry.get(part, ())) for part in ("inputs", "outputs", "after"))
        blocks.append(Block(name, partial(kinds[entry["kind"]], **params), *columns))
    return blocks


def ordered(blocks: Iterable[Block], columns: Iterable[str]) -> list[Block]:
    """The blocks in an order in which every column is there before it is read; as listed where the names leave it open.

    A block that gives a column it also reads, or that the rows have, changes it: those that only read
    it come after.
    """
    blocks, have = list(blocks), set(columns)
    by_name = {block.name: block for block in blocks}
    if len(by_name) < len(blocks):
        raise ValueError("two blocks have one name")
    givers: dict[str, str] = {}
    for block in blocks:
        for column in block.outputs:
            if column in givers:
                raise ValueError(f"{column} is given by {givers[column]} and by {block.name}")
            givers[column] = block.name
    graph: dict[str, set[str]] = {}
    for block in blocks:
        missing = [column for column in block.inputs if column not in have and column not in givers]
        missing += [name for name in block.after if name not in by_name]
        if missing:
            raise ValueError(f"{block.name} needs {', '.join(missing)}")
        before = {givers[column] for column in block.inputs if column in givers} | set(block.after)
        if block.name in before and any(column in block.inputs and column not in have for column in block.outputs):
            raise ValueError(f"{block.name} needs what only it gives")
        graph[block.name] = before - {block.name}
    sorter, place = TopologicalSorter(graph), {block.name: at for at, block in enumerate(blocks)}
    try:
        sorter.prepare()
    except CycleError as circle:
        raise ValueError(f"blocks wait for each other: {' > '.join(circle.args[1])}") from None
    order: list[Block] = []
    ready: list[str] = []
    while sorter.is_active():
        ready = sorted([*ready, *sorter.get_ready()], key=place.__getitem__)
        first, *ready = ready
        order.append(by_name[first])
        sorter.done(first)
    return order


def run_blocks(df: DataFrame, blocks: Iterable[Block]) -> DataFrame:
    """The rows after all blocks; a block that does not give what it declares is an error."""
    for block in ordered(blocks, df.columns):
        df = df.transform(block.run)
        missing = [column for column in block.outputs if column not in df.columns]
        if missing:
            raise ValueError(f"{block.name} does not give {', '.join(missing)}")
    return df
