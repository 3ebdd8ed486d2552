"""Joins of a large fact table with a timetable-sized dimension.

The dimension is counted before it is broadcast. Above the bound the same join runs
as a shuffle whose key carries a salt, so that one hot stop or direction is spread
over many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import Broadcast
from pyspark.sql import DataFrame, functions as F

from ..settings import BROADCAST_ROWS, SALTS

_held: list[DataFrame | Broadcast] = []


def hold(df: DataFrame | Broadcast) -> DataFrame | Broadcast:
    """Keep a dimension that several lookups are built from, a table in the cache."""
    _held.append(df.persist() if isinstance(df, DataFrame) else df)
    return df


class Dimension:
    """A cached dimension and its measured size.

    ``weight`` is the SQL of a row's own size, such as the length of an array.
    """

    def __init__(self, df: DataFrame, weight: str = "1"):
        self.df = hold(df)
        self.rows = df.selectExpr(f"sum({weight}) AS n").first()["n"] or 0


def release_dimensions() -> None:
    """Drop every cached dimension, for example after a new timetable was published."""
    while _held:
        _held.pop().unpersist()


@contextmanager
def released_after() -> Iterator[None]:
    """Drop the dimensions that are cached inside the block, such as one micro-batch."""
    before = len(_held)
    try:
        yield
    finally:
        while len(_held) > before:
            _held.pop().unpersist()


def join_dimension(
    facts: DataFrame,
    dim: DataFrame | Dimension,
    keys: dict[str, str] | list[str],
    how: str = "left",
    *,
    salt_on: list[str],
    condition: str | None = None,
    max_rows: int = BROADCAST_ROWS,
    salts: int = SALTS,
) -> DataFrame:
    """Join facts to a dimension on its key columns.

    ``keys`` maps each key column of the dimension to SQL over the facts; a list means
    equal names. The dimension's own key columns are dropped from the result.
    ``condition`` is SQL that may use every other column of both sides.
    """
    if not isinstance(keys, dict):
        keys = {k: k for k in keys}
    if isinstance(dim, DataFrame):
        dim = Dimension(dim)
    right = dim.df.selectExpr(*[f"{c} AS _dim_{c}" if c in keys else c for c in dim.df.columns])
    left = facts.selectExpr("*", *[f"{sql} AS _fact_{k}" for k, sql in keys.items()])
    names = list(keys)
    if dim.rows <= max_rows:
        right = F.broadcast(right)
    else:
        left = left.selectExpr("*", f"pmod(xxhash64({', '.join(salt_on)}), {salts}) AS _fact_salt")
        right = right.selectExpr("*", f"explode(sequence(0L, {salts - 1}L)) AS _dim_salt")
        names.append("salt")
    on = [f"_fact_{k} = _dim_{k}" for k in names]
    if condition is not None:
        on.append(f"({condition})")
    joined = left.join(right, F.expr(" AND ".join(on)), how)
    return joined.drop(*[f"_{side}_{k}" for side in ("fact", "dim") for k in names])
