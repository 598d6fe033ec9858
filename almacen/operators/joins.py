"""Joining a large table with a dimension, by the dimension's proven size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A table is broadcast only when its rows cannot take more than this.
BROADCAST_BYTES = 32 * 1024 * 1024

_BYTES_PER_CHARACTER = 4  # the most UTF-8 needs
_BYTES_PER_VALUE = 16


def bytes_at_most(rows: int, schema: T.StructType, lengths: dict[str, int]) -> int | None:
    """An upper bound of the table's size from its row count and column lengths.

    None when a text column has no length limit, for then there is no bound.
    """
    width = 0
    for f in schema.fields:
        if not isinstance(f.dataType, T.StringType):
            width += _BYTES_PER_VALUE
        elif f.name in lengths:
            width += _BYTES_PER_VALUE + lengths[f.name] * _BYTES_PER_CHARACTER
        else:
            return None
    return rows * width


def fits(rows: int | None, schema: T.StructType, lengths: dict[str, int]) -> bool:
    if rows is None:
        return False
    size = bytes_at_most(rows, schema, lengths)
    return size is not None and size <= BROADCAST_BYTES


def join_dimension(
    df: DataFrame, table: DataFrame, keys: list[str], small: bool, how: str = "inner"
) -> DataFrame:
    """Join each row with its dimension row.

    A small table is broadcast and the large side stays where it is. Otherwise
    it is left to the planner: a sort-merge join in which adaptive execution
    splits the partitions that hold a hot key, since the large side is the left one.
    """
    return df.join(F.broadcast(table) if small else table, keys, how)
