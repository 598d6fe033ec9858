"""The sales fact: measure types, defaults, day-grain dates, row ids."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almacen import schemas
from almacen.functions.numbers import to_decimal
from almacen.model import FACT_KEYS
from almacen.operators.boundary import null_reason

#: Bits of an id that number_rows gives to the place in the partition.
_PLACE_BITS = 33
COLUMN_DEFAULTS = {"descuento": 0, "costo_envio": 0}


def day_grain(df: DataFrame, date: str = "fecha") -> DataFrame:
    """The date without its time of day, so that every sale finds its calendar row."""
    return df.withColumn(date, F.to_date(date))


def default_columns(df: DataFrame, defaults: Mapping[str, object] = COLUMN_DEFAULTS) -> DataFrame:
    """Add the columns that are absent, filled with their default; present ones stay."""
    return df.withColumns({c: F.lit(v) for c, v in defaults.items() if c not in df.columns})


def type_measures(df: DataFrame, types: Mapping = schemas.MEASURE_TYPES) -> DataFrame:
    return df.withColumns({c: to_decimal(F.col(c), kind, c) for c, kind in types.items()})


def fact_rows(sales: DataFrame) -> DataFrame:
    """Ids and typed measures of the sales that have all of them."""
    columns = [*FACT_KEYS, *schemas.MEASURE_TYPES]
    return sales.select(*columns).na.drop().transform(type_measures)


def rejected_facts(sales: DataFrame) -> DataFrame:
    """The sales left out of the fact, each with its reason."""
    reason = null_reason([*FACT_KEYS, *schemas.MEASURE_TYPES])
    return sales.withColumn("motivo", reason).filter(F.col("motivo").isNotNull())


def number_rows(fact: DataFrame, id_column: str = "id_venta", first_part: int = 0) -> DataFrame:
    """Add a unique row id.

    The id is made of the partition number, counted from ``first_part``, and the row's place
    in it. It is fixed when the table is written; ``gapless_ids`` makes a count of it.
    """
    start = F.lit((first_part << _PLACE_BITS) + 1)
    return fact.select((F.monotonically_increasing_id() + start).alias(id_column), "*")


def parts_numbered(fact: DataFrame, id_column: str = "id_venta") -> int:
    """The partition numbers that the ids of a stored fact have used: the ``first_part`` of more rows."""
    last = fact.agg(F.max(F.shiftright(F.col(id_column) - 1, _PLACE_BITS))).first()[0]
    return 0 if last is None else last + 1


def gapless_ids(fact: DataFrame, id_column: str = "id_venta") -> DataFrame:
    """The rows of a stored fact with their ids as 1, 2, ... in the order of the ids stored.

    What a partition wrote has consecutive ids, so an id becomes its place there plus the
    rows of the partitions before. The counts come from the id column of the same
    files, so every reader gets the same ids, and nothing is written twice. They are a
    subquery of the id alone: a query that does not use the ids does not count. The one
    ungrouped window runs over as many rows as the table was written by tasks.
    """
    stored = F.col(id_column) - 1
    part = F.shiftright(stored, _PLACE_BITS)
    sizes = fact.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    last = sizes.agg(F.max("part").alias("last"))
    every = last.select(F.explode(F.sequence(F.lit(0).cast("long"), "last")).alias("part"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = every.join(sizes, "part", "left").select(
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
    )
    in_order = F.array_sort(F.collect_list(F.struct("part", "start")))
    starts = starts.agg(F.transform(in_order, lambda x: x["start"]).alias("starts")).scalar()
    place = stored.bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return fact.withColumn(id_column, F.get(starts, part.cast("int")) + place + 1)
