"""Data-quality measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almacen.operators.cleaning import CRITICAL_NULL, NOT_POSITIVE, rejection_reason
from almacen.operators.cleaning import RULES
from almacen.model import CleaningRules, Dimension


def cleaning_audit(typed: DataFrame, rules: CleaningRules = RULES) -> DataFrame:
    """Row counts of the cleaning stages, one row: read, left out by reason, kept.

    ``typed`` is the input of the business rules. One aggregate gives all of
    them: rejected rows are grouped by reason alone, the others by all their
    columns, so both collapse on the map side and the copies of a row are
    counted where they are removed. The counts come from the data, not from
    task metrics, so retried tasks do not change them.
    """
    reason = rejection_reason(rules)
    kept = [F.when(reason.isNull(), F.col(c)).alias(c) for c in typed.columns]
    groups = typed.select(reason.alias("motivo"), *kept).groupBy("motivo", *typed.columns)
    return audit_of_groups(groups.agg(F.count(F.lit(1)).alias("copias")))


def audit_of_groups(groups: DataFrame) -> DataFrame:
    """The same from groups of equal rows that are there already: ``motivo`` and ``copias``."""
    rows = F.coalesce(F.col("copias"), F.lit(0))
    stays = F.col("motivo").isNull()

    def total(test, value, name):
        return F.coalesce(F.sum(F.when(test, value)), F.lit(0)).cast("long").alias(name)

    return groups.agg(
        total(F.lit(True), rows, "leidas"),
        total(F.col("motivo") == NOT_POSITIVE, rows, "total_no_positivo"),
        total(F.col("motivo") == CRITICAL_NULL, rows, "critica_nula"),
        total(stays, rows - 1, "duplicadas"),
        total(stays, F.lit(1), "limpias"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls and type of each column, one row for each, from one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    types = F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair])
    long = counts.unpivot([], list(df.columns), "columna", "nulos")
    return long.withColumn("tipo", types[F.col("columna")])


def filled_nulls(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Nulls that the defaults fill, by column, and the nulls that remain in all others."""
    filled = [c for c in df.columns if c in defaults]
    rest = [c for c in df.columns if c not in defaults]
    remaining = F.lit(0).cast("long")
    for c in rest:
        remaining = remaining + F.count_if(F.col(c).isNull())
    counts = df.agg(
        *[F.count_if(F.col(c).isNull()).alias(c) for c in filled], remaining.alias("(restantes)")
    )
    return counts.unpivot([], [*filled, "(restantes)"], "columna", "nulos")


def table_summary(df: DataFrame, date: str = "fecha") -> DataFrame:
    """Rows, columns, date range and nulls of a table."""
    null_cells = F.lit(0).cast("long")
    for c in df.columns:
        null_cells = null_cells + F.count_if(F.col(c).isNull())
    return df.agg(
        F.count(F.lit(1)).alias("filas"),
        F.lit(len(df.columns)).alias("columnas"),
        F.min(date).alias("desde"),
        F.max(date).alias("hasta"),
        null_cells.alias("nulos"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("filas")).orderBy(F.desc("filas"), column)


def unique_members(df: DataFrame, dimensions: Sequence[Dimension]) -> DataFrame:
    """Number of distinct members of each dimension in the data, from one pass over it.

    The dimensions' keys are grouped side by side, so the copies of a member collapse on
    the map side; what is counted afterwards are members.
    """
    keys = list(dict.fromkeys(c for d in dimensions for c in d.natural_key))
    names = F.array(*[F.lit(d.table) for d in dimensions])
    # Which dimension a group is of: a column it groups by is set, one it does not is null by design.
    groups = df.groupingSets([list(d.natural_key) for d in dimensions], *keys)
    numbers = {_grouping_number(keys, d.natural_key): i for i, d in enumerate(dimensions)}
    if len(numbers) < len(dimensions):
        raise ValueError("dimensions with the same key")
    place = F.lit(None).cast("int")
    for number, i in numbers.items():
        place = F.when(F.grouping_id(*keys) == number, i).otherwise(place)
    members = groups.agg(place.alias("_place"))
    counts = members.groupBy("_place").agg(F.count(F.lit(1)).alias("miembros"))
    return counts.select(names[F.col("_place")].alias("dimension"), "miembros")


def _grouping_number(columns: Sequence[str], grouped: Sequence[str]) -> int:
    """grouping_id of the set: a bit for each column, the first highest, set where it is not grouped."""
    return int("".join("0" if c in grouped else "1" for c in columns), 2)


def load_audit(rejected: DataFrame) -> DataFrame:
    """Rows left out of the star schema, by reason."""
    return rejected.groupBy("motivo").agg(F.count(F.lit(1)).alias("filas"))
