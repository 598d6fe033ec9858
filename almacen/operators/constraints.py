"""Schema constraints as queries: each check returns one row for each violation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from almacen import schemas
from almacen.model import DIMENSIONS, FACT_KEYS, FACT_TABLE
from almacen.sources.warehouse import Star


def _key_text(columns: Sequence[str]) -> Column:
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns]
    return F.concat_ws("|", *shown)


def _violations(df: DataFrame, table: str, constraint: str, key: Column, rows: Column) -> DataFrame:
    return df.select(
        F.lit(table).alias("tabla"),
        F.lit(constraint).alias("restriccion"),
        key.alias("clave"),
        rows.cast("long").alias("filas"),
    )


def not_unique(df: DataFrame, table: str, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (keys with a null are never equal)."""
    repeated = (
        df.select(*key)
        .na.drop()
        .groupBy(*key)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > 1)
    )
    name = f"unique({','.join(key)})"
    return _violations(repeated, table, name, _key_text(key), F.col("_rows"))


def orphans(df: DataFrame, table: str, column: str, parent: DataFrame, key: str) -> DataFrame:
    """Foreign-key values without a parent row.

    The values are made distinct first, so the join sees each of them once.
    """
    values = df.groupBy(column).agg(F.count(F.lit(1)).alias("_rows"))
    values = values.filter(F.col(column).isNotNull())
    lost = values.join(parent.select(F.col(key).alias(column)), column, "left_anti")
    return _violations(lost, table, f"foreign_key({column})", _key_text([column]), F.col("_rows"))


def column_checks(
    df: DataFrame, table: str, required: Sequence[str], limits: Mapping[str, int]
) -> DataFrame:
    """Nulls in required columns and texts over their length, all counted in one pass."""
    tests = {f"not_null({c})": F.col(c).isNull() for c in required}
    tests |= {f"length({c})": F.length(c) > n for c, n in limits.items()}
    counts = df.agg(*[F.count_if(test).alias(name) for name, test in tests.items()])
    return counts.unpivot([], [f"`{name}`" for name in tests], "restriccion", "filas").select(
        F.lit(table).alias("tabla"), "restriccion", F.lit("").alias("clave"), "filas"
    ).filter(F.col("filas") > 0)


def dimension_violations(tables: Mapping[str, DataFrame]) -> list[DataFrame]:
    """Checks of the dimension tables alone, by table name."""
    found = []
    for d in DIMENSIONS:
        table = tables[d.table]
        required = [f.name for f in schemas.WAREHOUSE[d.table].fields if not f.nullable]
        found += [
            not_unique(table, d.table, [d.id_column]),
            not_unique(table, d.table, d.natural_key),
            column_checks(table, d.table, required, schemas.TEXT_LENGTHS[d.table]),
        ]
    client, region = tables["dim_cliente"], tables["dim_region"]
    found.append(orphans(client, "dim_cliente", "id_region", region, "id_region"))
    return found


def fact_column_violations(star: Star) -> DataFrame:
    """Nulls and lengths of the fact, from one scan."""
    required = [f.name for f in schemas.WAREHOUSE[FACT_TABLE].fields if not f.nullable]
    return column_checks(star.fact_ventas, FACT_TABLE, required, schemas.TEXT_LENGTHS[FACT_TABLE])


def fact_orphans(star: Star) -> DataFrame:
    """Ids of the fact without a member, all three from one scan.

    The ids are grouped side by side and collapse on the map side; only distinct ones
    meet the members.
    """
    columns = list(FACT_KEYS)
    groups = star.fact_ventas.groupingSets([[c] for c in columns], *columns)
    which = F.lit(None).cast("string")
    for c in columns:
        which = F.when(F.grouping(c) == 0, c).otherwise(which)
    ids = groups.agg(which.alias("_column"), F.count(F.lit(1)).alias("_rows"))
    ids = ids.select("_column", F.coalesce(*columns).alias("_id"), "_rows").filter("_id is not null")
    members = union(
        [star.table(d.table).select(F.lit(d.id_column).alias("_column"), F.col(d.id_column).alias("_id"))
         for d in DIMENSIONS if d.id_column in columns]
    )
    lost = ids.join(members, ["_column", "_id"], "left_anti")
    return lost.select(
        F.lit(FACT_TABLE).alias("tabla"),
        F.concat(F.lit("foreign_key("), "_column", F.lit(")")).alias("restriccion"),
        F.col("_id").cast("string").alias("clave"),
        F.col("_rows").cast("long").alias("filas"),
    )


def fact_violations(star: Star, row_ids: bool = True) -> list[DataFrame]:
    """``row_ids`` also checks that ``id_venta`` is unique, the one check that
    shuffles a value for each sale; the loader, which generates it, leaves it out."""
    found = [fact_column_violations(star), fact_orphans(star)]
    if row_ids:
        found.append(not_unique(star.fact_ventas, FACT_TABLE, ["id_venta"]))
    return found


def star_violations(star: Star, row_ids: bool = True) -> DataFrame:
    """Every constraint of the star schema; no rows when all hold."""
    tables = {d.table: star.table(d.table) for d in DIMENSIONS}
    return union(dimension_violations(tables) + fact_violations(star, row_ids))


def union(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, checks)


class ConstraintViolation(Exception):
    """A load broke the constraints of the star schema; ``path`` holds every violation."""

    def __init__(self, message: str, path: str | None = None):
        super().__init__(message)
        self.path = path


def enforce(violations: DataFrame, path: str) -> None:
    """Raise when there is any violation; all of them are written to ``path`` (Parquet)."""
    violations.write.parquet(path)
    stored = violations.sparkSession.read.schema(violations.schema).parquet(path)
    kinds = stored.groupBy("tabla", "restriccion").agg(F.sum("filas").alias("filas"))
    # One row for each constraint of the schema, whatever the data.
    rows = kinds.orderBy("tabla", "restriccion").collect()
    if rows:
        lines = [f"{r.tabla} {r.restriccion} ({r.filas} rows)" for r in rows]
        raise ConstraintViolation(f"{'; '.join(lines)}; all in {path}", path)
