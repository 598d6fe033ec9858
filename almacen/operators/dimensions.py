"""Dimension tables: distinct members, insert-if-absent, surrogate ids, key lookup.

Sizes at scale. Members are found by a grouped aggregate, which collapses
repeated keys on the map side, so one member holding a third of all sales
costs no more than any other. Ids are assigned in 4096 hash buckets of the new
members. The key lookup broadcasts a dimension only when its size is proven
small (``operators.joins``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from almacen.model import Dimension
from almacen.operators.joins import join_dimension
from almacen.sources.warehouse import Staging

_BUCKET_DIGITS = 3  # hexadecimal digits of the key hash: 16 ** 3 = 4096 buckets
_KEY_SEPARATOR = "\x1f"


def members(df: DataFrame, dimension: Dimension) -> DataFrame:
    """The distinct members found in the data.

    When rows with one natural key disagree in the other attributes, the
    smallest combination is taken, so that the result does not depend on row order.
    """
    keys = list(dimension.natural_key)
    if not dimension.attributes:
        return df.select(*keys).dropDuplicates()
    attributes = F.struct(*dimension.attributes)
    return (
        df.groupBy(*keys)
        .agg(F.min(attributes).alias("_attributes"))
        .select(*keys, *[F.col(f"_attributes.{a}").alias(a) for a in dimension.attributes])
    )


def absent(found: DataFrame, existing: DataFrame, dimension: Dimension) -> DataFrame:
    """The members that the existing dimension does not hold yet."""
    keys = list(dimension.natural_key)
    return found.join(existing.select(*keys), keys, "left_anti")


def _key_hash(dimension: Dimension) -> Column:
    return F.md5(
        F.concat_ws(_KEY_SEPARATOR, *[F.col(k).cast("string") for k in dimension.natural_key])
    )


def assign_ids(new: DataFrame, dimension: Dimension, last_id: Column | int = 0) -> DataFrame:
    """Number distinct members from ``last_id + 1`` on, in order of (key hash, key).

    The order is a property of the members alone, so a re-run, a retried task
    or another partitioning gives the same ids. Members are ranked inside the
    bucket given by the first digits of their hash; a bucket's ids start after
    those of the buckets before it. The only ungrouped window runs over the
    bucket sizes, at most 4096 rows, which also bounds the broadcast.
    """
    keys = list(dimension.natural_key)
    hashed = new.withColumn("_hash", _key_hash(dimension)).withColumn(
        "_bucket", F.substring("_hash", 1, _BUCKET_DIGITS)
    )
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        hashed.groupBy("_bucket")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    )
    in_bucket = Window.partitionBy("_bucket").orderBy("_hash", *keys)
    start = last_id if isinstance(last_id, Column) else F.lit(last_id)
    return (
        hashed.withColumn("_rank", F.row_number().over(in_bucket))
        .join(F.broadcast(starts), "_bucket")
        .select(
            (start + F.col("_start") + F.col("_rank")).cast("long").alias(dimension.id_column),
            *keys,
            *dimension.attributes,
        )
    )


def merge_members(
    found: DataFrame, existing: DataFrame | None, dimension: Dimension
) -> DataFrame:
    """The existing dimension, untouched, plus the absent members with new ids."""
    if existing is None:
        return assign_ids(found, dimension)
    last_id = existing.select(F.coalesce(F.max(dimension.id_column), F.lit(0))).scalar()
    new = assign_ids(absent(found, existing, dimension), dimension, last_id)
    return existing.select(*dimension.columns).unionByName(new)


def lookup_id(
    df: DataFrame, table: DataFrame, dimension: Dimension, small: bool = False
) -> DataFrame:
    """Add the dimension's id to each row; every row is kept, null id where unknown."""
    keys = list(dimension.natural_key)
    return join_dimension(df, table.select(dimension.id_column, *keys), keys, small, "left")


def load_members(
    df: DataFrame, existing: DataFrame | None, dimension: Dimension, staging: Staging
) -> DataFrame:
    """Merge the members found in ``df`` into the dimension, write it, return the table."""
    merged = merge_members(members(df, dimension), existing, dimension)
    return staging.write(dimension.table, merged)


def load_dimension(
    df: DataFrame, existing: DataFrame | None, dimension: Dimension, staging: Staging
) -> DataFrame:
    """``load_members``, then the rows of ``df`` with the dimension's id."""
    table = load_members(df, existing, dimension, staging)
    return lookup_id(df, table, dimension, staging.is_small(dimension.table))
