"""The step between clean files and the star schema: validate, type, reject."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almacen import schemas
from almacen.functions.numbers import cast_or_fail
from almacen.functions.text import blank_to_null
from almacen.model import NA_TOKENS, REQUIRED_COLUMNS


def require_columns(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def blank_tokens_to_null(df: DataFrame, na_tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Null for text cells that hold a "no value" token, as a CSV re-read would give."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: blank_to_null(F.col(c), na_tokens) for c in texts})


def type_clean_columns(df: DataFrame, schema: T.StructType = schemas.CLEAN) -> DataFrame:
    """Cast a clean CSV read as text; a cell that cannot be cast is an error."""
    typed = {}
    for f in schema.fields:
        if f.name in df.columns and df.schema[f.name].dataType != f.dataType:
            typed[f.name] = cast_or_fail(F.col(f.name), f.dataType, f"unreadable {f.name}")
    return df.withColumns(typed)


def null_reason(columns: Sequence[str]) -> Column:
    """``null <column>`` for the first of the columns that is null, else null."""
    return F.coalesce(*[F.when(F.col(c).isNull(), F.lit(f"null {c}")) for c in columns])


def drop_incomplete(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    return df.na.drop(subset=list(required))


def rejected(df: DataFrame, required: Sequence[str] = REQUIRED_COLUMNS) -> DataFrame:
    """The rows ``drop_incomplete`` leaves out, each with its reason."""
    return df.withColumn("motivo", null_reason(required)).filter(F.col("motivo").isNotNull())
