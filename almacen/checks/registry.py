"""The registered checks: a Spark query and, where SQL can say it, its DuckDB equivalent."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almacen.checks.derived import Derived, derived


@dataclass(frozen=True)
class Check:
    run: Callable[[Derived], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return comparable(self.run(derived(spark, sf_dir)))


CHECKS: dict[str, Check] = {}


def check(key: str, sql: str | None):
    def register(run):
        CHECKS[key] = Check(run, sql)
        return run

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Types that both engines print alike: doubles, bigints, dates as text."""
    shown = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("long")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd")
        shown.append(c.alias(f.name))
    return df.select(*shown)
