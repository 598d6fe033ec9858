"""Distribution of a column: equal-width histogram and exact quantiles."""

from __future__ import annotations

import math
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits by which values are told apart in one pass.
DIGIT = 14
_MOST_DIGITS = 18  # of a decimal whose unscaled value is a 64-bit number


def histogram(df: DataFrame, column: str, bins: int = 20) -> DataFrame:
    """Rows in each of ``bins`` equal-width intervals from the least to the greatest value.

    The last interval includes its upper end; intervals without rows have
    count 0. The column is a decimal of two places, and intervals are found on
    whole hundredths, so a value on a boundary is never misplaced by rounding.
    """
    hundredths = (F.col(column) * 100).cast("long")
    ends = df.agg(F.min(hundredths).alias("low"), F.max(hundredths).alias("high"))
    low = ends.select("low").scalar()
    high = ends.select("high").scalar()
    place = F.call_function("div", (hundredths - low) * bins, F.nullif(high - low, F.lit(0)))
    counts = (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.least(F.coalesce(place, F.lit(0)), F.lit(bins - 1)).cast("int").alias("bin"))
        .agg(F.count(F.lit(1)).alias("filas"))
    )
    edges = ends.select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "low", "high"
    ).filter(F.col("low").isNotNull())

    def edge(step):
        return (F.col("low") + (F.col("high") - F.col("low")) * step / bins) / 100

    return (
        edges.join(F.broadcast(counts), "bin", "left")  # at most one row for each bin
        .select(
            "bin",
            edge(F.col("bin")).alias("desde"),
            edge(F.col("bin") + 1).alias("hasta"),
            F.coalesce("filas", F.lit(0)).alias("filas"),
        )
        .orderBy("bin")
    )


def _whole_numbers(df: DataFrame, column: str) -> tuple[DataFrame, int]:
    """The values without nulls as whole numbers (column ``v``), and the decimal places moved."""
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType) and kind.precision <= _MOST_DIGITS:
        scale = kind.scale
    elif isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        scale = 0
    else:
        raise TypeError(f"{column} is {kind.simpleString()}, not an integer or a short decimal")
    whole = (F.col(column) * F.lit(10**scale)).cast("long").alias("v")
    return df.select(whole).filter(F.col("v").isNotNull()), scale


def order_statistics(values: DataFrame, low: int, high: int, ranks: Sequence[int]) -> dict[int, int]:
    """The value at each rank (from 0) of the whole numbers ``v``, which lie in low..high.

    Radix descent: values are counted by their leading bits, then those whose leading
    bits hold a wanted rank by more bits, until all are known. Nothing is sorted or
    gathered: a level counts at most 2^DIGIT groups for each wanted rank, however many
    values fall in them, and only these counts leave the tasks.
    """
    above = F.col("v") - F.lit(low)
    known, left = 0, (high - low).bit_length()
    # Leading bits, with the wanted ranks counted from the first value that has them.
    places = {0: [(rank, rank) for rank in sorted(set(ranks))]}
    while left:
        digit = min(DIGIT, left)
        held = values.filter(F.shiftright(above, left).isin(*places)) if known else values
        left -= digit
        groups = held.groupBy(F.shiftright(above, left).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
        counts: dict[int, list[tuple[int, int]]] = {}
        for bits, n in sorted(map(tuple, groups.collect())):
            counts.setdefault(bits >> digit, []).append((bits, n))
        deeper: dict[int, list[tuple[int, int]]] = {}
        for bits, wanted in places.items():
            before = 0
            for inner, n in counts[bits]:
                found = [(rank, at - before) for rank, at in wanted if before <= at < before + n]
                if found:
                    deeper[inner] = found
                before += n
        places, known = deeper, known + digit
    return {rank: low + bits for bits, wanted in places.items() for rank, _ in wanted}


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> DataFrame:
    """Exact quantiles, interpolated between neighbours: columns ``probability``, ``quantile``.

    Spark's ``percentile`` gathers all distinct values in one task; here the two
    neighbours of each place are found by ``order_statistics``. No values give no rows.
    """
    found = _quantiles(df, column, probabilities)
    return df.sparkSession.createDataFrame(list(found.items()), "probability double, quantile double")


def _quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> dict[float, float]:
    values, scale = _whole_numbers(df, column)
    low, high, rows = values.agg(F.min("v"), F.max("v"), F.count("v")).first()
    if not rows:
        return {}
    places = {float(p): float(p) * (rows - 1) for p in probabilities}
    ranks = {rank for place in places.values() for rank in (math.floor(place), math.ceil(place))}
    whole = order_statistics(values, low, high, sorted(ranks))
    value = {rank: float(Decimal(v).scaleb(-scale)) for rank, v in whole.items()}
    return {
        p: value[math.floor(place)] * (1 - place % 1) + value[math.ceil(place)] * (place % 1)
        for p, place in places.items()
    }


def box_plot(df: DataFrame, column: str, reach: float = 1.5) -> DataFrame:
    """Quartiles, fences at ``reach`` interquartile ranges, and the rows beyond them: one row."""
    found = _quantiles(df, column, (0.25, 0.5, 0.75))
    q1, middle, q3 = (found.get(p) for p in (0.25, 0.5, 0.75))
    low, high = (q1 - reach * (q3 - q1), q3 + reach * (q3 - q1)) if found else (None, None)
    value = F.col(column).cast("double")
    shown = {"q1": q1, "mediana": middle, "q3": q3, "limite_inferior": low, "limite_superior": high}
    return df.agg(
        F.min(value).alias("minimo"),
        F.max(value).alias("maximo"),
        F.count_if((value < F.lit(low)) | (value > F.lit(high))).alias("atipicos"),
        F.count(column).alias("filas"),
    ).select(
        *[F.lit(v).cast("double").alias(name) for name, v in shown.items()],
        "minimo",
        "maximo",
        "atipicos",
        "filas",
    )
