"""Numbers: parsing, storage types and exact two-decimal means and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The characters of decimal notation with an exponent, and white space.
_NUMBER_CHARACTERS = "0123456789+-.eE \t\n\r\f\v"
_WHOLE = T.DecimalType(38, 0)


def parse_number(c: Column) -> Column:
    """The text as a double; null when it is no number.

    The cast checks the form. The list of characters keeps out what the cast
    would take but a data file should not mean: ``1d``, ``1f``, ``inf``, ``nan``.
    A number too large for a double still gives infinity; see ``finite``.
    """
    return F.when(F.translate(c, _NUMBER_CHARACTERS, "") == "", c.try_cast("double"))


def finite(c: Column) -> Column:
    """A double with NaN and the infinities turned to null."""
    return F.when(F.abs(c) < float("inf"), c)  # NaN is the greatest value


def to_decimal(c: Column, kind: T.DecimalType, name: str) -> Column:
    """Cast to the storage type, half away from zero; a value that does not fit is an error."""
    return cast_or_fail(c, kind, f"{name} does not fit {kind.simpleString()}")


def cast_or_fail(c: Column, kind: T.DataType, complaint: str) -> Column:
    """A cast that fails with the complaint and the value, whether or not ANSI mode is on."""
    message = F.concat(F.lit(f"{complaint}: "), c.cast("string"))
    failure = F.when(c.isNotNull(), F.raise_error(message).cast(kind))
    return F.coalesce(c.try_cast(kind), failure)


def ratio_2dp(numerator: Column, denominator: Column) -> Column:
    """numerator / denominator rounded half away from zero to 2 decimals, as decimal(22,2).

    Both are whole numbers or decimals of two places. The quotient is taken on
    whole hundredths, so it is rounded once: dividing decimals first and
    rounding then would round twice. Null when the denominator is null or 0.
    """
    # 100 * n / d, rounded = (2 * 100 * |n| + |d|) div (2 * |d|)
    top = F.abs(numerator * F.lit(100)).cast(_WHOLE) * F.lit(100).cast(T.DecimalType(3, 0))
    low = F.abs(denominator * F.lit(100)).cast(_WHOLE)
    low = F.when(low != 0, low)
    hundredths = F.call_function("div", (top * 2 + low).cast(_WHOLE), (low * 2).cast(_WHOLE))
    sign = F.when((numerator < 0) != (denominator < 0), -1).otherwise(1)
    return (hundredths.cast(T.DecimalType(20, 0)) * sign / 100).cast(T.DecimalType(22, 2))


def mean_2dp(total: Column, count: Column) -> Column:
    """total / count to 2 decimals, rounded once."""
    return ratio_2dp(total, count)


def percent_2dp(part: Column, whole: Column) -> Column:
    """100 * part / whole to 2 decimals, rounded once; null when whole is 0."""
    return ratio_2dp(part * F.lit(100), whole)
