"""Dates: parsing with declared formats and calendar parts."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_TIME_LETTERS = re.compile(r"[HhKkmsSa]")


def _parse_one(c: Column, pattern: str) -> Column:
    if not _TIME_LETTERS.search(re.sub(r"'[^']*'", "", pattern)):
        return F.try_to_date(c, pattern).cast("timestamp_ntz")
    # Read as UTC and rebuilt from the epoch, so that the wall-clock time in the
    # file does not depend on the session time zone or its daylight-saving gaps.
    utc = F.try_to_timestamp(F.concat(c, F.lit(" Z")), F.lit(f"{pattern} XXX"))
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(utc), epoch)


def parse_date(c: Column, formats: Sequence[str] = ("yyyy-MM-dd",)) -> Column:
    """The first of the declared formats that reads the text; null when none does."""
    return F.coalesce(*[_parse_one(c, pattern) for pattern in formats])


def voted_format(df: DataFrame, column: str, candidates: Sequence[str]) -> str:
    """The candidate that reads most values of a text column, whatever the order of the rows.

    One aggregate over all rows counts what each candidate reads. Candidates that read
    equally many are one and the same if they never read a value differently, and the
    first of them is taken; otherwise, as with day and month in 01/02/2024, the vote is
    an error. So is a column without a value that any candidate reads.
    """
    read = [_parse_one(F.col(column), pattern).alias(f"r{i}") for i, pattern in enumerate(candidates)]
    rows = df.select(F.col(column).alias("given"), *read)
    pairs = [(i, j) for j in range(len(candidates)) for i in range(j)]
    counts = rows.agg(
        F.count("given").alias("given"),
        *[F.count(f"r{i}").alias(f"n{i}") for i in range(len(candidates))],
        *[F.count_if(F.col(f"r{i}") != F.col(f"r{j}")).alias(f"d{i}_{j}") for i, j in pairs],
    ).first()
    votes = [counts[f"n{i}"] for i in range(len(candidates))]
    if not max(votes):
        raise ValueError(
            f"all {counts['given']} values of {column} are unreadable as {', '.join(candidates)}"
        )
    best = [i for i, n in enumerate(votes) if n == max(votes)]
    if any(counts[f"d{i}_{j}"] for i, j in pairs if i in best and j in best):
        names = " or ".join(candidates[i] for i in best)
        raise ValueError(f"{max(votes)} values of {column} may be read as {names}")
    return candidates[best[0]]


def calendar_columns(date: Column) -> dict[str, Column]:
    return {
        "year": F.year(date),
        "month": F.month(date),
        "year_month": F.date_format(date, "yyyy-MM"),
    }
