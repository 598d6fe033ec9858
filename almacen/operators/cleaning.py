"""Cleaning stages, each a DataFrame to DataFrame step for ``DataFrame.transform``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almacen.functions import dates, numbers, text
from almacen.model import CleaningRules

RULES = CleaningRules()

# Reasons a row is left out, in the order they are tested.
NOT_POSITIVE = "non_positive_total"
CRITICAL_NULL = "null_critical_column"


def normalise_names(df: DataFrame) -> DataFrame:
    """Trim and lower-case column names, one underscore for each space."""
    names = [name.strip().lower().replace(" ", "_") for name in df.columns]
    repeated = sorted({name for name in names if names.count(name) > 1})
    if repeated:
        raise ValueError(f"columns with the same normalised name: {repeated}")
    return df.toDF(*names)


def _present(df: DataFrame, columns) -> list[str]:
    return [c for c in columns if c in df.columns]


def _require(df: DataFrame, columns) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")


def clean_text_columns(df: DataFrame, rules: CleaningRules = RULES) -> DataFrame:
    return df.withColumns({c: text.clean_text(F.col(c)) for c in _present(df, rules.text)})


def standardise_case(df: DataFrame, rules: CleaningRules = RULES) -> DataFrame:
    _require(df, rules.text)
    spaced = {c: text.underscores_to_spaces(F.col(c)) for c in rules.underscored}
    return df.withColumns(spaced).withColumns({c: text.title_case(F.col(c)) for c in rules.text})


def convert_types(df: DataFrame, rules: CleaningRules = RULES) -> DataFrame:
    """Measures to double and the date to a timestamp; unreadable cells become null."""
    _require(df, [rules.date])
    typed: dict[str, Column] = {}
    measures = _present(df, rules.measures)
    for name in measures:
        is_text = isinstance(df.schema[name].dataType, T.StringType)
        typed[name] = numbers.parse_number(F.col(name)) if is_text else F.col(name).cast("double")
    if isinstance(df.schema[rules.date].dataType, T.StringType):
        typed[rules.date] = dates.parse_date(F.col(rules.date), rules.date_formats)
    else:
        typed[rules.date] = F.col(rules.date).cast("timestamp_ntz")
    # a step of its own: in one expression each number would be parsed twice
    return df.withColumns(typed).withColumns({c: numbers.finite(F.col(c)) for c in measures})


def rejection_reason(rules: CleaningRules = RULES) -> Column:
    """Why a typed row is left out; null for a row that stays.

    ``convert_types`` has already turned NaN, which Spark holds greater than
    any number, into null.
    """
    positive = F.coalesce(F.col(rules.amount) > 0, F.lit(False))
    incomplete = F.lit(False)
    for name in rules.critical:
        incomplete = incomplete | F.col(name).isNull()
    return F.when(~positive, NOT_POSITIVE).when(incomplete, CRITICAL_NULL)


def positive_sales(df: DataFrame, rules: CleaningRules = RULES) -> DataFrame:
    _require(df, [rules.amount])
    return df.filter(F.col(rules.amount) > 0)


def complete_sales(df: DataFrame, rules: CleaningRules = RULES) -> DataFrame:
    return df.na.drop(subset=list(rules.critical))


def complete_texts(df: DataFrame, rules: CleaningRules = RULES) -> DataFrame:
    """``complete_sales`` for the text columns alone, for use ahead of text cleaning.

    Cleaning never makes a text null nor a null a text, so this leaves out the
    same rows; done afterwards, each text would be cleaned once more to test it.
    """
    return df.na.drop(subset=[c for c in rules.critical if c in rules.text])


def apply_business_rules(df: DataFrame, rules: CleaningRules = RULES) -> DataFrame:
    return df.transform(positive_sales, rules).transform(complete_sales, rules)


def remove_duplicates(df: DataFrame) -> DataFrame:
    """One row for each group of fully equal rows, nulls equal to nulls.

    Every column is a grouping key and nothing else is aggregated, so copies
    collapse on the map side: a group of any size leaves each task as one row.
    """
    return df.dropDuplicates()


def derive_columns(df: DataFrame, rules: CleaningRules = RULES) -> DataFrame:
    """Calendar parts of the date and the customer segment."""
    kind = F.col(rules.customer_type)
    segment = F.lit(rules.default_segment)
    for label, name in rules.segments.items():
        segment = F.when(kind == label, name).otherwise(segment)
    return df.withColumns(
        {**dates.calendar_columns(F.col(rules.date)), "segmento_cliente": segment}
    )


def fill_nulls(df: DataFrame, rules: CleaningRules = RULES) -> DataFrame:
    """Defaults for the listed columns; an empty string is not null and stays."""
    return df.na.fill({c: v for c, v in rules.null_defaults.items() if c in df.columns})


def order_columns(df: DataFrame, rules: CleaningRules = RULES) -> DataFrame:
    return df.select(*_present(df, rules.output))
