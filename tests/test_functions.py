from __future__ import annotations

import datetime
import random
import re
from decimal import Decimal
from fractions import Fraction

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from almacen.functions import dates, numbers, text
from almacen.model import NA_TOKENS


def column(spark, values, kind="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {kind}")


def apply(spark, values, expression, kind="string"):
    rows = column(spark, values, kind).select("v", expression(F.col("v")).alias("r")).collect()
    return [r.r for r in rows]


def random_texts(seed, alphabet, count=3000):
    chosen = random.Random(seed)
    return ["".join(chosen.choices(alphabet, k=chosen.randint(0, 12))) for _ in range(count)]


WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        　"


def test_clean_text_matches_python_on_random_text(spark):
    texts = random_texts(1, "ab#*@$%^&(){}[]<>~`é_-​" + WHITE)
    expected = [re.sub(r"\s+", " ", re.sub(r"[@#*$%^&(){}\[\]<>~`]", "", t)).strip() for t in texts]
    assert apply(spark, texts, text.clean_text) == expected


def test_clean_text_knows_every_white_space_character(spark):
    points = [chr(p) for p in range(1, 0x10000) if not 0xD800 <= p <= 0xDFFF]
    found = apply(spark, [f"a{p}b" for p in points], text.clean_text)
    missed = [p for p, r in zip(points, found) if p.isspace() != (r == "a b")]
    assert missed == []


def test_clean_text_keeps_null_and_may_give_an_empty_text(spark):
    assert apply(spark, [None, "###", "  "], text.clean_text) == [None, "", ""]


def test_title_case_matches_python_on_random_text(spark):
    texts = random_texts(2, "abzABZ ßǆǅςİıŉéÀÑ0123_'-.,/中ñ̇") + random_texts(3, "ab Z3'_")
    assert apply(spark, texts, text.title_case) == [t.title() for t in texts]


@pytest.mark.parametrize(
    "given, expected",
    [
        ("o'neil 3m x-large", "O'Neil 3M X-Large"),
        ("CAFÉ  MOLIDO", "Café  Molido"),
        ("coca_cola", "Coca_Cola"),
        ("ΟΔΟΣ", "Οδος"),
        (None, None),
        ("", ""),
    ],
)
def test_title_case(spark, given, expected):
    assert apply(spark, [given], text.title_case) == [expected]


def test_na_tokens_are_compared_exactly(spark):
    others = ["Nan", "Null", "none", "NONE", " NA ", "x"]
    assert apply(spark, NA_TOKENS, text.blank_to_null) == [None] * len(NA_TOKENS)
    assert apply(spark, others, text.blank_to_null) == others


def test_parse_number_agrees_with_pandas(spark):
    texts = ["12", " 12 ", "\t7\n", "1e3", "1.5E-2", "+.5", "5.", "-3", ".", "e3", "1,000", "$5"]
    texts += ["0x10", "1d", "1f", "1_000", "1 2", "--1", "abc", "", "1e", "12-", "١٢"]
    expected = pd.to_numeric(pd.Series(texts), errors="coerce")
    found = apply(spark, texts, lambda c: numbers.finite(numbers.parse_number(c)))
    assert found == [None if pd.isna(x) else x for x in expected]


def test_infinities_and_nan_are_no_numbers(spark):
    found = apply(
        spark,
        ["inf", "-inf", "Infinity", "nan", "1e400", "-1e400"],
        lambda c: numbers.finite(numbers.parse_number(c)),
    )
    assert found == [None] * 6
    doubles = [float("nan"), float("inf"), -float("inf"), 2.0]
    assert apply(spark, doubles, numbers.finite, "double") == [None, None, None, 2.0]


def test_storage_type_rounds_half_away_from_zero(spark):
    kind = T.DecimalType(5, 2)
    found = apply(
        spark, [0.125, 1.005, 2.675, -0.125], lambda c: numbers.to_decimal(c, kind, "x"), "double"
    )
    assert found == [Decimal(v) for v in ("0.13", "1.01", "2.68", "-0.13")]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_a_value_that_does_not_fit_is_an_error(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="descuento does not fit"):
            apply(
                spark,
                [1000.0],
                lambda c: numbers.to_decimal(c, T.DecimalType(5, 2), "descuento"),
                "double",
            )
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_ratios_are_exact_and_rounded_once(spark):
    chosen = random.Random(4)
    pairs = [
        (Decimal(chosen.randint(-(10**16), 10**16)).scaleb(-2), chosen.randint(1, 10**7))
        for _ in range(2000)
    ] + [(Decimal("10049.99"), 2010000), (Decimal("0.05"), 2), (Decimal("-0.05"), 2)]
    pairs += [(Decimal("1.00"), 0), (None, 3)]
    rows = spark.createDataFrame(pairs, "s decimal(24,2), n long")
    found = [r.m for r in rows.select(numbers.mean_2dp(F.col("s"), F.col("n")).alias("m")).collect()]
    for (s, n), m in zip(pairs, found):
        if s is None or n == 0:
            assert m is None
        else:
            exact = Fraction(s) / n
            hundredths = int(abs(exact) * 100 + Fraction(1, 2))
            assert m == Decimal(hundredths).scaleb(-2) * (-1 if exact < 0 else 1)


def test_percent(spark):
    rows = spark.createDataFrame(
        [(Decimal("1.00"), Decimal("3.00")), (Decimal("-1.00"), Decimal("8.00")), (Decimal(1), Decimal(0))],
        "a decimal(14,2), b decimal(14,2)",
    )
    found = [r.p for r in rows.select(numbers.percent_2dp(F.col("a"), F.col("b")).alias("p")).collect()]
    assert found == [Decimal("33.33"), Decimal("-12.50"), None]


def test_dates_are_read_by_declared_formats_only(spark):
    texts = ["2024-01-15", "31/01/2024", "2024-02-30", "not a date", "", None]
    day = datetime.datetime(2024, 1, 15)
    assert apply(spark, texts, dates.parse_date) == [day] + [None] * 5
    both = apply(spark, texts, lambda c: dates.parse_date(c, ["yyyy-MM-dd", "dd/MM/yyyy"]))
    assert both == [day, datetime.datetime(2024, 1, 31)] + [None] * 4


def test_wall_clock_times_do_not_depend_on_the_session_zone(spark):
    # this night's first half hour does not exist in Sao Paulo
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        found = apply(
            spark,
            ["2018-11-04 00:30:00", "2018-11-04"],
            lambda c: dates.parse_date(c, ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd"]),
        )
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert found == [datetime.datetime(2018, 11, 4, 0, 30), datetime.datetime(2018, 11, 4)]
