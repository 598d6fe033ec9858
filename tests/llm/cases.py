"""Awkward tables that every operator has to take."""

from __future__ import annotations

LONG = "Weit und breit " * 20_000 + "x" * 300_000
COLUMNS = "doc_id long, text string, lang string, source string, size int, a long, b long, row string"

ROWS = [
    (1, "one two three four five six", "en", "web", 1, 1, 1, "x"),
    (2, "one two three four five six", None, None, None, None, None, None),
    (3, "", "en", "", 0, 0, 0, ""),
    (4, None, "en", "web", None, None, None, None),
    (5, " \t\n", None, "news", 1, 1, 1, "y"),
    (6, "ONE two", "en", "news", 1, 1, 1, "z"),
    (7, "one TWO", "en", "news", 1, 1, 1, "z"),
    (7, "one TWO", "en", "news", 1, 1, 1, "z"),
    (8, LONG, "de", "books", 1, 1, 1, "z"),
    (9, LONG + " end", "de", "books", 1, 1, 1, "z"),
    (None, "no key here at all in this row", "en", None, 1, 1, 1, "z"),
    (None, "one two three four five six", "en", "web", 1, 1, 1, "z"),
    (10, "Ünïcode ß 漢字 <|im_end|> <|endoftext|>", "de", "é", 1, 1, 1, "z"),
    (11, "1234 !!! ...", "en", "web", 1, 1, 1, "z"),
]


def awkward(spark):
    return spark.createDataFrame(ROWS, COLUMNS)


def nothing(spark):
    return spark.createDataFrame([], COLUMNS)
