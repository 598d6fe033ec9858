"""Text columns: cleaning, title casing and "no value" tokens."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from almacen.model import NA_TOKENS, REMOVED_CHARACTERS

# All Unicode white space, the four ASCII separators included. Spelled out, because
# Java's own class leaves those out and is slower with Unicode switched on.
_WHITE_SPACE = (
    r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"
)
_OTHER_SPACE = r"\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{IsTitlecase}"
_WORD_INSIDE = f"(?<=[^ {_CASED}])(?=[{_CASED}])"
_PLAIN_WORDS = "^[A-Za-z ]*$"
_BREAK = "\uffff "  # a code point no text may hold, and the space that starts a word


def blank_to_null(c: Column, tokens: Iterable[str] = NA_TOKENS) -> Column:
    """Null where the whole cell is one of the "no value" tokens."""
    return F.when(~c.isin(*tokens), c)


def clean_text(c: Column, removed: str = REMOVED_CHARACTERS) -> Column:
    """Drop the listed characters, collapse white space to single spaces, trim."""
    cleaned = F.trim(F.regexp_replace(F.translate(c, removed, ""), _WHITE_SPACE, " "))
    # Most values are clean as they are, and looking costs less than rebuilding them.
    dropped = "".join(f"\\x{{{ord(x):x}}}" for x in removed)
    return F.when(c.rlike(rf"[{dropped}{_OTHER_SPACE}]|  |\A | \z"), cleaned).otherwise(c)


def title_case(c: Column) -> Column:
    """Upper-case each letter that follows a character without case, lower-case the rest.

    ``initcap`` starts words at spaces only, so a mark with a space is put in
    wherever a word starts inside another (``o'neil``, ``3m``) and taken out
    again. Values of ASCII letters and spaces have no such place.
    """
    marked = F.initcap(F.regexp_replace(c, _WORD_INSIDE, _BREAK))
    by_letter = F.replace(marked, F.lit(_BREAK), F.lit(""))
    return F.when(c.rlike(_PLAIN_WORDS), F.initcap(c)).otherwise(by_letter)


def underscores_to_spaces(c: Column) -> Column:
    return F.translate(c, "_", " ")
