"""License scans by canonical digests.

A text is brought to a canonical form: A-Z in lower case, copyright notices left
out, equivalent spellings made equal, runs of white space and punctuation turned
into one space. The SHA-256 of the form is joined with the digests of known
license texts and notices. Two kinds of entire texts are looked up: the whole
document, and each of its lines, where one-sentence notices stand.

What a copyright notice is, is one rule of two steps. A sign or 'copyright' with a year
opens a notice; if one of OPENINGS follows in its paragraph, or begins the next one, all
between goes, however many lines of holders that are. Else a notice is a line that begins with a sign, a
year or a holder ('copyright notice' or 'copyright holders' begin body text), and goes up
to an opening in that line or to its end. So a license has the same digest
however its lines are broken.

Only what ``license_texts`` holds can be recognised: the whole texts of MIT, ISC, 0BSD,
BSD-2-Clause, BSD-3-Clause and Zlib, the digests of whole Apache-2.0, GPL, LGPL, MPL, GFDL, CC0-1.0
and Artistic texts, and one-sentence notices of some. A GPL text does not say whether later versions
are allowed, so it is named without 'only' or 'or later'; those with a form for notices at their
end are known as long as its notice starts a line. ``scan`` takes a table with more.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from almacen.llm.license_texts import KNOWN, SPELLINGS, WHOLE_DIGESTS
from almacen.llm.stored import bounded, prepared, stored

#: All patterns mean the same to Java's and to RE2's regular expressions.
_NO_WORD = r"\x00-\x2F\x3A-\x60\x7B-\x7F ‐‑‒–—―‘’“”•…"
NOT_WORD = f"[{_NO_WORD}]+"
_FIRST_WORD = f"^[{_NO_WORD}]*([^{_NO_WORD}]+)"
#: What follows a notice, be it on the same line.
OPENINGS = (
    "permission is hereby granted",
    "permission is granted to anyone",
    "permission to use",
    "redistribution and use",
    "this software is provided",
    "everyone is permitted",
    "licensed under",
    "released under",
    "this work is licensed",
    "spdx-license-identifier",
    "the mit license",
    "mit license",
    "isc license",
    "zlib license",
    "bsd zero clause license",
    "bsd 2-clause license",
    "bsd 3-clause license",
)
_OPENING = "(?:" + "|".join(x.replace(" ", r"\s+").replace("-", r"-\s*") for x in OPENINGS) + ")"
_YEAR = r"(?:(?:19|20)[0-9]{2}\b|[<\[{(]?(?:yyyy|year)\b)"
_SIGN = r"(?:\(c\)|©)"
_DATED = rf"(?:copyright[\s:,]*{_SIGN}|(?:copyright|{_SIGN})[\s:,]*{_YEAR}|©)"
#: Words after 'copyright' that no holder's name begins with.
_NO_HOLDER = (
    r"(?:notices?|holders?|owners?|laws?|licen[sc]es?|permissions?|statements?|disclaimers?|interests?|rights?"
    r"|treat(?:y|ies)|protections?|status|claims?|acts?|and|or|on|in|to|of|is|are|for|as|if|that|which|with|has|have"
    r"|may|must|shall|will|under|from|applies|infringement|ownership|terms?|conditions?|information|subsists)"
)
_OPENS = rf"(?:^|[^a-z0-9])({_OPENING}"
PARAGRAPHS = r"\n[ \t\r]*\n"
#: In a paragraph, a dated notice with one of OPENINGS after it; kept are groups 1 and 3.
NOTICE_BEFORE = rf"^([\s\S]*?)(^|[^a-z0-9]){_DATED}[\s\S]*?[^a-z0-9]({_OPENING}[\s\S]*)$"
#: A dated notice to the end of its paragraph, where the next one begins with an opening.
NOTICE_TO_END = rf"^([\s\S]*?)(^|[^a-z0-9]){_DATED}[\s\S]*$"
BEGINS_OPEN = rf"^[^a-z0-9]*{_OPENING}"
#: Of a line, what follows a notice, in group 1.
FROM_OPENING = rf"{_OPENS}.*)$"
_FIRST = r"^(?:[^a-z0-9©]*[^a-z0-9©(])?"
DATED_LINE = rf"{_FIRST}{_DATED}"
HOLDER_LINE = rf"{_FIRST}copyright[ \t:,]+[^\s:,]"
BODY_LINE = rf"{_FIRST}copyright\s*{_NO_HOLDER}\b"
BROKEN_HYPHEN = r"([a-z])-\s+([a-z])"
#: Texts without any of these have no notice.
SIGNS = ("copyright", "(c)", "©")
#: First words of spellings that are several words.
_ODD_WORDS = sorted({re.split("[ -]", v)[0] for v, _ in SPELLINGS if re.search("[ -].", v)})
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _spelled(text):
    """In one spelling; lines are kept."""
    for variant, usual in SPELLINGS:
        text = F.replace(text, F.lit(variant), F.lit(usual))
    return text


def _lowered(text):
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def _words_only(text):
    return F.trim(F.regexp_replace(text, NOT_WORD, " "))


def _without_notices(lowered):
    """Lines stay lines. Most texts have no sign of a notice, and are not searched for one."""
    signs = [F.contains(lowered, F.lit(sign)) for sign in SIGNS]
    paragraphs = F.split(lowered, PARAGRAPHS)

    def cleared_of(p, i):
        opens = F.coalesce(F.get(paragraphs, i + 1).rlike(BEGINS_OPEN), F.lit(False))
        here = F.when(p.rlike(NOTICE_BEFORE), F.regexp_replace(p, NOTICE_BEFORE, "$1 $3"))
        return here.when(opens, F.regexp_replace(p, NOTICE_TO_END, "$1")).otherwise(p)

    cleared = F.transform(paragraphs, cleared_of)
    lines = F.split(F.array_join(cleared, "\n\n"), "\n")

    def left(line):
        notice = line.rlike(DATED_LINE) | (line.rlike(HOLDER_LINE) & ~line.rlike(BODY_LINE))
        return F.when(notice, F.regexp_extract(line, FROM_OPENING, 1)).otherwise(line)

    return F.when(signs[0] | signs[1] | signs[2], F.array_join(F.transform(lines, left), "\n")).otherwise(lowered)


def canonical(text):
    """The canonical form of a text column; null counts as empty."""
    return _canonical(_spaced(_without_notices(_lowered(text))))


def _spaced(cleared):
    return F.regexp_replace(cleared, r"\s+", " ")


def _canonical(spaced):
    whole = F.regexp_replace(spaced, BROKEN_HYPHEN, "$1-$2")  # a line broken at a hyphen
    return _words_only(_spelled(F.when(F.contains(spaced, F.lit("- ")), whole).otherwise(spaced)))


def known_digests(
    spark: SparkSession,
    known: tuple[tuple[str, str], ...] = KNOWN,
    wholes: tuple[tuple[str, str], ...] = WHOLE_DIGESTS,
) -> DataFrame:
    """(digest, license, begins) of known texts; texts that are alike keep the first name.

    begins is the first word of the canonical form. It is null for ``wholes``, which are
    given by their digests: they are looked for as whole documents and not in lines.
    """
    rows = spark.createDataFrame(list(known), "license string, text string")
    form = canonical(F.col("text"))
    rows = rows.select(F.sha2(form, 256).alias("digest"), "license", F.substring_index(form, " ", 1).alias("begins"))
    texts = rows.groupBy("digest", "begins").agg(F.min("license").alias("license"))
    if not wholes:
        return texts
    wholes = spark.createDataFrame(list(wholes), "license string, digest string")
    wholes = wholes.groupBy("digest").agg(F.min("license").alias("license"))
    return texts.unionByName(wholes.withColumn("begins", F.lit(None).cast("string")))


def scan(
    docs: DataFrame, known: DataFrame | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, text_digest, license, notices, n_notices.

    license is that of the whole text, or null; notices lists the different
    licenses that single lines name, by name, and n_notices counts those lines.
    ``known`` has columns digest, license and begins, the first word of the canonical form;
    where that is null, only whole texts are compared.
    Rows are judged by their text alone, so null and repeated keys are as good as others.
    Null and empty texts have the digest of the empty form and no license. Texts of
    any length are read whole; other columns are not looked at; no rows give no rows.
    """
    spark = prepared(docs.sparkSession)
    known = known_digests(spark) if known is None else known
    known = stored(known, "known")
    odd_words = spark.createDataFrame([(w,) for w in _ODD_WORDS], "begins string")
    in_lines = known.filter("begins is not null")
    begins = bounded(in_lines.select("begins").union(odd_words).distinct(), "begins")
    in_lines = bounded(in_lines.select("digest", "license"), "digest", "license")
    known = known.groupBy("digest").agg(F.min("license").alias("license"))
    known = bounded(known, "digest", "license")
    content = F.col(text).cast("string")
    given = docs.select(
        F.col(key).alias("doc_id"),
        F.md5(F.coalesce(content, F.lit(""))).alias("id"),
        _lowered(content).alias("lowered"),
    )
    # One step each: what a later step names several times is computed once.
    given = given.select("doc_id", "id", _without_notices(F.col("lowered")).alias("cleared"))
    whole = given.select("doc_id", "id", _spaced(F.col("cleared")).alias("spaced"))
    digest = F.sha2(_canonical(F.col("spaced")), 256).alias("text_digest")
    whole = whole.select("doc_id", "id", digest).join(
        known, F.col("text_digest") == F.col("digest"), "left"
    )
    lines = given.select("id", F.posexplode(F.split(F.col("cleared"), "\n")).alias("at", "line"))
    # Only lines that begin as a known text does are worth a digest. A word that begins
    # another spelling of several words may become any first word.
    word = F.regexp_extract("line", _FIRST_WORD, 1)
    lines = lines.withColumn("word", word).filter("word != ''")
    odd = F.col("word").isin(*_ODD_WORDS)
    spelled = F.trim(_spelled(F.concat("word", F.lit(" "))))
    lines = lines.withColumn("word", F.when(odd, F.col("word")).otherwise(spelled))
    lines = lines.join(begins, F.col("word") == F.col("begins"))
    lines = lines.withColumn("line", F.sha2(_words_only(_spelled(F.col("line"))), 256))
    named = lines.join(in_lines, F.col("line") == F.col("digest"))
    # Copies of a text have the same lines.
    named = named.select("id", "at", "license").distinct().groupBy(F.col("id").alias("of"))
    named = named.agg(
        F.array_join(F.array_sort(F.collect_set("license")), ", ").alias("notices"),
        F.count("*").alias("n_notices"),
    )
    named = bounded(stored(named, "notices"), "of", "notices")
    return whole.join(named, F.col("id") == F.col("of"), "left").select(
        "doc_id",
        "text_digest",
        "license",
        F.coalesce("notices", F.lit("")).alias("notices"),
        F.coalesce("n_notices", F.lit(0).cast("long")).alias("n_notices"),
    )
