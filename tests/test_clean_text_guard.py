"""Settings and short cuts of the text cleaning."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from almacen.checks.derived import Derived
from almacen.functions import text


def test_checks_keep_generated_methods_small(spark):
    """Also in a session that was not made by ``session.configure``."""
    limit = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(limit, "65535")
    try:
        Derived(spark, "anywhere")
        assert spark.conf.get(limit) == "8000"
    finally:
        spark.conf.set(limit, "8000")


def test_clean_text_leaves_out_only_what_needs_no_cleaning(spark):
    parts = ["", " ", "  ", "a", "ñ b", "\t", "\n", "\r\n", "\x85", "\xa0", " ", "\x1f", "@", "^]", "[", "\\", "-"]
    values = ["".join(p) for p in itertools.product(parts, repeat=3)]
    rows = spark.createDataFrame([(v,) for v in [*values, None]], "v string")
    v = F.col("v")
    plain = F.trim(F.regexp_replace(F.translate(v, text.REMOVED_CHARACTERS, ""), text._WHITE_SPACE, " "))
    assert rows.filter(~text.clean_text(v).eqNullSafe(plain)).isEmpty()
