"""Texts of no learned language are rejected, also by languages with few labelled texts."""

from __future__ import annotations

import random

import duckdb
import pytest

from almacen.llm import language_id

FINNISH = "Minä olen suomalainen ja asun Helsingissä, jossa talvella sataa paljon lunta. " * 4


@pytest.mark.parametrize("each", [4, 40])
def test_gibberish_and_unlearned_texts_are_rejected(spark, each):
    rows = duckdb.sql(
        "select doc_id, text, lang from '/root/testdata/sf0.01/documents.parquet' "
        f"where len(text) > 300 qualify row_number() over (partition by lang order by doc_id) <= {each}"
    ).fetchall()
    models = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(models.langs) == 4
    draw = random.Random(1)
    for _ in range(20):
        gibberish = "".join(draw.choices("abcdefghijklmnopqrstuvwxyz   ", k=400))
        assert models.judged(gibberish)[2]
    if each == 40:
        assert models.judged(FINNISH)[2]
        assert sum(models.judged(text)[2] for _, text, _ in rows) <= 0.02 * len(rows)


def test_a_few_long_texts_do_not_use_up_the_sample(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_CHARACTERS", 30_000)
    words = "the quick brown fox jumps over a lazy dog and runs home".split()
    draw = random.Random(2)
    rows = [(i, " ".join(draw.choices(words, k=2000)), "en") for i in range(60)]
    models = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert models.usual[0] < 1  # calibrated by twelve texts
    assert models.judged("zxqvw kjhgf pqzxw vbnmk " * 20)[2]


def test_gibberish_of_a_hundred_letters_goes_and_documents_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    models = language_id.train(docs)
    draw = random.Random(3)
    share = {}
    for size in (10, 20, 40, 100, 200, 400):
        texts = ["".join(draw.choices("abcdefghijklmnopqrstuvwxyz   ", k=size)) for _ in range(50)]
        share[size] = sum(models.judged(text)[2] for text in texts) / 50
    assert [share[k] for k in (100, 200, 400)] == [1, 1, 1]
    assert sorted(share.values()) == list(share.values())
    worded = docs.filter("text rlike '[A-Za-z]'")
    # A text half of one language and half of another may lie above the limit of both.
    assert language_id.accepted(worded, models).count() >= 0.998 * worded.count()
