"""The rounds of the n-gram Jaccard join, where few columns hold most pairs."""

from __future__ import annotations

import random

from almacen.llm import jaccard_join


def test_a_group_of_near_copies_is_not_multiplied_out(spark, monkeypatch):
    """Many pairs of copies beside one group of 60: the average column is narrow, some are wide."""
    rng = random.Random(7)
    base = [f"b{i}" for i in range(200)]
    texts = []
    for i in range(60):
        words = list(base)
        words[rng.randrange(200)] = f"other{i}"
        texts.append(" ".join(words))
    for i in range(400):
        words = [f"w{i}x{j}" for j in range(200)]
        texts += [" ".join(words), " ".join(words[:-1])]
    made = []
    all_pairs = jaccard_join._Matrix.all_pairs

    def counted(self, columns):
        made.append(jaccard_join._pairs_left(columns)[1])
        return all_pairs(self, columns)

    monkeypatch.setattr(jaccard_join._Matrix, "all_pairs", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect()}
    assert found == {i: 0 if i < 60 else i - i % 2 for i in range(len(texts))}
    assert sum(made) < 30_000  # more than 70,000 are in the columns of the group


def test_hub_rounds_leave_narrow_columns_where_they_are(spark, monkeypatch):
    """Most entries are in columns of two rows; only the last round lays them out."""
    rng = random.Random(11)
    base = [f"b{i}" for i in range(200)]
    texts = []
    for i in range(60):
        words = list(base)
        words[rng.randrange(200)] = f"other{i}"
        texts.append(" ".join(words))
    for i in range(200):
        words = [f"w{i}x{j}" for j in range(200)]
        texts += [" ".join(words), " ".join(words[:-1])]
    laid_out = {"hub_pairs": [], "all_pairs": []}
    for name, rows in laid_out.items():

        def counted(self, columns, *more, method=getattr(jaccard_join._Matrix, name), rows=rows):
            rows.append(columns.count())
            return method(self, columns, *more)

        monkeypatch.setattr(jaccard_join._Matrix, name, counted)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(docs).collect()}
    assert found == {i: 0 if i < 60 else i - i % 2 for i in range(len(texts))}
    # 60 rows have some 40 first columns each in wide ones, 400 rows as many in narrow ones.
    assert laid_out["hub_pairs"] and max(laid_out["hub_pairs"]) < 4_000
    assert len(laid_out["all_pairs"]) == 1 and laid_out["all_pairs"][0] > 10_000
