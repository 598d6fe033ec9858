"""Operators against brute force and SQL where repeated rows, limits and unseen n-grams meet."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
from compare import difference, duck

from almacen.llm import language_id, queries, sql


def kneser_ney(texts):
    """Interpolated Kneser-Ney of character n-grams by its definition: p(character, context)."""
    order = language_id.ORDER
    counts = [None, *(Counter() for _ in range(order))]
    for text in texts:
        line = " " * (order - 1) + text
        for at in range(order - 1, len(line)):
            for k in range(1, order + 1):
                counts[k][line[at - k + 1 : at + 1]] += 1
    for k in range(1, order):
        before = defaultdict(set)
        for gram in counts[k + 1]:
            before[gram[1:]].add(gram[0])
        counts[k] = {gram: len(found) for gram, found in before.items()}
    discounts, totals, kinds = [0.0], [None], [None]
    for k in range(1, order + 1):
        once, twice = (sum(c == n for c in counts[k].values()) for n in (1, 2))
        discounts.append(once / (once + 2 * twice) if once and twice else 0.5)
        total, kind = Counter(), Counter()
        for gram, c in counts[k].items():
            total[gram[:-1]] += c
            kind[gram[:-1]] += 1
        totals.append(total), kinds.append(kind)

    def p(gram):
        if not gram:
            return language_id._NEW_CHARACTER
        k, context = len(gram), gram[:-1]
        if context not in totals[k]:
            return p(gram[1:])
        seen = max(counts[k].get(gram, 0) - discounts[k], 0) / totals[k][context]
        return seen + discounts[k] * kinds[k][context] / totals[k][context] * p(gram[1:])

    return p


def test_language_models_are_interpolated_kneser_ney(spark):
    english = ["the cat sat on the mat with the hat", "a cat and a rat ran", "that is the end of the tale"]
    german = ["der hund und die katze", "das ist das ende der geschichte", "die ratte rannte und rannte"]
    rows = [(i, t, "en") for i, t in enumerate(english)] + [(9 + i, t, "de") for i, t in enumerate(german)]
    models = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert models.langs == ["de", "en"]
    order = language_id.ORDER
    for lang, texts in enumerate((german, english)):
        p = kneser_ney([t + " " for t in texts])
        for text in ["the rat sat", "die katze ist da", "zebra", "the end of the cat", "ß"]:
            line = " " * (order - 1) + text + " "
            logs = [math.log(p(line[at - order + 1 : at + 1])) for at in range(order - 1, len(line))]
            found, size = models.entropies(text)
            assert size == len(logs)
            assert found[lang] == pytest.approx(-sum(logs) / size, rel=1e-5)


def test_mixing_matches_its_sql_and_meets_targets(spark):
    folder = "/root/testdata/sf0.01"
    connection = duck(folder)
    mixed = queries.op2_mixing(spark, folder)
    assert difference(mixed, connection, sql.MIXING) is None
    rows = mixed.toPandas()
    assert (rows["taken"] <= 2 * rows["size"]).all()
    for _, of in rows.groupby("source", dropna=False):
        assert abs(of["taken"].sum() - of["target"].iloc[0]) <= of["size"].max()


def test_mixing_with_documents_at_their_limit(spark, tmp_path):
    draw = random.Random(3)
    sizes = {"a": 30, "b": 400, "c": 3, None: 60}
    rows = [
        (i, " ".join(["w"] * draw.choice([0, 1, 7, 300])), source)
        for i, source in enumerate(s for s, n in sizes.items() for _ in range(n))
    ]
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "source"])
    frame.to_parquet(tmp_path / "documents.parquet")
    with duckdb.connect() as connection:
        connection.execute(f"create view documents as from '{tmp_path}/documents.parquet'")
        assert difference(queries.op2_mixing(spark, str(tmp_path)), connection, sql.MIXING) is None
    rows = queries.op2_mixing(spark, str(tmp_path)).toPandas()
    assert rows["copies"].max() == 2 and (rows["taken"] <= 2 * rows["size"]).all()
    small = rows[rows["source"] == "c"]
    assert small["taken"].sum() == 2 * small["size"].sum() == small["target"].iloc[0]


def test_metric_join_counts_equal_vectors_once_each(spark, tmp_path):
    draw = np.random.default_rng(4)
    base = draw.normal(size=(40, 5)).astype(np.float32)
    vectors = [*base, *base[:15], *base[:5], *(3 * base[:4]), *(base[:8] + 0.01)]
    frame = pd.DataFrame({"vec_id": range(len(vectors)), "embedding": [v.tolist() for v in vectors]})
    frame["embedding"] = frame["embedding"].map(lambda v: np.array(v, dtype=np.float32))
    frame.to_parquet(tmp_path / "embeddings.parquet")
    with duckdb.connect() as connection:
        connection.execute(f"create view embeddings as from '{tmp_path}/embeddings.parquet'")
        found = queries.op7_embedding_dedup(spark, str(tmp_path))
        assert difference(found, connection, sql.EMBEDDING_DEDUP) is None
