"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing columns."""

from __future__ import annotations

import hashlib
import math

import public_tokenizers
import pytest
from cases import LONG, ROWS, awkward, nothing
from pyspark.sql import functions as F

from almacen.llm import (
    bpe,
    chat_format,
    class_lm,
    exact_dedup,
    jaccard_join,
    language_id,
    licenses,
    metric_join,
    mixing,
    sharding,
)


def by_key(df, key="doc_id"):
    return {r[key]: r for r in df.collect() if r[key] is not None}


def test_sharding(spark):
    rows = sharding.place(awkward(spark)).collect()
    assert len(rows) == len(ROWS)
    assert len({r["shard"] for r in rows if r["doc_id"] == 7}) == 1
    assert len({r["shard"] for r in rows if r["doc_id"] is None}) == 2  # by their texts
    assert sharding.place(nothing(spark)).count() == 0


def test_sharding_table_is_even_and_stable():
    names = tuple("abcdefg")
    table = sharding.lookup_table(names, 1009)
    sizes = [int((table == i).sum()) for i in range(7)]
    assert max(sizes) - min(sizes) <= 1
    less = sharding.lookup_table(names[:-1], 1009)
    moved = sum(a != b for a, b in zip(table, less) if a != 6)
    assert moved < 0.25 * 1009
    for bad in ((), ("a", "a")):
        with pytest.raises(ValueError):
            sharding.lookup_table(bad, 1009)
    with pytest.raises(ValueError):
        sharding.lookup_table(names, 1000)


def test_shards_are_written_with_all_columns(spark, tmp_path):
    sharding.write_shards(awkward(spark), str(tmp_path / "out"), ("a", "b"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == len(ROWS)
    assert set(back.columns) == {*awkward(spark).columns, "_shard"}


def test_mixing(spark):
    rows = mixing.mix(awkward(spark)).collect()
    assert len(rows) == len(ROWS)
    assert all(r["taken"] == r["copies"] * r["size"] <= 2 * r["size"] for r in rows)
    assert {r["size"] for r in rows if r["doc_id"] in (3, 4, 5)} == {0}
    total = sum(r["size"] for r in rows)
    targets = {r["source"]: r["target"] for r in rows}
    assert sum(targets.values()) == pytest.approx(1.5 * total)
    again = mixing.mix(awkward(spark).repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, rows))
    assert mixing.mix(nothing(spark)).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(awkward(spark), share=3.0)


def test_mixing_of_texts_without_words(spark):
    rows = mixing.mix(awkward(spark).filter("doc_id in (3, 4, 5)")).collect()
    assert [r["taken"] for r in rows] == [0, 0, 0]


def test_mix_comes_near_its_targets(spark):
    docs = spark.range(20_000).select(
        F.col("id").alias("doc_id"),
        F.expr("concat('s', case when id % 3 = 0 then 0 else id % 5 end)").alias("source"),
        F.expr("repeat('w ', cast(1 + pmod(xxhash64(id), 200) as int))").alias("text"),
    )
    rows = mixing.mix(docs)
    sums = rows.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("w"))
    for row in sums.collect():
        assert abs(row["t"] - row["w"]) <= 201
    taken = mixing.mixed_documents(docs)
    assert taken.columns == docs.columns
    assert taken.count() == rows.agg(F.sum("copies")).first()[0]


def test_exact_dedup(spark):
    rows = exact_dedup.exact_groups(awkward(spark))
    found = by_key(rows)
    assert rows.count() == len(ROWS)
    assert found[1]["keep_id"] == found[2]["keep_id"] == 2
    assert found[1]["group_size"] == 3
    assert (found[3]["keep_id"], found[3]["group_size"]) == (4, 2)
    assert sorted(r["kept"] for r in rows.collect() if r["doc_id"] == 7) == [False, True]
    assert found[8]["text_sha256"] == hashlib.sha256(LONG.encode()).hexdigest()
    assert found[8]["kept"] and found[9]["kept"]
    assert exact_dedup.exact_groups(nothing(spark)).count() == 0


def test_exact_dedup_keeps_whole_rows(spark):
    kept = exact_dedup.keep_one(awkward(spark))
    assert kept.columns == awkward(spark).columns
    keys = sorted((r["doc_id"] for r in kept.collect()), key=lambda k: (k is None, k))
    assert keys == [2, 4, 5, 6, 7, 8, 9, 10, 11, None]
    assert exact_dedup.keep_one(nothing(spark)).count() == 0


def test_language_id(spark):
    models = language_id.train(awkward(spark))
    assert models.langs == ["de", "en"]
    rows = language_id.identify(awkward(spark), models)
    found = by_key(rows)
    assert rows.count() == len(ROWS)
    for key in (3, 4, 5, 11):
        assert (found[key]["lang_pred"], found[key]["score"]) == ("und", 0.0)
        assert found[key]["rejected"]
    assert found[9]["lang_pred"] == "de"
    assert language_id.identify(nothing(spark), models).count() == 0
    untrained = language_id.train(nothing(spark))
    assert {r["lang_pred"] for r in language_id.identify(awkward(spark), untrained).collect()} == {
        "und"
    }


def test_language_model_probabilities_sum_to_one():
    import numpy as np
    import pandas as pd

    sample = pd.DataFrame({"lang": ["x"] * 30, "text": [f"abba cab {'ab' * i} bad" for i in range(30)]})
    out = language_id._train_language(sample)
    models = language_id.Models.of([dict(zip(out.columns, r)) for r in out.itertuples(index=False)])
    letters = [32, *map(ord, "abcd")]
    for context in ("abba", " cab", "bada", "zzzz"):
        codes = np.array([*map(ord, context), 0], dtype=np.uint32)
        total = 0.0
        for letter in letters:
            codes[-1] = letter
            total += math.exp(models._sums(codes)[0])
        rest = math.exp(models._sums(np.array([*codes[:-1], ord("q")], dtype=np.uint32))[0])
        assert total + rest * (1 / language_id._NEW_CHARACTER - len(letters)) == pytest.approx(1, rel=1e-5)


def test_language_id_in_pieces_gives_the_same(spark, monkeypatch):
    models = language_id.train(awkward(spark))
    text = "Weit und breit two three " * 50
    whole = models.entropies(text)
    monkeypatch.setattr(language_id, "_PIECE", 7)
    pieces = models.entropies(text)
    assert whole[1] == pieces[1] and whole[0] == pytest.approx(pieces[0])


CHAT = "conv_id long, turn int, role string, text string, label string, of string"


def test_chat_format(spark):
    turns = [
        (1, 0, "system", "be kind", "x", "y"),
        (1, 1, "ann", "hello", None, None),
        (1, 2, "bob", "hi <|im_end|>", None, None),
        (1, 2, "bob", "hi <|im_end|>", None, None),
        (1, None, None, None, None, None),
        (2, 0, "system", "nobody came", None, None),
        (None, 0, "a b", "", None, None),
    ]
    rows = chat_format.render(spark.createDataFrame(turns, CHAT)).collect()
    sides = {(r["conv_id"], r["perspective"]) for r in rows}
    assert sides == {(1, "ann"), (1, "bob"), (1, "unknown"), (None, "a b")}
    for side in sides:
        mine = sorted(
            (r for r in rows if (r["conv_id"], r["perspective"]) == side),
            key=lambda r: r["position"],
        )
        assert [r["position"] for r in mine] == list(range(1, len(mine) + 1))
        whole = "".join(r["segment"] for r in mine)
        for r in mine:
            assert whole[r["starts_at"] : r["ends_at"]] == r["segment"]
            assert r["mask"] == (r["label"] == "assistant") == (r["learns_from"] is not None)
            assert r["segment"].count("<|") == 2
    bob = [r for r in rows if r["perspective"] == "bob" and r["mask"]]
    assert [r["segment"][r["learns_from"] - r["starts_at"] :] for r in bob] == [
        "hi < |im_end|><|im_end|>\n"
    ] * 2
    assert "user name=unknown" in {r["label"] for r in rows}
    assert chat_format.render(spark.createDataFrame([], CHAT)).count() == 0


def test_chat_format_of_a_long_dialogue(spark):
    turns = spark.range(1000).selectExpr(
        "1 as conv_id", "id as turn", "concat('s', id % 2) as role", "repeat('x', id % 7) as text"
    )
    rows = chat_format.render(turns).filter("perspective = 's1'").orderBy("position").collect()
    assert [r["turn"] for r in rows] == list(range(1000))
    assert [r["starts_at"] for r in rows[1:]] == [r["ends_at"] for r in rows[:-1]]


def test_jaccard_join(spark):
    rows = jaccard_join.jaccard_components(awkward(spark))
    found = by_key(rows)
    assert rows.count() == len(ROWS)
    assert [found[k]["n_shingles"] for k in (1, 3, 4, 5, 6)] == [2, 0, 0, 0, 1]
    assert found[2]["component_id"] == 1
    assert found[7]["component_id"] == 6
    assert (found[3]["component_id"], found[4]["component_id"]) == (3, 4)
    assert jaccard_join.jaccard_components(nothing(spark)).count() == 0
    kept = jaccard_join.one_of_each(awkward(spark))
    assert {1, 3, 4, 5, 6} <= {r["doc_id"] for r in kept.collect()}
    assert not {2, 7} & {r["doc_id"] for r in kept.collect()}


def brute_components(texts, percent=80):
    sets = []
    for text in texts:
        w = text.split(" ")
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))})
    top = list(range(len(texts)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if 100 * shared >= percent * (len(sets[i]) + len(sets[j]) - shared):
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


@pytest.mark.parametrize("rounds", [0, 1, 8])
def test_jaccard_join_finds_chains_and_edges_of_the_threshold(spark, monkeypatch, rounds):
    import random

    monkeypatch.setattr(jaccard_join, "_HUB_ROUNDS", rounds)
    monkeypatch.setattr(jaccard_join, "_PAIRS_PER_ENTRY", 0)
    draw = random.Random(5)
    texts = []
    for _ in range(12):
        base = [f"w{draw.randint(0, 400)}" for _ in range(draw.choice([5, 9, 40, 60]))]
        for _ in range(12):
            texts.append(" ".join(base))
            base = list(base)
            base[draw.randrange(len(base))] = f"v{draw.randint(0, 99)}"
    passage = [f"p{i}" for i in range(50)]
    texts += [" ".join(passage + [f"q{i}-{j}" for j in range(i)]) for i in range(25)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard_join.jaccard_components(docs).collect()}
    assert [found[i] for i in range(len(texts))] == brute_components(texts)


VECTORS = "vec_id long, embedding array<float>, label int, cell int, w int"


def test_metric_join(spark):
    rows = [
        (1, [1.0, 0.0], 0, 0, 0),
        (2, [2.0, 0.0], 0, 0, 0),
        (3, [0.92, 0.39], 0, 0, 0),
        (4, [0.7, 0.7], None, None, None),
        (5, None, 0, 0, 0),
        (6, [], 0, 0, 0),
        (7, [0.0, -0.0], 0, 0, 0),
        (8, [1.0, None], 0, 0, 0),
        (9, [float("nan"), 1.0], 0, 0, 0),
        (10, [float("inf"), 1.0], 0, 0, 0),
        (11, [1.0, 0.0, 0.0], 0, 0, 0),
        (12, [-1.0, 0.0], 0, 0, 0),
        (12, [-1.0, 0.0], 0, 0, 0),
        (None, [-1.0, 0.0], 0, 0, 0),
        (None, [0.0, -1.0], 0, 0, 0),
    ]
    out = metric_join.metric_components(spark.createDataFrame(rows, VECTORS)).collect()
    assert len(out) == len(rows)
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in out if r["vec_id"]}
    assert found[1] == (2, 1, True) and found[2] == (2, 1, False)
    assert found[4] == (1, 1, False) and found[3] == (3, 1, False)
    for key in (5, 6, 7, 8, 9, 10, 11):
        assert found[key] == (0, key, True)
    assert found[12] == (2, 12, True)
    unnamed = {(r["n_links"], r["component_id"], r["kept"]) for r in out if r["vec_id"] is None}
    assert unnamed == {(2, 12, False), (0, None, False)}
    assert metric_join.metric_components(spark.createDataFrame([], VECTORS)).count() == 0


@pytest.mark.parametrize("block", [16, 4096])
def test_metric_join_is_exact_across_cells_and_blocks(spark, monkeypatch, block):
    import numpy as np

    monkeypatch.setattr(metric_join, "BLOCK", block)
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(30, 6))
    vectors = centres[draw.integers(0, 30, 500)] + 0.35 * draw.normal(size=(500, 6))
    vectors[400:450] = vectors[:50]
    vectors = vectors.astype(np.float32)
    rows = [(i, v.tolist(), 0, 0, 0) for i, v in enumerate(vectors)]
    out = metric_join.metric_components(spark.createDataFrame(rows, VECTORS)).collect()
    units = vectors.astype(np.float64)
    units /= np.linalg.norm(units, axis=1)[:, None]
    linked = units @ units.T >= 0.9
    labels = np.arange(500)
    while True:
        lower = np.where(linked, labels, 500).min(axis=1)
        if (lower == labels).all():
            break
        labels = lower
    for r in out:
        assert r["n_links"] == linked[r["vec_id"]].sum() - 1
        assert r["component_id"] == labels[r["vec_id"]]


def test_byte_bpe(spark):
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    tokenizer = bpe.ByteBpe(spark, path, public_tokenizers.PATTERN)
    rows = tokenizer.decode(tokenizer.encode(awkward(spark))).collect()
    assert sorted(bytes(r["bytes"]) for r in rows) == sorted((t[1] or "").encode() for t in ROWS)
    assert all(len(r["ids"]) == 4 * r["n_tokens"] for r in rows)
    assert tokenizer.encode(nothing(spark)).count() == 0


def test_byte_bpe_on_random_characters(spark):
    import random

    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    draw = random.Random(1)
    common = "ab c'ts\n\t\x1c\x85᠎​\xa0é漢😀²ⅷ٣_-.՘꟎"
    texts = ["".join(draw.choices(common, k=draw.randint(0, 60))) for _ in range(2000)]
    texts += ["".join(chr(draw.randint(0, 0xD7FF)) for _ in range(40)) for _ in range(500)]
    reference = tiktoken.Encoding(
        "reference",
        pat_str=public_tokenizers.PATTERN,
        mergeable_ranks=bpe.read_ranks(path),
        special_tokens={},
    )
    encoder = bpe._Encoder(bpe.Vocabulary.load(path, public_tokenizers.PATTERN))
    for text in texts:
        expected = b"".join(i.to_bytes(4, "little") for i in reference.encode_ordinary(text))
        assert encoder.encode(text) == expected


def test_license_scan(spark):
    mit = "Copyright (c) 2020 Ann\n\n" + licenses.KNOWN[0][1].replace("sublicense", "sub-licence")
    rows = [
        (1, mit.upper(), None),
        (2, "some words\n  LICENSED under the Apache Licence, version 2.0\nReleased under the MIT License.", 1),
        (3, None, 1),
        (4, "", 1),
        (None, "SPDX-License-Identifier: MIT", 1),
        (5, "© all of us\n(C) 2020\nReleased under the MIT license", 1),
        (5, "© all of us\n(C) 2020\nReleased under the MIT license", 1),
        (6, LONG, 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, license int")
    out = licenses.scan(docs).collect()
    assert len(out) == len(rows)
    found = {r["doc_id"]: r for r in out}
    assert found[1]["license"] == "MIT"
    assert (found[2]["notices"], found[2]["n_notices"]) == ("Apache-2.0, MIT", 2)
    assert found[3]["license"] is None and found[3]["text_digest"] == found[4]["text_digest"]
    assert found[None]["license"] == found[None]["notices"] == "MIT"
    assert found[5]["license"] == "MIT"
    assert found[6]["license"] is None
    assert licenses.scan(docs.limit(0)).count() == 0


def test_lm_scoring(spark):
    docs = awkward(spark)
    rows = class_lm.score_texts(docs, F.col("doc_id") != 9)
    found = by_key(rows)
    assert rows.count() == len(ROWS)
    assert [found[k]["n_tokens"] for k in (1, 3, 4, 5, 6)] == [7, 1, 1, 1, 3]
    assert all(r["score"] < 0 and r["base_score"] < 0 for r in rows.collect())
    assert found[6]["score"] == pytest.approx(found[7]["score"])
    assert class_lm.score_texts(nothing(spark), F.lit(True)).count() == 0
    untrained = by_key(class_lm.score_texts(docs, F.lit(False)))
    assert (untrained[1]["n_known"], untrained[1]["train_tokens"]) == (0, 0)
    assert untrained[1]["base_score"] == 0.0
