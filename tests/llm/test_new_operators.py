"""Audit, suffix dedup and ranked search: awkward rows, hot groups, and parts by brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from cases import ROWS, awkward, nothing

from almacen.llm import pointer_sort, ranked_search, source_audit, suffix_dedup, two_stage


@pytest.mark.parametrize("limit", [None, 8, 16])
def test_pointers_are_sorted_by_the_bytes_under_them(limit):
    draw = random.Random(4)
    for alphabet in (b"a", b"ab", bytes(range(1, 256))):
        pieces = [bytes(draw.choices(alphabet, k=draw.randint(0, 30))) for _ in range(400)]
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        sizes = np.array([len(p) for p in pieces])
        view = pointer_sort.symbols_of(data)
        order, same = pointer_sort.sort_pointers(view, np.cumsum(sizes) - sizes, sizes, limit)
        found = [pieces[i][:limit] for i in order]
        assert found == sorted(found)
        assert same.tolist() == [i > 0 and found[i] == found[i - 1] for i in range(len(found))]


@pytest.mark.parametrize("depth", [8, 16, 24])
def test_suffixes_are_sorted_in_two_stages(depth):
    draw = random.Random(5)
    for _ in range(100):
        alphabet = draw.choice([b"ab", b"a", b"abc\x00\xf4", bytes(range(97, 123))])
        pieces = [bytes(draw.choices(alphabet, k=draw.randint(1, 40))) for _ in range(draw.randint(1, 8))]
        data, ends = two_stage.joined(pieces)
        order = two_stage.suffix_array(data, ends, depth)
        end = np.repeat(ends, np.diff(np.append(-1, ends)))
        suffixes = [bytes(data[i : end[i]])[:depth] for i in order]
        assert sorted(order) == list(range(len(data))) and suffixes == sorted(suffixes)


def repeated_bytes(texts, width):
    seen = Counter(t[i : i + width] for t in texts for i in range(len(t) - width + 1))
    for text in texts:
        gone = np.zeros(len(text), dtype=bool)
        for i in range(len(text) - width + 1):
            if seen[text[i : i + width]] > 1:
                gone[i : i + width] = True
        yield gone


@pytest.mark.parametrize("most", [1, 3, 4096])
def test_suffix_dedup_removes_what_is_repeated(spark, monkeypatch, most):
    draw = random.Random(6)
    passage = "".join(draw.choices("abcd é", k=70))
    texts = ["".join(draw.choices("abcdefgh", k=draw.randint(0, 200))) for _ in range(25)]
    texts += [t[:40] + passage + t[40:] for t in texts[:12]] + [passage * 3, "x" * 300, "xy" * 20, "ab" * 11]
    texts += [None, "", "short", texts[3], texts[3]]
    plain = [(t or "").encode() for t in texts]
    monkeypatch.setattr(suffix_dedup, "MOST_SEGMENTS", most)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    rows = {r["doc_id"]: r for r in suffix_dedup.without_repeats(docs, width=24).collect()}
    assert len(rows) == len(texts)
    for i, gone in enumerate(repeated_bytes(plain, 24)):
        row = rows[i]
        mine = np.zeros(len(plain[i]), dtype=bool)
        for a, b in zip(row["from"], row["until"]):
            assert not mine[max(a - 1, 0) : b].any()
            mine[a:b] = True
        assert (mine == gone).all()
        assert bytes(row["kept"]) == bytes(np.frombuffer(plain[i], np.uint8)[~gone])
        assert row["n_bytes"] == len(plain[i])


@pytest.mark.parametrize("level", range(4))
def test_segments_cover_every_window_once_in_pieces_of_any_size(monkeypatch, level):
    draw = random.Random(7)
    texts = [bytes(draw.choices(b"ab", k=draw.choice([0, 23, 24, 300]))) for _ in range(20)] + [b"a" * 500]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    starts, counts, keys, _ = suffix_dedup._segments(data, ends, 24, level)
    windows = {}
    for start, count, key in zip(starts, counts, keys):
        for at in range(start, start + count):
            assert windows.setdefault(at, key) == key
    begins = ends - [len(t) for t in texts]
    assert sorted(windows) == [i for a, z in zip(begins, ends) for i in range(a, z - 23)]
    same = {}
    for at, key in windows.items():
        assert same.setdefault(data[at : at + 24].tobytes(), key) == key


def test_suffix_dedup_of_awkward_rows(spark):
    out = suffix_dedup.without_repeats(awkward(spark)).collect()
    assert len(out) == len(ROWS)
    rows = {r["doc_id"]: r for r in out}
    assert bytes(rows[8]["kept"]) == b"" and bytes(rows[9]["kept"]) == b" end"
    assert rows[4]["n_bytes"] == 0 and rows[4]["from"] == []
    assert bytes(rows[10]["kept"]).decode() == ROWS[12][1]
    assert suffix_dedup.without_repeats(nothing(spark)).count() == 0


def test_source_audit_of_awkward_rows(spark):
    docs = awkward(spark)
    groups = {(r[2] or "", r[3] or "") for r in ROWS}
    out = source_audit.audit(docs, least=2).collect()
    pairs = {(r["lang"], r["source"], r["item"]): r for r in out if r["part"] == "pair"}
    assert set(pairs) == {(l, s, o) for l, s in groups for m, o in groups if l == m and s != o}
    kept = {"one", "two", "three", "four", "five", "six"}
    assert {r["item"] for r in out if r["part"] == "term" and r["lang"] == "en"} <= kept
    held = [r for r in out if r["part"] == "pair" and r["lang"] == ""]
    assert {r["value"] for r in held} == {0}
    assert source_audit.audit(nothing(spark)).count() == 0


def test_source_audit_splits_languages_into_blocks(spark, monkeypatch):
    draw = random.Random(8)
    vocabulary = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)]
    rows = []
    for i in range(300):
        source = draw.choice("abcd")
        text = " ".join(draw.choices(vocabulary[ord(source) - 97 :: 2], k=30))
        rows.append((i, text, "en", source))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    monkeypatch.setattr(source_audit, "_BLOCK_CELLS", 40)
    cut = source_audit.audit(docs).collect()
    monkeypatch.undo()
    assert sorted(cut) == sorted(source_audit.audit(docs).collect())
    counts = {s: Counter() for s in "abcd"}
    for _, text, _, s in rows:
        counts[s].update(text.split())
    kept = [t for t in vocabulary if sum(t in r[1].split() for r in rows) >= 30]
    totals = {s: sum(c[t] for t in kept) for s, c in counts.items()}
    share = lambda s, t: 1 + 10**9 * (counts[s][t] + 5) // (totals[s] + 5 * len(kept))
    found = {(r["source"], r["item"]): r["value"] for r in cut if r["part"] == "pair"}
    for a in "abcd":
        for b in set("abcd") - {a}:
            assert found[a, b] == sum(abs(share(a, t) - share(b, t)) for t in kept)


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def _terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute_search(docs, items, top):
    counted = [(key, Counter(_terms(text))) for key, text in docs]
    counted = [(key, c, c.total()) for key, c in counted if c]
    n, total = len(counted), sum(x[2] for x in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    for item, text in items:
        asked = Counter(_terms(text))
        scores = []
        for key, c, size in counted:
            m = 75 + 25 * size * n // total
            score = sum(
                times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t, times in asked.items()
            )
            if score > 0:
                scores.append((-score, key is None, key or 0))
        yield item, [(None if none else key, -score) for score, none, key in sorted(scores)[:top]]


def test_ranked_search_finds_the_best_documents(spark, monkeypatch):
    draw = random.Random(9)
    vocabulary = [f"W{i}é" for i in range(60)]
    docs = [
        (draw.choice([i, i, i, None, 7]), " ".join(draw.choices(vocabulary, [1 / (k + 1) for k in range(60)], k=draw.randint(0, 40))))
        for i in range(300)
    ]
    docs += [(500 + i, "w1é w2é") for i in range(40)] + [(None, None), (8, "... !!")]
    items = [(i, ", ".join(draw.choices(vocabulary, k=draw.randint(1, 12)))) for i in range(20)]
    items += [(20, None), (21, "nothing known"), (22, "w1é W2É w1é"), (22, "w1é W2É w1é"), (None, "w5é")]
    found = {}
    monkeypatch.setattr(ranked_search, "_BLOCK_ITEMS", 7)
    shards = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string")
    for r in ranked_search.search(shards, asked, top=5).collect():
        found.setdefault(r["item_id"], {})[r["rank"]] = (r["doc_id"], r["score"])
    for item, best in brute_search(docs, dict(items).items(), 5):
        assert [found.get(item, {})[k] for k in sorted(found.get(item, {}))] == best
    assert ranked_search.search(nothing(spark), asked).count() == 0
    assert ranked_search.search(shards, asked.limit(0)).count() == 0


@pytest.mark.parametrize("leaf", [1, 3, 64])
def test_intervals_split_at_their_best_document_lose_none(monkeypatch, leaf):
    monkeypatch.setattr(ranked_search, "LEAF", leaf)
    monkeypatch.setattr(ranked_search, "_BATCH", 3)
    draw = np.random.default_rng(10)
    for _ in range(30):
        size, number = int(draw.integers(1, 200)), 12
        cells = np.flatnonzero(draw.random(size * number) < draw.choice([0.02, 0.3, 0.9]))
        document, term = np.divmod(cells, number)
        times = draw.integers(1, 6, len(cells))
        n = np.maximum(np.bincount(document, times, size).astype(np.int64), 1)
        shard = ranked_search.Shard(n, document, term, times, number, size, int(n.sum()))
        asked = np.unique(draw.integers(0, number, 5))
        weight = draw.integers(0, 4000, len(asked))
        norm = 75 + 25 * n * size // n.sum()
        impact = 10**9 * times // (1000 * times + 12 * norm[document])
        scores = np.zeros(size, dtype=np.int64)
        for t, w in zip(asked, weight):
            np.add.at(scores, document[term == t], w * impact[term == t])
        order = [i for i in np.lexsort((np.arange(size), -scores)) if scores[i] > 0][:20]
        best = ranked_search.Best(20).within(np.arange(size))
        shard.search(asked, weight, best)
        again = np.lexsort((best.keys, -best.scores))
        assert best.keys[again].tolist() == order
        assert best.scores[again].tolist() == scores[order].tolist()


def test_ranked_search_of_awkward_rows(spark):
    asked = spark.createDataFrame([(1, "ONE two", 3), (2, "漢字 ünïcode", 3)], "item_id long, text string, rank int")
    found = ranked_search.search(awkward(spark), asked).collect()
    first = [r for r in found if r["item_id"] == 1]
    assert [r["rank"] for r in first] == list(range(1, len(first) + 1)) and len(first) == 6
    assert [r["doc_id"] for r in found if r["item_id"] == 2] == [10]
