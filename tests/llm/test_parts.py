"""Word hashes, Golomb codes and components against plain Python."""

from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from almacen.llm import golomb, words
from almacen.llm.components import components


@pytest.mark.parametrize("piece", [8, 64, 1 << 20])
def test_words_are_those_of_the_pattern(monkeypatch, piece):
    monkeypatch.setattr(words, "PIECE_BYTES", piece)
    draw = random.Random(1)
    texts = [None, "", "a", "A b", " x", "ab", "  ", "é ü\tß\n", "x" * 5000 + " y", "X" * 5000, "end"]
    texts += ["".join(draw.choices("abB \t\né", k=draw.randint(0, 30))) for _ in range(300)]
    found = [None] * len(texts)
    for first, hashes, bounds in words.of_texts(pa.array(texts)):
        for i in range(len(bounds) - 1):
            found[first + i] = hashes[bounds[i] : bounds[i + 1]].tolist()
    known = {}
    for text, hashes in zip(texts, found):
        expected = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        assert len(expected) == len(hashes)
        for word, h in zip(expected, hashes):
            assert known.setdefault(word.lower(), h) == h
    assert len(set(known.values())) == len(known)


def test_shingles():
    w = np.arange(1, 9, dtype=np.uint64)
    assert len(words.shingles(w, 5)) == 4
    assert len(words.shingles(w[:3], 5)) == 1
    assert len(words.shingles(w[:0], 5)) == 0
    assert words.shingles(w, 5)[1] == words.shingles(w[1:6], 5)[0]
    assert words.shingles(w[:3], 5)[0] != words.shingles(w[:4], 5)[0]


@pytest.mark.parametrize("size", [0, 1, 2, 1000])
@pytest.mark.parametrize("top", [1 << 10, 1 << 40, (1 << 64) - 1])
def test_golomb_codes_come_back(size, top):
    draw = np.random.default_rng(size)
    numbers = np.sort(draw.integers(0, top, size, dtype=np.uint64, endpoint=True))
    assert (golomb.decode(golomb.encode(numbers)) == numbers).all()


def test_golomb_codes_are_short():
    numbers = np.sort(np.random.default_rng(1).integers(0, 1 << 63, 10_000, dtype=np.uint64))
    gap_bits = 63 - np.log2(10_000)
    assert len(golomb.encode(numbers)) * 8 < 10_000 * (gap_bits + 3)


def test_components(spark):
    draw = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200 + i) for i in range(50)]
    edges += [(draw.randint(300, 340), draw.randint(300, 340)) for _ in range(30)]
    edges += [(7, 7), (None, 3), (900, 800), (800, 900)]
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            top[max(a, b)] = min(a, b)
    rows = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(rows) == len({r["node"] for r in rows})
    assert {r["node"]: r["component"] for r in rows} == {x: find(x) for x in top}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
