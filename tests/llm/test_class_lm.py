"""The class model against its definition in plain Python, rare and unseen words included."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from almacen.llm import class_lm

CLASSES, SWEEPS = class_lm.CLASSES, class_lm.SWEEPS


def hash_and_signature(word):
    data = np.frombuffer(word.encode(), dtype=np.uint8)
    row = class_lm._hash_and_signature(data, np.array([0]), np.array([len(data)]))[0]
    return int(row[0]), int(row[1])


def f(x):
    return x * math.log(max(x, 1))


def best(bigrams, own, before, after):
    """The class with the largest gain, by its definition, cell by cell."""
    rest = [list(row) for row in bigrams]
    for c in range(CLASSES):
        rest[own][c] = max(rest[own][c] - after[c], 0)
    for c in range(CLASSES):
        rest[c][own] = max(rest[c][own] - before[c], 0)
    gains = []
    for c in range(CLASSES):
        gain = sum(f(rest[c][j] + after[j]) - f(rest[c][j]) for j in range(CLASSES))
        gain += sum(f(rest[i][c] + before[i]) - f(rest[i][c]) for i in range(CLASSES))
        row, column = sum(rest[c]), sum(rest[i][c] for i in range(CLASSES))
        gain -= f(row + sum(after)) - f(row) + f(column + sum(before)) - f(column)
        gains.append(gain)
    top = gains.index(max(gains))
    return top if gains[top] > gains[own] + 1e-9 else own


def neighbours(lines, class_of):
    """before and after of everything in the lines; a line ends, and is preceded, by the end."""
    seen = {}
    for line in lines:
        for i, token in enumerate(line):
            before, after = seen.setdefault(token, ([0] * CLASSES, [0] * CLASSES))
            before[class_of(line[i - 1])] += 1
            after[class_of(line[(i + 1) % len(line)])] += 1
    return seen


def class_bigrams(lines, class_of):
    table = [[0] * CLASSES for _ in range(CLASSES)]
    for line in lines:
        for i, token in enumerate(line):
            table[class_of(line[i - 1])][class_of(token)] += 1
    return table


def model(training):
    """log10 P(text) as a function of the words of a text."""
    lines = [[*text.split(), None] for text in training]
    counts = Counter(token for line in lines for token in line)
    often = max(2, math.ceil(class_lm.SHARE * sum(counts.values())))
    frequent = sorted((w for w, n in counts.items() if w and n >= often), key=hash_and_signature)
    number = {w: class_lm._FIRST_WORD + i for i, w in enumerate(frequent)} | {None: 0}

    def unit(token):
        return number[token] if token in number else 1 + hash_and_signature(token)[1]

    of_unit = Counter(unit(token) for line in lines for token in line)
    size = class_lm._FIRST_WORD + len(frequent)
    ranked = sorted(range(size), key=lambda u: -of_unit[u])
    classes = {u: 1 + rank % (CLASSES - 1) for rank, u in enumerate(ranked)} | {0: 0}
    in_units = [[unit(token) for token in line] for line in lines]
    for sweep in range(SWEEPS):
        seen = neighbours(in_units, classes.get)
        start, moved = class_bigrams(in_units, classes.get), {}
        for chunk in {u // class_lm._CHUNK for u in seen}:
            current = [list(row) for row in start]
            mine = [u for u in sorted(seen) if u // class_lm._CHUNK == chunk]
            for u in sorted(mine, key=lambda u: -sum(seen[u][0]) - sum(seen[u][1])):
                before, after = seen[u]
                if u and (sweep == 0 or (u + sweep) % 2):
                    new = best(current, classes[u], before, after)
                    if new != classes[u]:
                        moved[u] = new
                        for c, sign in ((classes[u], -1), (new, 1)):
                            for j in range(CLASSES):
                                current[c][j] = max(current[c][j] + sign * after[j], 0)
                            for i in range(CLASSES):
                                current[i][c] = max(current[i][c] + sign * before[i], 0)
        classes |= moved
    start = class_bigrams(in_units, classes.get)
    places = neighbours(lines, lambda token: classes[unit(token)])
    own = {
        w: best(start, classes[unit(w)], *places[w]) for w in counts if w is not None and w not in number
    }

    def class_of(token):
        return own[token] if token in own else classes[unit(token)]

    bigrams = class_bigrams(lines, class_of)
    totals = Counter()
    for w in {*counts, None}:
        totals[class_of(w)] += counts[w] + 1
    for signature in range(class_lm._SIGNATURES):
        totals[classes[1 + signature]] += 1
    every, weight = sum(totals.values()), class_lm.CLASS_WEIGHT

    def p(token, before):
        a, c = class_of(before), class_of(token)
        follows = (bigrams[a][c] + 1) / (sum(bigrams[a]) + CLASSES)
        m = counts[token] + 1
        return m * (weight * follows / totals[c] + (1 - weight) / every)

    return p, own, frequent


def sentences(seed, n):
    r = random.Random(seed)
    nouns = [f"noun{i}" for i in range(30)]
    verbs = [f"verb{i}" for i in range(20)]
    every = []
    for _ in range(n):
        text = []
        for _ in range(r.randint(0, 6)):
            text += ["the", r.choice(nouns), r.choice(verbs), f"rare{r.randint(0, 150)}"]
        every.append(" ".join(text))
    return every


@pytest.mark.parametrize("share", [class_lm.SHARE, 0.01])
def test_score_is_the_class_model(spark, monkeypatch, share):
    monkeypatch.setattr(class_lm, "SHARE", share)
    training, others = sentences(1, 60), [*sentences(2, 10), "never seen WORDS", "the the the"]
    p, own, frequent = model(training)
    assert own and frequent
    rows = [(i, t) for i, t in enumerate([*training, *others])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = {r["doc_id"]: r for r in class_lm.score_texts(docs, F.col("doc_id") < 60).collect()}
    for i, text in rows:
        line = [None, *text.lower().split(), None]
        want = sum(math.log10(p(b, a)) for a, b in zip(line, line[1:]))
        assert found[i]["score"] == pytest.approx(want, rel=1e-9), text


def test_many_words_move_as_each_alone_would():
    r = np.random.default_rng(3)
    before, after = (r.poisson(0.2, (300, CLASSES)).astype(float) for _ in range(2))
    own = r.integers(0, CLASSES, 300)
    bigrams = r.integers(50, 900, (CLASSES, CLASSES)).astype(float)
    alone = [class_lm._best_class(bigrams, int(c), b, a) for c, b, a in zip(own, before, after)]
    assert class_lm._best_classes(bigrams, own, before, after).tolist() == alone
    assert (np.array(alone) != own).any()
