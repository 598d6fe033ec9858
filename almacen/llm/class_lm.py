"""Language-model scoring by class bigrams in the manner of Brown et al.

Every training word has a class of its own choice, found by exchange clustering
in two steps.

1. *Sweeps over units.* A word that makes up at least SHARE of the training tokens
   is a unit, so there are at most 1 / SHARE of these and their classes fit every
   task; all rarer words stand in under the unit of their signature (last letters
   and length), and the end of a text is a unit too. Each sweep counts, over all
   training texts, how often each unit follows and precedes each class, and moves
   units to the class that raises the likelihood of the class bigrams most.
2. *All other words.* Their neighbours' classes are summed by a shuffle on the word,
   and each word moves, from the class of its signature, by the same rule from
   its own row. This table grows with the vocabulary and is only ever joined.

The class bigrams are then counted again with every word in its own class. With
m = 1 + the training count of a word, and totals T of m by class and M of all,

    P(word | before) = m * (CLASS_WEIGHT * P(class | class before) / T(class)
                            + (1 - CLASS_WEIGHT) / M)

An unseen word has m = 1 and the class of its signature; T and M hold one such event
for each signature. So a text's score is the sum of log m, for which rare words are
joined with their counts, and of a value for each bigram of classes in it.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almacen.llm import words
from almacen.llm.stored import prepared, stored

#: Words with at least this share of the training tokens take part in the sweeps as units.
SHARE = 1e-6
CLASSES = 32
SWEEPS = 3
CLASS_WEIGHT = 0.9
_SIGNATURES = 4096
#: Unit 0 is the end of a text, then come the signatures, then the frequent words.
_FIRST_WORD = 1 + _SIGNATURES
_END = np.uint64(0x656E64206F662074)
#: Distinct words, or tokens, that a task gathers before it hands them on.
_GATHER = 1 << 19
#: Units whose counts are summed and moved together.
_CHUNK = 512

_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[ord("A") : ord("Z") + 1] += np.uint64(32)


def _hash_and_signature(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Two columns: the hash of each word and its signature."""
    out = np.empty((len(starts), 2), dtype=np.uint64)
    out[:, 0] = words.hashes(data, starts, ends)
    if len(starts):
        last, before = _LOWER[data[ends - 1]], _LOWER[data[np.maximum(ends - 2, starts)]]
        size = np.minimum(ends - starts, 12).astype(np.uint64)
        key = (last * np.uint64(256) + before) * np.uint64(16) + size
        out[:, 1] = words.mixed(key) % np.uint64(_SIGNATURES)
    return out


def _word_counts(batches) -> Iterator[pa.RecordBatch]:
    """Counts of the words of training texts, summed as far as a task holds them."""
    gathered: list[np.ndarray] = []
    held = ends = 0

    def packed():
        every = np.concatenate([np.array([[_END, 0]], dtype=np.uint64), *gathered])
        hashes, first, counts = np.unique(every[:, 0], return_index=True, return_counts=True)
        counts[hashes == _END] += ends - 1
        return pa.RecordBatch.from_pydict(
            {
                "word": pa.array(hashes.astype(np.int64), pa.int64()),
                "signature": pa.array(every[first, 1].astype(np.int32), pa.int32()),
                "n": pa.array(counts, pa.int64()),
            }
        )

    for batch in batches:
        ends += batch.num_rows
        for _, rows, _ in words.of_texts(batch.column(0), _hash_and_signature):
            gathered.append(rows)
            held += len(rows)
        if held >= 4 * _GATHER:
            yield packed()
            gathered, held, ends = [], 0, 0
    if ends:
        yield packed()


@dataclass
class Units:
    """The bounded part of the model: what is known for each unit."""

    frequent: np.ndarray  # sorted hashes of the frequent words
    counts: np.ndarray  # training tokens of each unit
    often: int  # a word with so many training tokens is a unit
    tokens: int
    distinct: int

    def of(self, rows: np.ndarray) -> np.ndarray:
        """The units of words given by hash and signature."""
        at = np.searchsorted(self.frequent, rows[:, 0])
        at = np.minimum(at, max(len(self.frequent) - 1, 0))
        known = self.frequent[at] == rows[:, 0] if len(self.frequent) else np.zeros(len(rows), bool)
        return np.where(known, _FIRST_WORD + at, 1 + rows[:, 1].astype(np.int64))


def _units_of(vocabulary: DataFrame) -> Units:
    end = F.lit(int(_END.astype(np.int64)))
    tokens, distinct = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    often = max(2, math.ceil(SHARE * tokens))
    plain = vocabulary.filter(F.col("word") != end)
    ends = vocabulary.filter(F.col("word") == end).agg(F.sum("n")).first()[0] or 0
    frequent = plain.filter(F.col("n") >= often).select("word", "n").toPandas()
    hashes = frequent["word"].to_numpy(dtype=np.int64).astype(np.uint64)
    order = np.argsort(hashes)
    rare_tokens = np.zeros(_SIGNATURES, dtype=np.int64)
    rare = plain.filter(F.col("n") < often).groupBy("signature")
    for signature, n in rare.agg(F.sum("n")).collect():
        rare_tokens[signature] = n
    counts = np.concatenate([[ends], rare_tokens, frequent["n"].to_numpy(np.int64)[order]])
    return Units(hashes[order], counts, often, int(tokens), int(distinct))


def _is_rare(line: np.ndarray) -> np.ndarray:
    return (line > 0) & (line < _FIRST_WORD)


def _encoded(batches, units) -> Iterator[pa.RecordBatch]:
    """Each text as units, with its rare words apart.

    ``rare`` lists the text's different rare words, ``times`` how often each occurs, and
    ``spots`` the place in that list of each rare token, in the order of the text.
    """
    units = units.value
    task = TaskContext.get().partitionId() << 40
    logs = np.log10(units.counts + 1.0)
    done = 0
    for batch in batches:
        sizes, packed, known, own, rare, times, spots = [], [], [], [], [], [], []
        for _, rows, bounds in words.of_texts(batch.column(2), _hash_and_signature):
            unit = units.of(rows)
            for i, j in zip(bounds[:-1], bounds[1:]):
                text = np.append(unit[i:j], 0)
                single = text[~_is_rare(text)]
                sizes.append(j - i + 1)
                packed.append(text.astype("<i4").tobytes())
                known.append(int((units.counts[single] > 0).sum()))
                own.append(float(logs[single].sum()))
                hashes, places, n = np.unique(
                    rows[i:j, 0][_is_rare(unit[i:j])], return_inverse=True, return_counts=True
                )
                rare.append(hashes.astype(np.int64))
                times.append(n)
                spots.append(places.astype("<i4").tobytes())
        cuts = pa.array(np.cumsum([0] + [len(r) for r in rare], dtype=np.int32))
        flat = [np.concatenate([np.empty(0, np.int64), *x]) for x in (rare, times)]
        yield pa.RecordBatch.from_pydict(
            {
                "row": pa.array(np.arange(done, done + batch.num_rows) + task, pa.int64()),
                "key": batch.column(0),
                "trains": batch.column(1),
                "n_tokens": pa.array(sizes, pa.int64()),
                "units": pa.array(packed, pa.binary()),
                "known": pa.array(known, pa.int64()),
                "own": pa.array(own, pa.float64()),
                "rare": pa.ListArray.from_arrays(cuts, pa.array(flat[0])),
                "times": pa.ListArray.from_arrays(cuts, pa.array(flat[1])),
                "spots": pa.array(spots, pa.binary()),
            }
        )
        done += batch.num_rows


def _chunked(table: np.ndarray, first: int) -> Iterator[pa.RecordBatch]:
    """A table by unit in chunks of units; chunks without counts are left out."""
    for start in range(0, len(table), _CHUNK):
        part = table[start : start + _CHUNK]
        if part.any():
            yield pa.RecordBatch.from_pydict(
                {
                    "chunk": pa.array([start // _CHUNK], pa.int32()),
                    "task": pa.array([first], pa.int64()),
                    "cells": pa.array([zlib.compress(part.tobytes(), 1)], pa.binary()),
                }
            )


_CELLS = "chunk int, task long, cells binary"


def _neighbours(batches, classes) -> Iterator[pa.RecordBatch]:
    """For each unit, how often each class comes before it and how often after it."""
    classes = classes.value
    size = len(classes)
    table = np.zeros((size, 2 * CLASSES), dtype=np.int64)
    gathered: list[np.ndarray] = []
    held = 0

    def count():
        line = np.concatenate([np.zeros(1, dtype=np.int64), *gathered])
        before = line[1:] * CLASSES + classes[line[:-1]]
        after = line[:-1] * CLASSES + classes[line[1:]]
        table[:, :CLASSES] += np.bincount(before, minlength=size * CLASSES).reshape(size, -1)
        table[:, CLASSES:] += np.bincount(after, minlength=size * CLASSES).reshape(size, -1)

    for batch in batches:
        for text in batch.column(0).to_pylist():
            gathered.append(np.frombuffer(text, dtype="<i4").astype(np.int64))
            held += len(gathered[-1])
            if held >= 4 * _GATHER:
                count()
                gathered, held = [], 0
    if gathered:
        count()
    yield from _chunked(table, TaskContext.get().partitionId())


def _summed(parts: pd.DataFrame) -> pd.DataFrame:
    total = None
    for cells in parts["cells"]:
        table = np.frombuffer(zlib.decompress(cells), dtype=np.int64)
        total = table if total is None else total + table
    return parts[["chunk", "task"]].head(1).assign(cells=zlib.compress(total.tobytes(), 1))


def _table_of(cells: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(cells), dtype=np.int64).reshape(-1, 2 * CLASSES)


def _class_counts(batches, classes) -> Iterator[pa.RecordBatch]:
    """Bigrams of classes in a chunk: rows are the class before."""
    classes = classes.value
    for batch in batches:
        out = []
        for chunk, cells in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            table = _table_of(cells)
            own = classes[chunk * _CHUNK : chunk * _CHUNK + len(table)]
            bigrams = np.zeros((CLASSES, CLASSES), dtype=np.int64)
            np.add.at(bigrams.T, own, table[:, :CLASSES])
            out.append(bigrams.tobytes())
        yield pa.RecordBatch.from_pydict({"bigrams": pa.array(out, pa.binary())})


def _n_log_n(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def _best_class(bigrams: np.ndarray, own: int, before: np.ndarray, after: np.ndarray) -> int:
    """The class that the likelihood of the class bigrams wants a unit in.

    Bigrams of the unit with itself are counted with the class it comes from.
    """
    rest = bigrams.copy()
    rest[own] = np.maximum(rest[own] - after, 0)
    rest[:, own] = np.maximum(rest[:, own] - before, 0)
    rows, columns = rest.sum(axis=1), rest.sum(axis=0)
    gain = (_n_log_n(rest + after) - _n_log_n(rest)).sum(axis=1)
    gain += (_n_log_n(rest + before[:, None]) - _n_log_n(rest)).sum(axis=0)
    gain -= _n_log_n(rows + after.sum()) - _n_log_n(rows)
    gain -= _n_log_n(columns + before.sum()) - _n_log_n(columns)
    best = int(gain.argmax())
    return best if gain[best] > gain[own] + 1e-9 else own


def _exchanged(batches, classes, bigrams: np.ndarray, sweep: int) -> Iterator[pa.RecordBatch]:
    """New classes of the units of each chunk.

    Half of the units may move in a sweep, so that neighbours don't swap for ever;
    a chunk takes its own moves into account, and those of others in the next sweep.
    """
    classes = classes.value
    for batch in batches:
        units, found = [], []
        for chunk, cells in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            current = bigrams.astype(np.float64)
            table = _table_of(cells).astype(np.float64)
            for i in np.argsort(-table.sum(axis=1), kind="stable"):
                unit = chunk * _CHUNK + int(i)
                before, after = table[i, :CLASSES], table[i, CLASSES:]
                moves = sweep == 0 or (unit + sweep) % 2
                if unit and moves and before.any():
                    own = int(classes[unit])
                    new = _best_class(current, own, before, after)
                    if new != own:
                        for c, sign in ((own, -1.0), (new, 1.0)):
                            current[c] = np.maximum(current[c] + sign * after, 0)
                            current[:, c] = np.maximum(current[:, c] + sign * before, 0)
                        units.append(unit)
                        found.append(new)
        yield pa.RecordBatch.from_pydict(
            {"unit": pa.array(units, pa.int64()), "class": pa.array(found, pa.int32())}
        )


def _clustered(texts: DataFrame, units: Units, sweeps: int) -> tuple[np.ndarray, np.ndarray]:
    """The class of each unit, and the bigrams of classes in the training texts."""
    sc = texts.sparkSession.sparkContext
    rank = np.empty(len(units.counts), dtype=np.int64)
    rank[np.argsort(-units.counts, kind="stable")] = np.arange(len(rank))
    classes = 1 + rank % (CLASSES - 1)
    classes[0] = 0  # the end has a class of its own, which others may join
    trains = texts.filter("trains").select("units")
    tasks = max(1, trains.rdd.getNumPartitions())
    salts = max(1, math.isqrt(tasks))
    for sweep in range(sweeps + 1):
        shared = sc.broadcast(classes)
        parts = trains.mapInArrow(lambda b, c=shared: _neighbours(b, c), _CELLS)
        salted = parts.groupBy("chunk", F.pmod("task", F.lit(salts)))
        cells = salted.applyInPandas(_summed, _CELLS).groupBy("chunk")
        cells = stored(cells.applyInPandas(_summed, _CELLS), "cells")
        bigrams = np.zeros((CLASSES, CLASSES), dtype=np.int64)
        counted = cells.mapInArrow(lambda b, c=shared: _class_counts(b, c), "bigrams binary")
        for row in counted.toLocalIterator():
            bigrams += np.frombuffer(row[0], dtype=np.int64).reshape(CLASSES, CLASSES)
        if sweep < sweeps:
            moved = cells.repartition("chunk").mapInArrow(
                lambda b, c=shared, m=bigrams, s=sweep: _exchanged(b, c, m, s),
                "unit long, class int",
            )
            moved = moved.toPandas()
            classes = classes.copy()
            classes[moved["unit"].to_numpy(np.int64)] = moved["class"].to_numpy(np.int64)
    return classes, bigrams


def _rare_places(batches, classes) -> Iterator[pa.RecordBatch]:
    """How often each rare word stands between two classes, summed as far as a task holds them."""
    classes = classes.value
    gathered: list[np.ndarray] = []
    held = 0

    def packed():
        every = np.concatenate(gathered)
        every = every[np.lexsort((every[:, 1], every[:, 0]))]
        first = np.flatnonzero(np.append(True, (every[1:] != every[:-1]).any(axis=1)))
        return pa.RecordBatch.from_pydict(
            {
                "word": pa.array(every[first, 0], pa.int64()),
                "place": pa.array(every[first, 1].astype(np.int32), pa.int32()),
                "n": pa.array(np.diff(np.append(first, len(every))), pa.int64()),
            }
        )

    for batch in batches:
        bounds = np.append(0, np.cumsum(batch.column(2).value_lengths().to_numpy()))
        hashes = batch.column(2).flatten().to_numpy()
        for i, (text, spots) in enumerate(zip(*(batch.column(k).to_pylist() for k in (0, 1)))):
            line = np.frombuffer(text, dtype="<i4")
            at = np.flatnonzero(_is_rare(line))
            if len(at):
                own = classes[line]
                # A text ends with its end, which also stands before its first word.
                place = own[at - 1] * CLASSES + own[at + 1]
                rare = hashes[bounds[i] : bounds[i + 1]][np.frombuffer(spots, dtype="<i4")]
                gathered.append(np.column_stack([rare, place]))
                held += len(at)
            if held >= 2 * _GATHER:
                yield packed()
                gathered, held = [], 0
    if held:
        yield packed()


def _best_classes(
    bigrams: np.ndarray, own: np.ndarray, before: np.ndarray, after: np.ndarray
) -> np.ndarray:
    """As ``_best_class``, for many words: one row each of before and after."""
    gain = np.zeros((len(own), CLASSES))
    every = np.arange(len(own))
    for table, here, across in ((bigrams, after, before), (bigrams.T, before, after)):
        word, beside = np.nonzero(here)
        n = here[word, beside]
        rest = table[:, beside].T.copy()
        rest[np.arange(len(word)), own[word]] -= n
        self_side = beside == own[word]
        rest[self_side] -= across[word[self_side]]
        rest = np.maximum(rest, 0)
        more = _n_log_n(rest + n[:, None]) - _n_log_n(rest)
        first = np.flatnonzero(np.diff(word, prepend=-1))
        if len(first):
            gain[word[first]] += np.add.reduceat(more, first)
        size = here.sum(axis=1)
        totals = table.sum(axis=1) - across
        totals[every, own] -= size
        totals = np.maximum(totals, 0)
        gain -= _n_log_n(totals + size[:, None]) - _n_log_n(totals)
    best = gain.argmax(axis=1)
    return np.where(gain[every, best] > gain[every, own] + 1e-9, best, own)


def _moved(batches, classes, bigrams: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The class of each rare word, from the places it stands in."""
    classes, bigrams = classes.value, bigrams.astype(np.float64)
    for batch in batches:
        own = classes[1 + batch.column(1).to_numpy()]
        lengths = batch.column(3).value_lengths().to_numpy()
        word = np.repeat(np.arange(batch.num_rows), lengths)
        seen = batch.column(3).flatten()
        place = seen.field("place").to_numpy().astype(np.int64)
        n = seen.field("n").to_numpy().astype(np.float64)
        size = batch.num_rows * CLASSES
        before = np.bincount(word * CLASSES + place // CLASSES, n, minlength=size)
        after = np.bincount(word * CLASSES + place % CLASSES, n, minlength=size)
        found = _best_classes(bigrams, own, before.reshape(-1, CLASSES), after.reshape(-1, CLASSES))
        yield pa.RecordBatch.from_pydict(
            {"word": batch.column(0), "n": batch.column(2), "class": pa.array(found, pa.int32())}
        )


def _rare_classes(texts: DataFrame, rare: DataFrame, classes, bigrams: np.ndarray) -> DataFrame:
    """word, n and class of every rare training word."""
    trains = texts.filter("trains").select("units", "spots", "rare")
    places = trains.mapInArrow(lambda b: _rare_places(b, classes), "word long, place int, n long")
    # One shuffle, on the word, serves both sums; a rare word has few rows, and CLASSES squared places.
    places = places.repartition("word").groupBy("word", "place").agg(F.sum("n").alias("n"))
    places = places.groupBy("word").agg(F.collect_list(F.struct("place", "n")).alias("places"))
    words_with = rare.join(places, "word").select("word", "signature", "n", "places")
    return stored(
        words_with.mapInArrow(lambda b: _moved(b, classes, bigrams), "word long, n long, class int"),
        "rare",
    )


def _classed(batches, classes) -> Iterator[pa.RecordBatch]:
    """The class of each token of a text, rare words in their own."""
    classes = classes.value
    for batch in batches:
        lines = []
        columns = [batch.column(k).to_pylist() for k in (0, 1)]
        bounds = np.append(0, np.cumsum(batch.column(2).fill_null([]).value_lengths().to_numpy()))
        known = batch.column(2).flatten().to_numpy()
        for i, (text, spots) in enumerate(zip(*columns)):
            line = np.frombuffer(text, dtype="<i4")
            own = classes[line]
            spots = np.frombuffer(spots, dtype="<i4")
            mine = known[bounds[i] : bounds[i + 1]]
            if len(mine):
                of_spot = np.full(int(spots.max()) + 1, -1)
                of_spot[mine // CLASSES] = mine % CLASSES
                found, at = of_spot[spots], np.flatnonzero(_is_rare(line))
                own[at] = np.where(found >= 0, found, own[at])
            lines.append(own.astype(np.uint8).tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(lines, pa.binary()), *batch.columns[3:]],
            names=["classes", *batch.schema.names[3:]],
        )


def _pairs(line: bytes) -> np.ndarray:
    """How often each class follows each class; the end stands before the first word."""
    own = np.frombuffer(line, dtype=np.uint8).astype(np.int64)
    before = np.append(own[-1], own[:-1])
    return np.bincount(before * CLASSES + own, minlength=CLASSES * CLASSES)


def _pair_counts(batches) -> Iterator[pa.RecordBatch]:
    total = np.zeros(CLASSES * CLASSES, dtype=np.int64)
    for batch in batches:
        for line in batch.column(0).to_pylist():
            total += _pairs(line)
    yield pa.RecordBatch.from_pydict(
        {"place": pa.array(np.arange(len(total)), pa.int32()), "n": pa.array(total, pa.int64())}
    )


def _values(classed: DataFrame, rare: DataFrame, units: Units, classes: np.ndarray) -> np.ndarray:
    """log10 of what the model adds to log m for each bigram of classes."""
    seen = np.zeros(CLASSES * CLASSES, dtype=np.int64)
    counted = classed.filter("trains").select("classes").mapInArrow(_pair_counts, "place int, n long")
    for place, n in counted.groupBy("place").agg(F.sum("n")).collect():
        seen[place] = n
    bigrams = seen.reshape(CLASSES, CLASSES)
    mass = units.counts + 1.0
    mass[1:_FIRST_WORD] = 1.0  # the unseen words of a signature; its seen ones follow
    totals = np.bincount(classes, mass, minlength=CLASSES)
    for own, m in rare.groupBy("class").agg(F.sum(F.col("n") + 1)).collect():
        totals[own] += m
    after = (bigrams + 1.0) / (bigrams.sum(axis=1)[:, None] + CLASSES)
    in_class = np.divide(after, totals, out=np.zeros_like(after), where=totals > 0)
    return np.log10(CLASS_WEIGHT * in_class + (1 - CLASS_WEIGHT) / totals.sum()).ravel()


def _ordered(batches, values: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums = [float(_pairs(line) @ values) for line in batch.column(0).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(sums, pa.float64()), *batch.columns[1:]],
            names=["ordered", *batch.schema.names[1:]],
        )


def score_texts(
    docs: DataFrame, trains, key: str = "doc_id", text: str = "text", sweeps: int = SWEEPS
) -> DataFrame:
    """One row for each row of ``docs``: key, n_tokens, n_known, train_tokens, base_score, score.

    ``trains`` is a boolean column of docs: the model learns from those rows. A token
    is a word (A-Z lower-cased) or the end of the text; null and empty texts have
    their end only. base_score is the add-one unigram log10 probability of the tokens,
    score that of the class model. Without training texts all counts are 0. Repeated
    rows count as often as they occur; keys may be null or repeated; texts of any
    length are read whole; other columns are not looked at; no rows give no rows.
    """
    spark = prepared(docs.sparkSession)
    given = docs.select(
        F.col(key).alias("key"), F.coalesce(trains, F.lit(False)).alias("trains"), F.col(text).alias("text")
    )
    counts = given.filter("trains").select("text")
    counts = counts.mapInArrow(_word_counts, "word long, signature int, n long").groupBy("word")
    vocabulary = stored(counts.agg(F.min("signature").alias("signature"), F.sum("n").alias("n")), "words")
    units = _units_of(vocabulary)
    shared = spark.sparkContext.broadcast(units)
    kind = given.schema["key"].dataType.simpleString()
    texts = stored(
        given.mapInArrow(
            lambda b: _encoded(b, shared),
            f"row long, key {kind}, trains boolean, n_tokens long, units binary, known long, "
            "own double, rare array<long>, times array<long>, spots binary",
        ),
        "texts",
    )
    classes, bigrams = _clustered(texts, units, sweeps)
    of_unit = spark.sparkContext.broadcast(classes)
    plain = F.col("word") != F.lit(int(_END.astype(np.int64)))
    rare = vocabulary.filter(plain & (F.col("n") < units.often))
    rare = _rare_classes(texts, rare, of_unit, bigrams)
    seen = texts.select("row", "times", F.posexplode("rare").alias("spot", "word"))
    seen = seen.withColumn("times", F.col("times")[F.col("spot")]).join(rare, "word").groupBy("row")
    seen = seen.agg(
        F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rare_logs"),
        F.sum("times").alias("rare_known"),
        F.collect_list(F.col("spot") * CLASSES + F.col("class")).alias("found"),
    )
    joined = texts.drop("rare", "times").join(seen, "row", "left").select(
        "units",
        "spots",
        "found",
        "key",
        "trains",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0).cast("long"))).alias("n_known"),
        (F.col("own") + F.coalesce("rare_logs", F.lit(0.0))).alias("logs"),
    )
    numbers = f"key {kind}, trains boolean, n_tokens long, n_known long, logs double"
    classed = stored(
        joined.mapInArrow(lambda b: _classed(b, of_unit), f"classes binary, {numbers}"), "classed"
    )
    values = _values(classed, rare, units, classes)
    each = math.log10(units.tokens + (units.distinct + 1))
    return classed.mapInArrow(lambda b: _ordered(b, values), f"ordered double, {numbers}").select(
        F.col("key").alias(key),
        "n_tokens",
        "n_known",
        F.lit(units.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * F.lit(each)).alias("base_score"),
        (F.col("logs") + F.col("ordered")).alias("score"),
    )
