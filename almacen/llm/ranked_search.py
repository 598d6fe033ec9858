"""Ranked lexical search over intervals of documents with range-maximum tables.

Documents are split into terms once; only terms of the queries are kept, as
numbers. A task gathers postings of a shard of documents: for each term its
documents in ascending order with their impacts, and above them a sparse table
that gives the posting of greatest impact in any range with two look-ups.

A query starts with one interval, the whole shard. The bound of an interval is the
sum over the terms of their greatest impact in it. Intervals are taken best first,
a batch at a time: the document of the greatest single impact is scored and
splits its interval in two, each with a bound of its own. Intervals of few
documents are scored whole, those whose bound lies below the best results so far are
left. A task keeps each query's best results from one shard to the next, so later
shards start with a high bar, and hands on only these.

Queries go through in blocks of bounded size, each against all documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almacen.llm import terms, words
from almacen.llm.stored import prepared, stored

TOP = 20
#: Postings of a shard; its tables take about 100 bytes for each.
SHARD_POSTINGS = 1 << 20
#: Intervals of so many documents are scored whole; intervals looked at together.
LEAF = 64
_BATCH = 256
#: Different terms, and results, of the queries that are looked up together.
_BLOCK_TERMS = 1 << 18
_BLOCK_ITEMS = 1 << 12
_WORST = np.iinfo(np.int64).max


def _term_counts(texts: pa.Array) -> Iterator[np.ndarray]:
    """The term hashes of each text."""
    for _, found, bounds in words.of_texts(terms.folded(texts, terms.LETTERS_AND_DIGITS)):
        for i, j in zip(bounds[:-1], bounds[1:]):
            yield found[i:j]


def _queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [t.view(np.int64) for t in _term_counts(batch.column(1))]
        kind = pa.list_(pa.int64())
        yield pa.RecordBatch.from_pydict({"item": batch.column(0), "terms": pa.array(found, kind)})


def _postings(batches: Iterator[pa.RecordBatch], vocabulary) -> Iterator[pa.RecordBatch]:
    """For each document with terms: how many, and which of the vocabulary how often."""
    known = vocabulary.value
    for batch in batches:
        texts = terms.folded(batch.column(1), terms.LETTERS_AND_DIGITS)
        parts = []
        for first, found, bounds in words.of_texts(texts):
            at = np.minimum(np.searchsorted(known, found), len(known) - 1)
            place = np.flatnonzero(known[at] == found)
            document = np.searchsorted(bounds, place, side="right") - 1
            cells, times = np.unique(document * len(known) + at[place], return_counts=True)
            document, term = np.divmod(cells, len(known))
            parts.append((np.diff(bounds), document + first, term, times))
        if not parts:
            continue
        n, document, term, times = (np.concatenate(x) for x in zip(*parts))
        bounds = np.append(np.searchsorted(document, np.arange(len(n))), len(document)).astype(np.int32)
        rows = pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column(0),
                "n": pa.array(n, pa.int64()),
                "terms": pa.ListArray.from_arrays(pa.array(bounds), pa.array(term, pa.int32())),
                "times": pa.ListArray.from_arrays(pa.array(bounds), pa.array(times, pa.int32())),
            }
        )
        yield rows.filter(pa.array(n > 0))


class Shard:
    """Postings of some documents by term and document, and their range-maximum table."""

    def __init__(self, n: np.ndarray, document, term, times, number: int, documents: int, total: int):
        """``document`` numbers lie in the order of results with equal scores."""
        order = np.lexsort((document, term))
        self.size = len(n)
        self.document, times = document[order], times[order].astype(np.int64)
        self.bounds = np.searchsorted(term[order], np.arange(number + 1))
        norm = 100 - 25 + (25 * n * documents) // max(total, 1)
        self.impact = (1_000_000_000 * times) // (1000 * times + 12 * norm[self.document])
        #: In row k the place of the greatest impact of 2^k postings from each place on.
        longest = int(np.diff(self.bounds).max(initial=0))
        best = np.arange(len(order), dtype=np.int32)
        self.table = [best]
        for k in range(1, longest.bit_length()):
            half = 1 << (k - 1)
            a, b = best[:-half], best[half:]
            best = np.where(self.impact[a] >= self.impact[b], a, b)
            self.table.append(best)
        # Rows of one length, so that one look-up takes places of all rows.
        self.row = np.cumsum([0] + [len(t) for t in self.table])
        self.table = np.concatenate(self.table)

    def greatest(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Place of the greatest impact in each range of postings; ranges are not empty."""
        k = np.frexp((high - low).astype(np.float64))[1] - 1
        left = self.table[self.row[k] + low]
        right = self.table[self.row[k] + high - (1 << k)]
        return np.where(self.impact[left] >= self.impact[right], left, right)

    def search(self, term: np.ndarray, weight: np.ndarray, best: Best) -> None:
        """Offer to ``best`` all documents that may be among the best for a query."""
        some = self.bounds[term + 1] > self.bounds[term]
        term, weight = term[some], weight[some]
        if not len(term):
            return
        open_ones = self._bounded(
            np.zeros(1, np.int64),
            np.full(1, self.size),
            self.bounds[term][None, :],
            self.bounds[term + 1][None, :],
            weight,
        )
        while len(open_ones[0]):
            start, stop, low, high, bound, split = open_ones
            keep = bound >= best.bar
            if not keep.all():
                start, stop, low, high, bound, split = (x[keep] for x in open_ones)
            if not len(start):
                return
            first = np.arange(len(bound))
            if len(bound) > _BATCH:
                first = np.argpartition(-bound, _BATCH)
                rest, first = first[_BATCH:], first[:_BATCH]
                later = [x[rest] for x in (start, stop, low, high, bound, split)]
            else:
                later = [x[:0] for x in (start, stop, low, high, bound, split)]
            small = first[stop[first] - start[first] <= LEAF]
            self._score(start[small], stop[small], low[small], high[small], weight, best)
            wide = first[stop[first] - start[first] > LEAF]
            parts = [later]
            if len(wide):
                at = split[wide]
                inside, after = self._places(low[wide], high[wide], at)
                self._score(at, at + 1, inside, after, weight, best)
                for part in (
                    (start[wide], at, low[wide], inside),
                    (at + 1, stop[wide], after, high[wide]),
                ):
                    parts.append(self._bounded(*part, weight))
            open_ones = [np.concatenate(x) for x in zip(*parts)]

    def _bounded(self, start, stop, low, high, weight) -> list[np.ndarray]:
        """Intervals with the bound of their scores and the document that splits them."""
        held = high > low
        impact = np.zeros(low.shape, dtype=np.int64)
        document = np.zeros(low.shape, dtype=np.int64)
        place = self.greatest(low[held], high[held])
        impact[held], document[held] = self.impact[place], self.document[place]
        impact *= weight
        bound = impact.sum(axis=1)
        split = document[np.arange(len(low)), impact.argmax(axis=1)]
        keep = bound > 0
        return [x[keep] for x in (start, stop, low, high, bound, split)]

    def _places(self, low, high, at) -> tuple[np.ndarray, np.ndarray]:
        """Where a document's postings begin and end within ranges of postings, by bisection."""
        a, b = low.copy(), high.copy()
        at = at[:, None]
        for _ in range(int((high - low).max(initial=0)).bit_length()):
            middle = (a + b) >> 1
            below = (a < b) & (self.document[np.minimum(middle, len(self.document) - 1)] < at)
            a, b = np.where(below, middle + 1, a), np.where(below | (a >= b), b, middle)
        there = (a < high) & (self.document[np.minimum(a, len(self.document) - 1)] == at)
        return a, a + there

    def _score(self, start, stop, low, high, weight, best: Best) -> None:
        """Scores of all documents of some intervals."""
        if not len(start):
            return
        widths = stop - start
        offset = np.cumsum(widths) - widths
        sizes = (high - low).ravel()
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(low.ravel() - ends + sizes, sizes)
        interval, term = np.divmod(np.repeat(np.arange(len(sizes)), sizes), low.shape[1])
        place = self.document[at] - start[interval] + offset[interval]
        # Whole numbers below 2^53, so doubles add them exactly.
        scores = np.bincount(place, (weight[term] * self.impact[at]).astype(np.float64), offset[-1] + widths[-1])
        scores = scores.astype(np.int64)
        good = np.flatnonzero((scores > 0) & (scores >= best.bar))
        interval = np.searchsorted(offset, good, side="right") - 1
        best.offer(scores[good], good - offset[interval] + start[interval])


class Best:
    """The best documents of one query so far; of equal scores those with smaller keys."""

    def __init__(self, top: int):
        self.top = top
        self.scores = np.empty(0, dtype=np.int64)
        self.keys = np.empty(0, dtype=np.int64)
        self.bar = 1
        self._names: np.ndarray | None = None

    def within(self, names: np.ndarray) -> Best:
        """From now on documents are offered by their place in ``names``."""
        self._names = names
        return self

    def offer(self, scores: np.ndarray, places: np.ndarray) -> None:
        if not len(scores):
            return
        self.scores = np.append(self.scores, scores)
        self.keys = np.append(self.keys, self._names[places])
        if len(self.scores) > self.top:
            order = np.lexsort((self.keys, -self.scores))[: self.top]
            self.scores, self.keys = self.scores[order], self.keys[order]
            self.bar = max(1, int(self.scores[-1]))


@dataclass
class Block:
    """Queries that are looked up together: item keys, their terms and how often, weights of all terms."""

    items: list
    terms: list[np.ndarray]
    times: list[np.ndarray]
    weights: np.ndarray
    documents: int
    total: int
    top: int


def _found(batches: Iterator[pa.RecordBatch], block) -> Iterator[pa.RecordBatch]:
    """Each query's best documents among those of a task."""
    block = block.value
    best = [Best(block.top) for _ in block.items]
    weights = [block.weights[t] * times for t, times in zip(block.terms, block.times)]
    held, size = [], 0

    def search() -> None:
        rows = pa.Table.from_batches(held).combine_chunks()
        keys = rows.column(0).combine_chunks().fill_null(_WORST).to_numpy()
        order = np.argsort(keys, kind="stable")
        rank = np.empty(len(order), dtype=np.int64)
        rank[order] = np.arange(len(order))
        term, times = (rows.column(i).combine_chunks() for i in (2, 3))
        document = np.repeat(rank, pa.compute.list_value_length(term).to_numpy())
        n = rows.column(1).combine_chunks().to_numpy()[order]
        shard = Shard(
            n,
            document,
            term.flatten().to_numpy(),
            times.flatten().to_numpy(),
            len(block.weights),
            block.documents,
            block.total,
        )
        for i, found in enumerate(best):
            shard.search(block.terms[i], weights[i], found.within(keys[order]))

    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            part = batch.slice(start, 64)
            held.append(part)
            size += len(part.column(2).flatten())
            if size >= SHARD_POSTINGS:
                search()
                held, size = [], 0
    if held:
        search()
    for i, found in enumerate(best):
        keys = pa.array(found.keys, mask=found.keys == _WORST)
        yield pa.RecordBatch.from_pydict(
            {
                "item": pa.array(np.full(len(keys), i), pa.int32()),
                "doc_id": keys,
                "score": pa.array(found.scores, pa.int64()),
            }
        )


def _blocks(items: DataFrame) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Queries in blocks, read one partition after the other."""
    names, found, size = [], [], 0
    for row in items.toLocalIterator():
        terms_of = np.array(row["terms"], dtype=np.int64).view(np.uint64)
        if names and (size + len(terms_of) > _BLOCK_TERMS or len(names) == _BLOCK_ITEMS):
            yield names, found
            names, found, size = [], [], 0
        names.append(row["item"])
        found.append(terms_of)
        size += len(terms_of)
    if names:
        yield names, found


def search(
    docs: DataFrame,
    items: DataFrame,
    top: int = TOP,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Rows item_id, rank, doc_id, score: the ``top`` documents of each item of ``items``.

    Scores are those of whole texts; only scores above 0 count, equal ones are ranked by
    ascending key, null keys last. Every row of ``docs`` is a document, also if repeated;
    repeated rows of ``items`` are one query, rows that share a key but not a text are
    two. Null and empty texts have no terms: such documents are not found, such items
    find nothing. Keys are integers; other columns are not looked at; no rows give
    no rows.
    """
    spark = prepared(docs.sparkSession)
    given = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    asked = items.select(F.col(item).cast("long").alias("item"), F.col(item_text).cast("string").alias("text"))
    asked = asked.filter("text is not null").distinct()
    asked = stored(asked.mapInArrow(_queries, "item long, terms array<long>").filter("size(terms) > 0"), "items")
    parts = [_search(spark, given, *block, top) for block in _blocks(asked)]
    if not parts:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _search(spark, docs: DataFrame, names: list, found: list[np.ndarray], top: int) -> DataFrame:
    known = np.unique(np.concatenate(found))
    shared = spark.sparkContext.broadcast(known)
    kind = "doc_id long, n long, terms array<int>, times array<int>"
    rows = stored(docs.mapInArrow(lambda b: _postings(b, shared), kind), "postings")
    documents, total = rows.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequency = rows.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.ln((2 * F.lit(documents) + 2) / (2 * F.col("df") + 1))).cast("long")
    weights = np.zeros(len(known), dtype=np.int64)
    # One number for each different term of the block.
    for row in frequency.select("term", weight.alias("weight")).collect():
        weights[row["term"]] = row["weight"]
    counted = [np.unique(np.searchsorted(known, t), return_counts=True) for t in found]
    block = Block(names, [c[0] for c in counted], [c[1] for c in counted], weights, documents, total, top)
    sent = spark.sparkContext.broadcast(block)
    best = rows.mapInArrow(lambda b: _found(b, sent), "item int, doc_id long, score long")
    of_item = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(of_item)).filter(F.col("rank") <= top)
    ranked = stored(ranked, "ranked")
    items = spark.createDataFrame(list(enumerate(names)), "item int, item_id long")
    return ranked.join(F.broadcast(items), "item").select("item_id", "rank", "doc_id", "score")
