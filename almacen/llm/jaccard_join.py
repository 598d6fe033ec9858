"""N-gram Jaccard join: a blocked product of the document by n-gram matrix with itself.

The matrix has a row for each distinct set of n-grams; documents with the same
set are one row. Its columns are read in one global order, rare n-grams first,
and only as far as a link needs: two sets of sizes m and n that reach the
threshold t share an n-gram among the first m - ceil(t m) + 1 and the first
n - ceil(t n) + 1 columns of their rows. A column block (all rows of one n-gram)
adds one to the overlap of its pairs; pairs that cannot reach
ceil(t (m + n) / (1 + t)) by their sizes and by the columns still to come are
discarded, the others are verified on the whole sets. Each row also has the
parities of its set in 256 cells: two sets differ in at least as many n-grams as
their parities do in cells, which discards most pairs inside the product.

Only the components are asked for, so the product runs in rounds. In a round
each wide column links its rows to a few of them, the hubs: of a random quarter of the
rows the one with the most common n-grams. That takes as many products as the
column has rows, times HUBS. Rows found linked are
merged; columns within one component need no more work. Columns of a few rows are most of
them and wait for the last round: no earlier one lays them out. Once the pairs left in wide columns are few, or hubs find next to
nothing new, the last round multiplies out all pairs of different components. No candidate is dropped for its number.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almacen.llm import words
from almacen.llm.components import components
from almacen.llm.stored import discard, prepared, small_or_not, stored

N = 5
PERCENT = 80
#: Cells of the table that ranks n-grams by how common they are. It only decides
#: the order of the columns; the result does not depend on it.
RANK_CELLS = 1 << 22
_RANK_PARTS = 256
#: A column with more pairs for each of its rows is wide: a few of these hold most pairs, however
#: many narrow ones there are. The last round comes when all wide columns together have no more
#: pairs than this share of what narrow ones may have; it comes sooner when a round of hubs leaves
#: more than LITTLE of their pairs, as those are mostly no links.
_PAIRS_PER_ENTRY = 8
_WIDE_SHARE = 0.125
_LITTLE = 0.25
_HUB_ROUNDS = 8
#: Hubs of a column in a round, each the most central row of another random quarter.
HUBS = 4
#: Texts without a key are named from here on.
_SPARE = 1 << 62
_SIGN_BITS = 256
_SIGN = ", ".join(f"w{i}: long" for i in range(_SIGN_BITS // 64))


def _needed(size, percent: int):
    """ceil(percent / 100 * size)"""
    return -(-size * percent // 100)


def _counted(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """How often the n-grams of each cell occur, in parts of the table."""
    shift = np.uint64(64 - (RANK_CELLS.bit_length() - 1))
    cells = np.zeros(RANK_CELLS, dtype=np.int32)
    for batch in batches:
        for _, all_words, bounds in words.of_texts(batch.column(0)):
            for i, j in zip(bounds[:-1], bounds[1:]):
                grams = words.shingles(all_words[i:j], n) >> shift
                np.add.at(cells, grams.astype(np.int64), 1)
    parts = [zlib.compress(p.astype(np.int64).tobytes(), 1) for p in np.split(cells, _RANK_PARTS)]
    yield pa.RecordBatch.from_pydict(
        {"part": pa.array(range(_RANK_PARTS), pa.int32()), "cells": pa.array(parts, pa.binary())}
    )


def _summed(parts: pd.DataFrame) -> pd.DataFrame:
    total = np.zeros(RANK_CELLS // _RANK_PARTS, dtype=np.int64)
    for cells in parts["cells"]:
        total += np.frombuffer(zlib.decompress(cells), dtype=np.int64)
    return parts[["part"]].head(1).assign(cells=zlib.compress(total.tobytes(), 1))


def _ranks(docs: DataFrame, n: int) -> np.ndarray:
    """For each cell eight times the binary logarithm of its count: 4 MB, whatever the input."""
    kind = "part int, cells binary"
    counted = docs.select("text").mapInArrow(lambda b: _counted(b, n), kind)
    # Two levels of sums, so that no task adds up the tables of all others.
    salted = counted.groupBy("part", F.pmod(F.xxhash64("cells"), F.lit(16)))
    rows = salted.applyInPandas(_summed, kind).groupBy("part").applyInPandas(_summed, kind)
    table = np.zeros((_RANK_PARTS, RANK_CELLS // _RANK_PARTS), dtype=np.int64)
    for row in rows.collect():
        table[row["part"]] = np.frombuffer(zlib.decompress(row["cells"]), dtype=np.int64)
    return np.minimum(np.ceil(8 * np.log2(table.ravel() + 1)), 255).astype(np.uint8)


def _sets(batch: pa.RecordBatch, column: int, n: int) -> Iterator[np.ndarray]:
    """The distinct n-grams of each text, by hash."""
    for _, all_words, bounds in words.of_texts(batch.column(column)):
        for i, j in zip(bounds[:-1], bounds[1:]):
            yield np.unique(words.shingles(all_words[i:j], n))


def _parities(grams: np.ndarray) -> np.ndarray:
    """Of each cell, whether an odd number of n-grams falls in it."""
    cells = np.bincount((grams & np.uint64(_SIGN_BITS - 1)).astype(np.int64), minlength=_SIGN_BITS)
    return np.packbits((cells & 1).astype(np.uint8)).view(np.int64)


def _rows(batches, n: int, percent: int, ranks) -> Iterator[pa.RecordBatch]:
    """Set size, digest and parities of the set and its first columns, for each document."""
    shift = np.uint64(64 - (RANK_CELLS.bit_length() - 1))
    rank = ranks.value
    for batch in batches:
        sizes, digests, signs, firsts = [], [], [], []
        for grams in _sets(batch, 1, n):
            sizes.append(len(grams))
            digests.append(hashlib.blake2b(grams.tobytes(), digest_size=16).digest())
            signs.append(_parities(grams))
            order = np.argsort(rank[(grams >> shift).astype(np.int64)], kind="stable")
            first = len(grams) - _needed(len(grams), percent) + 1 if len(grams) else 0
            firsts.append(grams[order[:first]].astype(np.int64))
        ends = np.cumsum([0] + [len(f) for f in firsts], dtype=np.int32)
        flat = np.concatenate([np.empty(0, np.int64), *firsts])
        words_of = np.array(signs, np.int64).reshape(-1, _SIGN_BITS // 64).T
        sign = {f"w{i}": pa.array(w) for i, w in enumerate(words_of)}
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch.column(0),
                "n": pa.array(sizes, pa.int64()),
                "digest": pa.array(digests, pa.binary()),
                "sign": pa.StructArray.from_arrays(list(sign.values()), list(sign)),
                "first": pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
            }
        )


def _grams(batches, n: int) -> Iterator[pa.RecordBatch]:
    """The whole set of each document, as sorted 64-bit hashes."""
    for batch in batches:
        packed = [grams.tobytes() for grams in _sets(batch, 1, n)]
        yield pa.RecordBatch.from_pydict(
            {"id": batch.column(0), "grams": pa.array(packed, pa.binary())}
        )


def _verified(batches, percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs whose whole sets reach the threshold."""
    for batch in batches:
        keep = []
        held, mine = None, None
        for a, x, y in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
            if a != held or len(x) != mine.nbytes:
                held, mine = a, np.frombuffer(x, np.uint64)
            other = np.frombuffer(y, np.uint64)
            both = np.concatenate([mine, other])
            both.sort()
            shared = int((both[1:] == both[:-1]).sum())
            keep.append(100 * shared >= percent * (len(both) - shared))
        rows = batch.filter(pa.array(keep, pa.bool_()))
        yield pa.RecordBatch.from_pydict({"a": rows.column(0), "b": rows.column(1)})


def _pair_bounds(percent: int):
    """Whether a pair met in one column can still reach the overlap its sizes need."""
    need = F.expr(f"{percent} * (n_a + n_b) div {100 + percent}")
    exact = F.when(F.expr(f"{percent} * (n_a + n_b) % {100 + percent} > 0"), need + 1)
    need = exact.otherwise(need)
    left = F.least(F.expr("n_a - at_a"), F.expr("n_b - at_b"))
    # The first n-gram that a link shares comes no later than this in either set.
    early = (F.col("at_a") <= F.col("n_a") - need + 1) & (F.col("at_b") <= F.col("n_b") - need + 1)
    differ = " + ".join(f"bit_count(sign_a.w{i} ^ sign_b.w{i})" for i in range(_SIGN_BITS // 64))
    alike = F.coalesce(F.expr(f"n_a + n_b - ({differ})") >= 2 * need, F.lit(True))
    return need, early & (F.least("at_a", "at_b") + left >= need) & alike


class _Matrix:
    """The rows (distinct sets) of ``docs`` and the columns that two or more of them share."""

    def __init__(self, docs: DataFrame, n: int, percent: int):
        spark = prepared(docs.sparkSession)
        self.docs, self.n, self.percent = docs, n, percent
        ranks = spark.sparkContext.broadcast(_ranks(docs, n))
        kind = f"doc_id long, n long, digest binary, sign struct<{_SIGN}>, first array<long>"
        self.rows = stored(docs.mapInArrow(lambda b: _rows(b, n, percent, ranks), kind), "sets")
        self.classes = self.rows.filter("n > 0").groupBy("digest").agg(F.min("doc_id").alias("id"))
        first = self.rows.join(
            self.classes.select("digest", F.col("id").alias("doc_id")), ["digest", "doc_id"]
        )
        first = first.dropDuplicates(["digest", "doc_id"])
        first = stored(first.select(F.col("doc_id").alias("id"), "n", "digest", "sign", "first"), "first")
        # One number for each set: two texts under one key are two sets of one id.
        entry = F.posexplode("first").alias("at", "gram")
        entries = first.select("id", F.substring("digest", 1, 4).alias("part"), entry)
        # Counted and joined, not windowed: an n-gram of a third of all rows is no task of its own.
        shared = entries.groupBy("gram").agg(F.count("*").alias("rows")).filter("rows > 1")
        wide = (F.col("rows") > 2 * _PAIRS_PER_ENTRY).alias("wide")
        columns = entries.join(shared, "gram").groupBy("id", "part").agg(
            F.round(F.sum(F.log("rows")), 6).alias("central"),
            F.collect_list(F.struct((F.col("at") + 1).alias("at"), "gram", wide)).alias("columns"),
        )
        sets = first.select("id", F.substring("digest", 1, 4).alias("part"), "n", "sign")
        self.sets = stored(columns.join(sets, ["id", "part"]).drop("part"), "columns")
        discard(first)

    def entries(self) -> int:
        """Entries of all columns that two or more rows share."""
        return self.sets.agg(F.sum(F.size("columns"))).first()[0] or 0

    def columns(self, labels: DataFrame | None, wide: bool) -> DataFrame:
        """Entries of the columns that two or more components share, with the component of each row.

        With ``wide``, only of columns that had enough rows to be wide, and with how common the
        row's n-grams are. Labels are joined with the sets, one row for each, before these are laid out.
        """
        sets = self.sets.withColumn("component", F.col("id"))
        if labels is not None:
            sets = self.sets.join(labels, F.col("id") == F.col("node"), "left")
            sets = sets.withColumn("component", F.coalesce("component", "id")).drop("node")
        laid_out = F.filter("columns", lambda c: c["wide"]) if wide else F.col("columns")
        kept = ["n", "sign", "component"] + ["central"] * wide
        entries = sets.select("id", *kept, F.explode(laid_out).alias("c"))
        entries = entries.select("id", "c.at", "c.gram", *kept)
        if labels is None:
            return stored(entries, "columns")
        span = entries.groupBy("gram").agg(
            F.min("component").alias("low"), F.max("component").alias("high")
        )
        open_ones = span.filter("low != high").select("gram")
        return stored(entries.join(open_ones, "gram", "left_semi"), "columns")

    def likely(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs(a, b)`` whose first columns overlap as much as links must.

        The set whose first columns end sooner has all other shared n-grams after
        them, so the overlap is at most what the first columns share plus the rest of
        one of the sets.
        """
        shared = self.sets.select("id", "n", F.col("columns.gram").alias("grams"))
        of_a = shared.select(*[F.col(c).alias(f"{c}_a") for c in shared.columns])
        of_b = shared.select(*[F.col(c).alias(f"{c}_b") for c in shared.columns])
        both = pairs.join(of_a, F.col("a") == F.col("id_a"))
        both = both.join(of_b, F.col("b") == F.col("id_b"))
        need, _ = _pair_bounds(self.percent)
        largest = F.greatest("n_a", "n_b")
        rest = F.floor((largest * self.percent + 99) / 100) - 1
        seen = F.size(F.array_intersect("grams_a", "grams_b"))
        return both.filter(seen + rest >= need).select("a", "b")

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of ``pairs(a, b)`` that are links."""
        percent, n = self.percent, self.n
        pairs = stored(pairs, "pairs")
        ids = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
        ids = stored(ids, "ids")
        texts = self.docs.join(small_or_not(ids, 16), F.col("doc_id") == F.col("id"), "left_semi")
        sets = texts.mapInArrow(lambda b: _grams(b, n), "id long, grams binary")
        sets = stored(sets.dropDuplicates(), "grams")
        of_a = sets.select(F.col("id").alias("a"), F.col("grams").alias("grams_a"))
        of_b = sets.select(F.col("id").alias("b"), F.col("grams").alias("grams_b"))
        whole = pairs.join(of_a, "a").join(of_b, "b").select("a", "b", "grams_a", "grams_b")
        found = stored(whole.mapInArrow(lambda b: _verified(b, percent), "a long, b long"), "links")
        discard(pairs, ids, sets)
        return found

    def hub_pairs(self, columns: DataFrame, turn: int) -> DataFrame:
        """Each row of a wide column with the column's hubs, other ones in each turn."""
        hubs = []
        for k in range(HUBS):
            quarter = F.pmod(F.xxhash64("id", F.lit(turn * HUBS + k)), F.lit(4)).alias("quarter")
            lot = [quarter, (-F.col("central")).alias("lot")]
            hubs.append(F.min(F.struct(*lot, "id", "n", "at", "component", "sign")))
        hubs = columns.groupBy("gram").agg(F.array(*hubs).alias("hubs"), F.count("*").alias("rows"))
        hubs = hubs.filter(F.col("rows") > 2 * _PAIRS_PER_ENTRY).drop("rows")
        met = columns.join(hubs, "gram").withColumn("hub", F.explode("hubs"))
        met = met.filter("component != hub.component").select(
            F.col("hub.id").alias("a"),
            F.col("hub.n").alias("n_a"),
            F.col("hub.at").alias("at_a"),
            F.col("hub.sign").alias("sign_a"),
            F.col("id").alias("b"),
            F.col("n").alias("n_b"),
            F.col("at").alias("at_b"),
            F.col("sign").alias("sign_b"),
        )
        _, possible = _pair_bounds(self.percent)
        met = met.filter(possible)
        met = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        return self.likely(met.distinct())

    def all_pairs(self, columns: DataFrame) -> DataFrame:
        """Pairs of different components, by the overlap their columns add up to."""
        left = columns.select([F.col(c).alias(f"{c}_a") for c in columns.columns])
        right = columns.select([F.col(c).alias(f"{c}_b") for c in columns.columns])
        met = left.join(right, F.col("gram_a") == F.col("gram_b"))
        met = met.filter("id_a < id_b and component_a != component_b")
        need, possible = _pair_bounds(self.percent)
        summed = met.filter(possible).groupBy(F.col("id_a").alias("a"), F.col("id_b").alias("b"))
        summed = summed.agg(
            F.count("*").alias("overlap"),
            F.first("n_a").alias("n_a"),
            F.first("n_b").alias("n_b"),
            F.max("at_a").alias("at_a"),
            F.max("at_b").alias("at_b"),
        )
        left_over = F.least(F.expr("n_a - at_a"), F.expr("n_b - at_b"))
        return summed.filter(F.col("overlap") + left_over >= need).select("a", "b")


def _pairs_left(columns: DataFrame) -> tuple[int, int, int]:
    """Entries of the columns, the pairs of different components in them, and those in wide columns.

    A column is wide if it has more than _PAIRS_PER_ENTRY pairs for each of its rows.
    """
    parts = columns.groupBy("gram", "component").agg(F.count("*").cast("double").alias("k"))
    total = parts.groupBy("gram").agg(F.sum("k").alias("k"), F.sum(F.col("k") ** 2).alias("own"))
    pairs = (F.col("k") ** 2 - F.col("own")) / 2
    wide = F.when(pairs > _PAIRS_PER_ENTRY * F.col("k"), pairs)
    return tuple(int(x or 0) for x in total.agg(F.sum("k"), F.sum(pairs), F.sum(wide)).first())


def jaccard_components(
    docs: DataFrame, n: int = N, percent: int = PERCENT, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id.

    Two documents link when their sets of n-grams reach ``percent`` of Jaccard
    similarity; component_id is the smallest key reachable by links, itself
    included. A text of fewer than n words has its whole sequence as its only
    n-gram; null, empty and white texts have none and link with nothing. Repeated
    rows and copies are one set. Keys (integers) name documents: rows that share a
    key but not a text share their links. Rows with a null key take part by their text and
    take the component of their group, null where no row of it has a key. Other columns are not looked at,
    whatever their names; no rows give no rows; texts of any length are read whole.
    """
    return _components(_identified(docs, key, text), n, percent).select(
        F.when(F.col("doc_id") < _SPARE, F.col("doc_id")).alias("doc_id"),
        "n_shingles",
        F.when(F.col("component_id") < _SPARE, F.col("component_id")).alias("component_id"),
    )


def _identified(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, text); texts without a key get one above all keys, which only lives in here."""
    return docs.select(_identity(key, text).alias("doc_id"), F.col(text).cast("string").alias("text"))


def _identity(key: str, text: str):
    spare = F.shiftrightunsigned(F.xxhash64(F.col(text).cast("string")), 2) + F.lit(_SPARE)
    return F.coalesce(F.col(key).cast("long"), spare)


def _components(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id of rows that all have a key."""
    matrix = _Matrix(docs, n, percent)
    entries, found, labels, before = matrix.entries(), None, None, None
    for turn in range(_HUB_ROUNDS + 1):
        columns = matrix.columns(labels, wide=True)
        wide = _pairs_left(columns)[2]
        little = before is not None and wide > _LITTLE * before
        last = little or turn == _HUB_ROUNDS or wide <= _WIDE_SHARE * _PAIRS_PER_ENTRY * entries
        before = wide
        if last:
            discard(columns)
            columns = matrix.columns(labels, wide=False)
            if columns.isEmpty():
                break
        new = matrix.links(
            matrix.all_pairs(columns) if last else matrix.hub_pairs(columns, turn)
        )
        if found is not None:
            every = stored(found.union(new), "links")
            discard(found, new)
            new = every
        found = new
        labels = stored(components(found), "labels")
        discard(columns)
        if last:
            break
    classes = matrix.classes.withColumn("component", F.col("id"))
    if found is not None:
        classes = matrix.classes.join(labels, F.col("id") == F.col("node"), "left").select(
            "digest", F.coalesce("component", "id").alias("component")
        )
    rows = matrix.rows.select("doc_id", F.col("n").alias("n_shingles"), "digest")
    rows = rows.join(classes.select("digest", "component"), "digest", "left")
    return rows.select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id")
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each group of near copies: the one with the smallest key.

    Documents without words stay. ``key`` names each row: rows repeated with a key share
    its fate. Rows with a null key are named by their text, after all keys: they go where
    their group has a key, or another text that stays; of equal texts without a key the
    row whose columns sort last stays.
    """
    found = _components(_identified(docs, key, text), N, PERCENT)
    gone = found.filter("doc_id != component_id").select(F.col("doc_id").alias("_gone")).distinct()
    gone = small_or_not(stored(gone, "gone"), 16)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    rows = docs.select(row, _identity(key, text).alias("_key"), F.col(key).isNull().alias("_unnamed"))
    rows = rows.join(gone, F.col("_key") == F.col("_gone"), "left_anti")
    named = rows.filter("not _unnamed").select("_row.*")
    unnamed = rows.filter("_unnamed").groupBy("_key").agg(F.max("_row").alias("_row"))
    return named.unionByName(unnamed.select("_row.*"))
