"""Suffix-array dedup: every byte that a repeated string of WIDTH bytes covers is removed.

A window is a string of WIDTH bytes. Its key is the smallest hash of the strings of a
fixed shorter length in it, so equal windows have equal keys wherever they stand,
and neighbouring windows mostly share one. Consecutive windows with one key form a
segment. Only keys met more than once can hold repeated windows; the bytes of
their segments, equal ones once with their number, go to the owner of the key.

An owner sorts the suffixes of the segments of its keys in two stages (two_stage):
directly those smaller than their successors, the rest by induction. Adjacent suffixes
with a common prefix of WIDTH bytes start repeated windows; so do all windows of
a segment that was met more than once. Places go back to the documents and are
joined to maximal runs.

A key with very many different segments, say around a passage that a third of
all documents hold, is split: its windows are keyed again by longer strings, in the
end by the whole window, where all segments of a key are equal. So no owner's
group grows with the data.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almacen.llm import words
from almacen.llm.stored import BROADCAST_BYTES, bounded, prepared, stored
from almacen.llm.two_stage import common_prefix_reaches, joined, suffix_array

WIDTH = 200
#: Lengths of the hashed strings, each level's as a share of the width; the last is the window.
_LEVELS = (0.16, 0.5, 0.75, 1.0)
#: A key with more different segments goes to the next level.
MOST_SEGMENTS = 4096
#: Bytes of text hashed at once, and of segments whose suffixes are sorted together.
_PIECE = 1 << 18
_SORT_BYTES = 1 << 18

_random = np.random.default_rng(20250412)
_CODE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)


def _sized(width: int, level: int) -> int:
    return max(1, round(width * _LEVELS[level]))


def _powers(base: int, size: int) -> np.ndarray:
    factors = np.full(size + 1, base, dtype=np.uint64)
    factors[0] = 1
    return np.cumprod(factors)


_TABLES: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _hashed(data: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` bytes from each place on."""
    top = 1 << int(len(data)).bit_length()
    if top not in _TABLES:
        _TABLES[top] = _powers(_BASE, top), _powers(_UNBASE, top)
    up, down = _TABLES[top]
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_CODE[data] * up[: len(data)], out=sums[1:])
    return words.mixed((sums[size:] - sums[:-size]) * down[: len(data) - size + 1])


def _smallest(values: np.ndarray, span: int) -> np.ndarray:
    """The smallest of the ``span`` values from each place on."""
    if span == 1:
        return values
    blocks = -(-len(values) // span)
    padded = np.full(blocks * span, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    padded = padded.reshape(blocks, span)
    ahead = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(padded, axis=1).ravel()
    count = len(values) - span + 1
    return np.minimum(ahead[:count], behind[span - 1 : span - 1 + count])


def _segments(data: np.ndarray, bounds: np.ndarray, width: int, level: int):
    """Segments of some texts: first window, how many, key, and how often the key's string is in it."""
    size = _sized(width, level)
    none = np.empty(0, dtype=np.int64)
    if len(data) < width:
        return none, none, none.view(np.uint64), none
    hashes = _hashed(data, size)
    span = width - size + 1
    keys = _smallest(hashes, span)
    place = np.arange(len(keys))
    text = np.searchsorted(bounds, place, side="right")
    inside = place + width <= bounds[np.minimum(text, len(bounds) - 1)]
    new = np.append(True, (keys[1:] != keys[:-1]) | ~inside[:-1]) & inside
    starts = np.flatnonzero(new)
    if not len(starts):
        return none, none, none.view(np.uint64), none
    # Runs end with the last inside place before the next run begins.
    insides = np.cumsum(inside)
    following = np.append(starts[1:], len(keys))
    counts = insides[following - 1] - insides[starts] + 1
    # Long runs of one key, in texts that repeat themselves, are cut.
    parts = -(-counts // span)
    of = np.repeat(np.arange(len(starts)), parts)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
    starts = starts[of] + nth * span
    counts = np.minimum(span, counts[of] - nth * span)
    found = keys[starts]
    # How many strings of the segment have the key's hash.
    distinct, rank = np.unique(found, return_inverse=True)
    edge = np.full(span - 1, np.iinfo(np.uint64).max, dtype=np.uint64)
    highest = ~_smallest(np.concatenate([edge, ~keys, edge]), span)
    equal = np.flatnonzero(highest == hashes)
    at = np.minimum(np.searchsorted(distinct, hashes[equal]), len(distinct) - 1)
    places = np.sort((at * len(data) + equal)[distinct[at] == hashes[equal]])
    low = np.searchsorted(places, rank * len(data) + starts)
    high = np.searchsorted(places, rank * len(data) + starts + counts + span - 1)
    return starts, counts, found, high - low


def _pieces(data: np.ndarray, bounds: np.ndarray, width: int):
    """(first text, offset in it, bytes, ends of the texts in them) for texts end to end.

    Short texts come together. A long one comes in parts whose windows follow on each other.
    """
    first = 0
    while first < len(bounds) - 1:
        last = int(np.searchsorted(bounds, bounds[first] + _PIECE, side="right")) - 1
        if last > first:
            yield first, 0, data[bounds[first] : bounds[last]], bounds[first + 1 : last + 1] - bounds[first]
            first = last
            continue
        whole = data[bounds[first] : bounds[first + 1]]
        for at in range(0, max(len(whole) - width + 1, 1), _PIECE):
            part = whole[at : at + _PIECE + width - 1]
            yield first, at, part, np.array([len(part)])
        first += 1


def _keyed(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """For each text (id, text, row) its segments: starts, numbers of windows, keys, which hold the key's string twice."""
    for batch in batches:
        data, bounds = words._flat(batch.column(1))
        parts = [[np.empty(0, np.int64)] * 2 + [np.empty(0, np.uint64), np.empty(0, np.int64)] + [np.empty(0, np.int64)]]
        for first, offset, piece, ends in _pieces(data, bounds, width):
            starts, counts, keys, often = _segments(piece, ends, width, 0)
            text = np.searchsorted(ends, starts, side="right")
            begins = np.append(0, ends)[text]
            parts.append([starts - begins + offset, counts, keys, often, text + first])
        starts, counts, keys, often, text = (np.concatenate(x) for x in zip(*parts))
        cut = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
        cut = pa.array(cut)
        yield pa.RecordBatch.from_pydict(
            {
                "id": batch.column(0),
                "row": batch.column(2),
                "starts": pa.ListArray.from_arrays(cut, pa.array(starts, pa.int64())),
                "windows": pa.ListArray.from_arrays(cut, pa.array(counts, pa.int32())),
                "keys": pa.ListArray.from_arrays(cut, pa.array(keys.view(np.int64))),
                "twice": pa.ListArray.from_arrays(cut, pa.array(often > 1)),
            }
        )


_PIECES = "id binary, start long, key long, times long, digest binary, bytes binary"


def _digest(piece: bytes) -> bytes:
    return hashlib.blake2b(piece, digest_size=16).digest()


def _cut(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The bytes of the segments of each text (id, text, times, starts, windows, keys)."""
    for batch in batches:
        data, bounds = words._flat(batch.column(1))
        rows, size = [], 0
        names, often = (batch.column(i).to_pylist() for i in (0, 2))
        for i, name in enumerate(names):
            text = data[bounds[i] : bounds[i + 1]].tobytes()
            for start, count, key in zip(*(batch.column(c)[i].as_py() for c in (3, 4, 5))):
                piece = text[start : start + count + width - 1]
                rows.append((name, start, key, often[i], _digest(piece), piece))
                size += len(piece)
                if size > _PIECE << 4:
                    yield _as_batch(rows)
                    rows, size = [], 0
        if rows:
            yield _as_batch(rows)


def _as_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary())
    names = ("id", "start", "key", "times", "digest", "bytes")
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_pydict({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})


def _split(batches: Iterator[pa.RecordBatch], width: int, level: int) -> Iterator[pa.RecordBatch]:
    """Segments (digest, bytes, times) keyed again by longer strings; id is the digest of what they were cut from."""
    for batch in batches:
        rows = []
        for parent, piece, times in zip(*(c.to_pylist() for c in batch.columns)):
            data = np.frombuffer(piece, dtype=np.uint8)
            first, many, keys, _ = _segments(data, np.array([len(data)]), width, level)
            for start, count, key in zip(first.tolist(), many.tolist(), keys.view(np.int64).tolist()):
                part = piece[start : start + count + width - 1]
                rows.append((parent, start, key, times, _digest(part), part))
        yield _as_batch(rows)


def _repeated(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Windows of the segments (key, digest, bytes, times) that start a repeated string, as ranges.

    Rows of one key follow on each other; equal segments count together.
    """
    digests, pieces, times = [], [], []
    size, last, places = 0, None, {}

    def found() -> pa.RecordBatch:
        data, ends = joined(pieces)
        order = suffix_array(data, ends, width)
        piece = np.repeat(np.arange(len(ends)), np.diff(np.append(-1, ends)))
        order = order[ends[piece[order]] - order >= width]
        same = common_prefix_reaches(data, ends, order, width)
        hit = np.zeros(len(data), dtype=bool)
        hit[order[same]] = True
        hit[order[np.append(same[1:], False)]] = True
        # A segment met more than once is repeated as a whole.
        often = np.array(times)[piece[order]] > 1
        hit[order[often]] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
        low, high = edges[0::2], edges[1::2] - 1
        begins = np.append(0, ends[:-1] + 1)
        of = piece[low]
        some, cut = np.unique(of, return_index=True)
        cut = pa.array(np.append(cut, len(of)).astype(np.int32))
        return pa.RecordBatch.from_pydict(
            {
                "digest": pa.array([digests[i] for i in some], pa.binary()),
                "low": pa.ListArray.from_arrays(cut, pa.array(low - begins[of], pa.int64())),
                "high": pa.ListArray.from_arrays(cut, pa.array(high - begins[of], pa.int64())),
            }
        )

    for batch in batches:
        for key, digest, piece, often in zip(*(c.to_pylist() for c in batch.columns)):
            if key != last:
                if size >= _SORT_BYTES:
                    yield found()
                    digests, pieces, times, size = [], [], [], 0
                last, places = key, {}
            if digest in places:
                times[places[digest]] += often
                continue
            places[digest] = len(pieces)
            digests.append(digest), pieces.append(piece), times.append(often)
            size += len(piece)
    if pieces:
        yield found()


_RANGES = "digest binary, low array<long>, high array<long>"


def _moved(column: str):
    """All places of a group's arrays, counted from what the segments were cut from."""
    return F.flatten(F.collect_list(F.transform(column, lambda place: place + F.col("start"))))


def _repeats(cut: DataFrame, width: int, level: int = 0) -> DataFrame:
    """(id, low, high): the repeated windows of everything that ``cut`` has segments of, as ranges."""
    rows = ("key", "digest", "bytes", "times")
    # Segments of most keys go straight to the owner, once. Those of common keys are counted together first.
    common = cut.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > MOST_SEGMENTS)
    common = bounded(stored(common.select("key"), "common"))
    few = cut.join(common, "key", "left_anti").select(*rows)
    pieces = cut.join(common, "key", "left_semi").groupBy("key", "digest")
    pieces = pieces.agg(F.first("bytes").alias("bytes"), F.sum("times").alias("times"))
    pieces = stored(pieces.select(*rows), "pieces")
    many = pieces.groupBy("key").agg(F.count("*").alias("n")).filter(F.col("n") > MOST_SEGMENTS)
    many = stored(many.select("key"), "many")
    few, hot = few.unionByName(pieces), level < len(_LEVELS) - 1 and not many.isEmpty()
    if hot:
        few = few.join(bounded(many), "key", "left_anti").select(*rows)
    few = few.repartition("key").sortWithinPartitions("key")
    found = stored(few.mapInArrow(lambda b: _repeated(b, width), _RANGES), "repeated")
    if hot:
        parents = pieces.join(bounded(many), "key", "left_semi").select("digest", "bytes", "times")
        inner = stored(parents.mapInArrow(lambda b: _split(b, width, level + 1), _PIECES), "splits")
        found = found.unionByName(_repeats(inner, width, level + 1).withColumnRenamed("id", "digest"))
    # Equal segments of one text, and copies of it, are one place.
    places = cut.select("id", "start", "digest").distinct().join(found, "digest")
    return places.groupBy("id").agg(_moved("low").alias("low"), _moved("high").alias("high"))


def _merged(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Maximal runs of removed bytes of each text, from its ranges of repeated windows."""
    for batch in batches:
        out = [[], []]
        for lows, highs in zip(batch.column(1), batch.column(2)):
            low, high = (np.asarray(x.values.to_numpy(zero_copy_only=False)) for x in (lows, highs))
            order = np.argsort(low)
            low, stop = low[order], np.maximum.accumulate(high[order] + width)
            new = np.append(True, low[1:] > stop[:-1])
            out[0].append(low[new])
            out[1].append(stop[np.append(np.flatnonzero(new)[1:] - 1, len(stop) - 1)])
        lists = pa.list_(pa.int64())
        yield pa.RecordBatch.from_pydict(
            {"id": batch.column(0), "from": pa.array(out[0], lists), "until": pa.array(out[1], lists)}
        )


def repeated_spans(texts: DataFrame, width: int = WIDTH) -> DataFrame:
    """(id, from, until): the maximal runs of bytes of each text that repeated strings cover.

    ``texts`` has rows (id, text, row) for the documents: rows with one id have one text,
    ``row`` tells most of them apart. Texts without such bytes have no row.
    """
    prepared(texts.sparkSession)
    lists = ("starts", "windows", "keys")
    kinds = "id binary, row long, starts array<long>, windows array<int>, keys array<long>, twice array<boolean>"
    keyed = texts.select("id", "text", "row").mapInArrow(lambda b: _keyed(b, width), kinds)
    alike = keyed.groupBy("id").agg(
        F.count("*").alias("times"),
        F.min("row").alias("row"),
        *[F.first(c).alias(c) for c in (*lists, "twice")],
    )
    keyed = stored(alike.filter("size(keys) > 0"), "segments")
    every = keyed.select("times", F.explode(F.arrays_zip("keys", "twice")).alias("s"))
    times = F.col("times") * F.when(F.col("s.twice"), 2).otherwise(1)
    met = every.groupBy(F.col("s.keys").alias("key")).agg(F.sum(times).alias("times"))
    met = met.filter("times > 1").select("key")
    parts = keyed.select("id", "times", "row", F.explode(F.arrays_zip(*lists)).alias("s"))
    parts = parts.withColumn("key", F.col("s.keys")).join(met, "key").groupBy("id")
    parts = parts.agg(F.first("times").alias("times"), F.first("row").alias("row"), F.collect_list("s").alias("s"))
    parts = stored(parts, "suspects")
    suspects = parts.select(F.col("id").alias("of"), F.col("row").alias("first"), "times", "s")
    # One of the copies is cut; rows that are alike in key and text all are, which changes nothing.
    one = (F.col("id") == F.col("of")) & F.col("row").eqNullSafe(F.col("first"))
    cut = texts.join(suspects, one).select("id", "text", "times", *[F.col(f"s.{c}") for c in lists])
    cut = stored(cut.mapInArrow(lambda b: _cut(b, width), _PIECES), "cut")
    ranges = _repeats(cut, width)
    kinds = "id binary, `from` array<long>, `until` array<long>"
    return stored(ranges.mapInArrow(lambda b: _merged(b, width), kinds), "spans")


def without_repeats(
    docs: DataFrame, width: int = WIDTH, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_bytes, from, until, kept.

    Texts are read whole, as UTF-8 bytes; null counts as empty. from and until are the
    maximal runs of removed bytes (counted from 0, until exclusive), kept the other bytes
    end to end. A byte goes if a string of ``width`` bytes covers it that also starts
    anywhere else: in another row, repeated rows and copies included, or in the same
    one; strings are judged on the texts as given and never cross rows. Texts shorter than ``width`` stay
    as they are. Keys may be null or repeated; other columns are not looked at; no
    rows give no rows.
    """
    given = docs.select(
        F.col(key).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    )
    given = given.withColumn("id", F.unhex(F.md5("text")))
    spans = repeated_spans(given.select("id", "text", F.xxhash64("doc_id").alias("row")), width)
    size = spans.agg(F.sum(F.size("from") * 16 + 64)).first()[0] or 0
    spans = F.broadcast(spans) if size <= BROADCAST_BYTES else spans
    rows = given.join(spans, "id", "left")
    none = F.array().cast("array<long>")
    rows = rows.withColumns(
        {
            "n_bytes": F.octet_length("text").cast("long"),
            "from": F.coalesce("from", none),
            "until": F.coalesce("until", none),
            "body": F.col("text").cast("binary"),
        }
    )
    begins = F.concat(F.array(F.lit(0).cast("long")), "until")
    stops = F.concat("from", F.array("n_bytes"))
    rows = rows.withColumn("rest", F.arrays_zip(begins.alias("a"), stops.alias("z")))
    parts = F.expr("transform(rest, x -> cast(substring(body, int(x.a + 1), int(x.z - x.a)) as string))")
    whole = F.when(F.size("from") == 0, F.col("body"))
    kept = whole.otherwise(F.array_join(parts, "").cast("binary"))
    return rows.select("doc_id", "n_bytes", "from", "until", kept.alias("kept"))
