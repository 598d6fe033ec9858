"""Exact metric range join of embeddings: cells around pivots, replicated at their borders.

Vectors are scaled to length one, where cosine >= c is the same as a distance of
at most r = sqrt(2 - 2c). Each vector belongs to the cell of its nearest pivot.
Vectors x in cell p and y in cell q, at most r apart, satisfy by the triangle
inequality d(y, p) <= radius of p + r and d(y, p) <= d(y, q) + 2 r; and as x is on
p's side of the plane between p and q, y is at most r beyond it. y is sent as a
visitor to every cell p < q where all three hold, so each pair meets once. A cell
of more than BLOCK vectors is cut into blocks that visit each other likewise.
Each block is then joined on its own: its members are held, visitors stream past,
and the cosines of a batch are one matrix product in double precision. A block
adds up links and hands on only a spanning forest of them, so a group of copies
costs as many rows as it has vectors.

Where vectors are spread evenly in many dimensions no pivot excludes anything,
and the join is all against all in blocks; that is the price of an exact result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almacen.llm.components import components
from almacen.llm.stored import prepared, stored

COSINE = 0.9
#: Vectors of a block, which one task holds.
BLOCK = 4096
#: Pivots: one for each BLOCK vectors, at most MOST_PIVOTS; cells are cut beyond that.
MOST_PIVOTS = 256
#: The pivots are chosen among so many vectors, the first in an order by hash.
PIVOT_SAMPLE = 4096
_STEP = 1024
#: Keys are below this.
_SPARE = 1 << 62
#: Cosines this near to the threshold are computed again without rounding.
_NEAR = 1e-9
#: Rounding allowed for in the bounds of the triangle inequality.
_SLACK = 1e-6

_CELL = "cell int, block int, visitor boolean, vec_id long, w long, vector binary"
_FOUND = "vec_id long, n_links long, other long"


def _units(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]


def _matrix(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors from their bytes, shorter ones filled up with zeros, and their lengths."""
    parts = [np.frombuffer(b, dtype=np.float64) for b in column.to_pylist()]
    out = np.zeros((len(parts), width))
    for row, part in zip(out, parts):
        row[: len(part)] = part
    return out, np.array([len(p) for p in parts], dtype=np.int64)


def _pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """Each next pivot is the vector farthest from those chosen so far."""
    if not len(sample):
        return sample
    chosen = [0]
    nearest = sample @ sample[0]
    while len(chosen) < min(count, len(sample)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, sample @ sample[chosen[-1]])
    return sample[chosen]


def _distances(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (units @ pivots.T), 0))


def _homes(batches, pivots: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The cell of each vector and its distance from the pivot."""
    for batch in batches:
        vectors, _ = _matrix(batch.column(2), pivots.shape[1])
        apart = _distances(_units(vectors), pivots)
        home = apart.argmin(axis=1)
        yield pa.RecordBatch.from_pydict(
            {
                "vec_id": batch.column(0),
                "w": batch.column(1),
                "vector": batch.column(2),
                "cell": pa.array(home, pa.int32()),
                "apart": pa.array(apart[np.arange(len(home)), home], pa.float64()),
            }
        )


def _dealt(batches, pivots, radii, blocks, r) -> Iterator[pa.RecordBatch]:
    """Every vector as a member of its block and as a visitor of others."""
    between = np.sqrt(np.maximum(2 - 2 * (pivots @ pivots.T), 0))
    cells = np.arange(len(pivots))
    for batch in batches:
        vectors, _ = _matrix(batch.column(2), pivots.shape[1])
        apart = _distances(_units(vectors), pivots)
        home = batch.column(3).to_numpy()
        lot = batch.column(4).to_numpy()
        rows, to, block, visitor = [], [], [], []
        for i, q in enumerate(home):
            own = int(lot[i] % blocks[q])
            near = apart[i] <= np.minimum(radii + r, apart[i, q] + 2 * r) + _SLACK
            beyond = apart[i] ** 2 - apart[i, q] ** 2 <= 2 * between[q] * (r + _SLACK) + _SLACK
            others = cells[(cells < q) & near & beyond]
            here = [(q, b, b < own) for b in range(own + 1)]
            for c, b, v in here + [(c, b, True) for c in others for b in range(blocks[c])]:
                rows.append(i), to.append(c), block.append(b), visitor.append(v)
        rows = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_pydict(
            {
                "cell": pa.array(to, pa.int32()),
                "block": pa.array(block, pa.int32()),
                "visitor": pa.array(visitor, pa.bool_()),
                "vec_id": batch.column(0).take(rows),
                "w": batch.column(1).take(rows),
                "vector": batch.column(2).take(rows),
            }
        )


def _exact_at_least(x: np.ndarray, y: np.ndarray, cosine: float) -> bool:
    dot = math.fsum(x * y)
    return dot / (math.sqrt(math.fsum(x * x)) * math.sqrt(math.fsum(y * y))) >= cosine


class _Block:
    """The members of one block, and the links found so far."""

    def __init__(self, cosine: float, width: int):
        self.cosine, self.width = cosine, width
        self.parts: list[tuple] = []
        self.built = False

    def add(self, part: tuple) -> None:
        self.parts.append(part)

    def build(self) -> None:
        if self.built:
            return
        self.ids, self.weights, self.vectors, self.lengths = (
            np.concatenate(x) for x in zip(*self.parts)
        )
        self.units = _units(self.vectors)
        self.links = np.zeros(len(self.ids), dtype=np.int64)
        self.root = np.arange(len(self.ids))
        self.built = True

    def linked(self, part: tuple) -> np.ndarray:
        """Which vectors of a part (rows) link with which members (columns)."""
        _, _, vectors, lengths = part
        cosines = _units(vectors) @ self.units.T
        out = cosines >= self.cosine
        for i, j in zip(*np.nonzero(np.abs(cosines - self.cosine) < _NEAR)):
            out[i, j] = _exact_at_least(vectors[i], self.vectors[j], self.cosine)
        return out & (lengths[:, None] == self.lengths)

    def _find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = i = self.root[self.root[i]]
        return i

    def _merge(self, members: np.ndarray) -> None:
        top = self._find(members[0])
        for j in members[1:]:
            self.root[self._find(j)] = top

    def visit(self, part: tuple) -> pa.RecordBatch:
        """Links of a part of visitors; each is tied to one member, which ties those members."""
        linked = self.linked(part)
        self.links += part[1] @ linked
        rows = np.flatnonzero(linked.any(axis=1))
        first = linked.argmax(axis=1)
        for i in rows:
            self._merge(np.flatnonzero(linked[i]))
        return _found(part[0][rows], (linked @ self.weights)[rows], self.ids[first[rows]])

    def finish(self) -> pa.RecordBatch:
        """Links within the block, and what ties its members together."""
        for start in range(0, len(self.ids), _STEP):
            stop = min(start + _STEP, len(self.ids))
            span = slice(start, stop)
            part = (self.ids[span], self.weights[span], self.vectors[span], self.lengths[span])
            linked = self.linked(part)
            linked[np.arange(stop - start), np.arange(start, stop)] = True
            self.links[span] += linked @ self.weights - self.weights[span]
            for i in np.flatnonzero(linked.sum(axis=1) > 1):
                self._merge(np.flatnonzero(linked[i]))
        tops = np.array([self._find(i) for i in range(len(self.ids))], dtype=np.int64)
        keep = (self.links > 0) | (tops != np.arange(len(tops)))
        return _found(self.ids[keep], self.links[keep], self.ids[tops[keep]])


def _found(ids, links, other) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {
            "vec_id": pa.array(ids, pa.int64()),
            "n_links": pa.array(np.asarray(links, dtype=np.int64), pa.int64()),
            "other": pa.array(other, pa.int64()),
        }
    )


def _joined(batches, cosine: float, width: int) -> Iterator[pa.RecordBatch]:
    """Blocks one after the other; of each, the members come before the visitors."""
    block, at = None, None
    for batch in batches:
        for start in range(0, batch.num_rows, _STEP):
            rows = batch.slice(start, _STEP)
            cells, blocks = rows.column(0).to_numpy(), rows.column(1).to_numpy()
            visitor = rows.column(2).to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(
                (np.diff(cells) != 0) | (np.diff(blocks) != 0) | (np.diff(visitor) != 0)
            )
            for i, j in zip([0, *(cuts + 1)], [*(cuts + 1), len(cells)]):
                if at != (cells[i], blocks[i]):
                    if block and block.parts:
                        block.build()
                        yield block.finish()
                    block, at = _Block(cosine, width), (cells[i], blocks[i])
                vectors, lengths = _matrix(rows.column(5).slice(i, j - i), width)
                ids = rows.column(3).slice(i, j - i).to_numpy()
                part = (ids, rows.column(4).slice(i, j - i).to_numpy(), vectors, lengths)
                if not visitor[i]:
                    block.add(part)
                elif block.parts:
                    block.build()
                    yield block.visit(part)
    if block and block.parts:
        block.build()
        yield block.finish()


def _as_bytes(batches) -> Iterator[pa.RecordBatch]:
    """Usable vectors as the bytes of doubles; 0.0 and -0.0 are the same."""
    for batch in batches:
        packed = []
        for vector in batch.column(1).to_pylist():
            good = bool(vector) and None not in vector
            values = np.array(vector if good else [0.0], dtype=np.float64) + 0.0
            size = np.abs(values).max() if good else 0.0
            good = good and np.isfinite(values).all() and size > 0
            # A power of two changes no cosine and keeps squares in range.
            packed.append(np.ldexp(values, -int(np.frexp(size)[1])).tobytes() if good else None)
        yield pa.RecordBatch.from_pydict(
            {"vec_id": batch.column(0), "vector": pa.array(packed, pa.binary())}
        )


def metric_components(
    vectors: DataFrame, cosine: float = COSINE, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """One row for each row of ``vectors``: vec_id, n_links, component_id, kept.

    Rows whose vectors have at least ``cosine`` (in double precision) link. Vectors
    that are null, empty, zero or hold null or non-finite components link with
    nothing, nor do vectors of different lengths. Equal vectors are compared once
    and counted as often as they occur; repeated rows count each other. component_id
    is the smallest key reachable by links, kept whether it is the row's own. Keys
    are integers; a row with a null key counts as a link of others, is never kept
    and takes the component of its equals, or null. Other columns are not looked at.
    """
    spark = prepared(vectors.sparkSession)
    given = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("embedding"))
    rows = stored(given.mapInArrow(_as_bytes, "vec_id long, vector binary"), "vectors")
    classes = rows.filter("vector is not null").groupBy("vector")
    classes = classes.agg(
        F.min("vec_id").alias("id"), F.count("*").alias("w"), F.max(F.length("vector")).alias("l")
    )
    # Vectors without a key get one above all keys, which only lives in here.
    spare = F.shiftrightunsigned(F.xxhash64("vector"), 2) + F.lit(_SPARE)
    classes = stored(classes.withColumn("id", F.coalesce("id", spare)), "classes")
    count, widest = classes.agg(F.count("*"), F.max("l")).first()
    none = F.lit(0).cast("long")
    if count:
        found = _found_links(classes, count, widest // 8, cosine)
        totals = found.groupBy("vec_id").agg(F.sum("n_links").alias("n_links"))
        ties = found.select(F.col("vec_id").alias("a"), F.col("other").alias("b"))
        labels = stored(components(ties), "labels")
        totals = totals.join(labels, F.col("vec_id") == F.col("node"), "left")
        component = F.coalesce("component", "id")
        classes = classes.join(totals, F.col("id") == F.col("vec_id"), "left").select(
            "vector",
            (F.coalesce("n_links", none) + F.col("w") - 1).alias("n_links"),
            F.when(component < _SPARE, component).alias("c"),
        )
    else:
        classes = classes.select("vector", F.col("w").alias("n_links"), F.col("id").alias("c"))
    return rows.join(classes, "vector", "left").select(
        "vec_id",
        F.coalesce("n_links", none).alias("n_links"),
        F.coalesce("c", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("c", "vec_id"), F.lit(False)).alias("kept"),
    )


def _found_links(classes: DataFrame, count: int, width: int, cosine: float) -> DataFrame:
    """Links of each class by block (n_links without the own copies), and a tie to another."""
    sc = classes.sparkSession.sparkContext
    r = math.sqrt(2 - 2 * cosine)
    order = [F.xxhash64("vector"), F.col("vector")]
    sample = classes.select("vector").orderBy(*order).limit(PIVOT_SAMPLE).collect()
    sample = pa.array([bytes(x["vector"]) for x in sample], pa.binary())
    chosen = _matrix(sample, width)[0]
    pivots = _pivots(_units(chosen), min(MOST_PIVOTS, -(-count // BLOCK)))
    shared = sc.broadcast(pivots)
    plain = classes.select("id", "w", "vector")
    kind = "vec_id long, w long, vector binary, cell int, apart double"
    homes = stored(plain.mapInArrow(lambda b: _homes(b, shared.value), kind), "homes")
    radii, blocks = np.zeros(len(pivots)), np.ones(len(pivots), dtype=np.int64)
    for row in homes.groupBy("cell").agg(F.max("apart"), F.count("*")).collect():
        radii[row[0]], blocks[row[0]] = row[1], -(-row[2] // BLOCK)
    lot = F.pmod(F.xxhash64("vector", F.lit("block")), F.lit(1 << 40))
    dealt = homes.select("vec_id", "w", "vector", "cell", lot.alias("lot")).mapInArrow(
        lambda b: _dealt(b, shared.value, radii, blocks, r), _CELL
    )
    met = dealt.repartition("cell", "block").sortWithinPartitions("cell", "block", "visitor")
    return stored(met.mapInArrow(lambda b: _joined(b, cosine, width), _FOUND), "found")

