"""Source divergence audit: how differently the sources of a language use its terms.

Texts stay in their Arrow buffers. A task gathers a shard of texts, takes a
pointer to the start of each term, and sorts the pointers of each language with a
multikey quicksort that compares the bytes under them. Equal pointers form a run:
the documents in it are the term's document frequency in the shard, and its
pointers by source are the counts. A document lies in one shard, so the shards'
numbers add up.

Rare terms go no further than the sum of their document frequencies. Of the terms
a language keeps, counts are summed by (language, source, term). Distances of
sources are summed over blocks of terms, each a table of all sources of the
language by some terms, with the share of an absent term filled in.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almacen.llm import terms
from almacen.llm.pointer_sort import sort_pointers, symbols_of
from almacen.llm.stored import bounded, prepared, stored

#: A language keeps the terms that so many of its documents hold.
LEAST_DOCUMENTS = 30
#: Added to every count.
SMOOTHING = 5
TOP_TERMS = 50
#: Bytes of text whose pointers a task sorts together, and pointers of a block of the distances.
SHARD_BYTES = 12 << 20
_BLOCK_CELLS = 1 << 18

_RUNS = "lang string, term string, documents long, sources array<string>, counts array<long>"


def _strings(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The bytes under some pointers, as strings."""
    ends = np.cumsum(sizes)
    at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)
    bounds = np.concatenate([[0], ends]).astype(np.int32)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(data[at]))


def _runs(lang: str, texts: pa.Array, sources: pa.Array) -> Iterator[pa.RecordBatch]:
    """A row for each term of some texts of one language."""
    data, bounds = terms.flat(texts, terms.LETTERS)
    starts, ends, before = terms.spans(data, bounds)
    if not len(starts):
        return
    sizes = ends - starts
    names = sources.dictionary_encode()
    source_of = names.indices.to_numpy()
    document = np.repeat(np.arange(len(texts)), np.diff(before))
    order, same = sort_pointers(symbols_of(data), starts, sizes)
    run = np.cumsum(~same) - 1
    first = order[~same]
    # Each (term, document) once, with how often the term occurs there.
    pairs = np.sort(run * len(texts) + document[order])
    new = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
    often = np.diff(np.append(new, len(pairs)))
    run, document = np.divmod(pairs[new], len(texts))
    frequency = np.bincount(run, minlength=len(first))
    cells, place = np.unique(run * len(names.dictionary) + source_of[document], return_inverse=True)
    counts = np.bincount(place, often).astype(np.int64)
    run, source = np.divmod(cells, len(names.dictionary))
    bounds = np.append(np.searchsorted(run, np.arange(len(first))), len(run)).astype(np.int32)
    yield pa.RecordBatch.from_pydict(
        {
            "lang": pa.array([lang]).take(pa.array(np.zeros(len(first), np.int64))),
            "term": _strings(data, starts[first], sizes[first]),
            "documents": pa.array(frequency, pa.int64()),
            "sources": pa.ListArray.from_arrays(
                pa.array(bounds), names.dictionary.take(pa.array(source)).cast(pa.string())
            ),
            "counts": pa.ListArray.from_arrays(pa.array(bounds), pa.array(counts)),
        }
    )


def _sorted_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, size = [], 0

    def shard():
        table = pa.Table.from_batches(held).combine_chunks()
        langs = table.column(0).combine_chunks()
        for lang in langs.unique():
            part = table.filter(pa.compute.equal(langs, lang)).combine_chunks()
            texts, sources = (part.column(i).combine_chunks() for i in (1, 2))
            yield from _runs(lang.as_py(), texts, sources)

    for batch in batches:
        held.append(batch)
        size += batch.column(1).nbytes
        if size >= SHARD_BYTES:
            yield from shard()
            held, size = [], 0
    if held:
        yield from shard()


def _share(count: str, total: str, kept: str):
    """1 + floor(10^9 (count + SMOOTHING) / (total + SMOOTHING kept)), exactly."""
    above = f"cast(1000000000 as decimal(10, 0)) * cast({count} + {SMOOTHING} as decimal(19, 0))"
    return F.expr(f"1 + ({above}) div cast({total} + {SMOOTHING} * {kept} as decimal(20, 0))")


def _distances(block: pd.DataFrame) -> pd.DataFrame:
    """Summed differences of all pairs of sources over the terms of one block."""
    every = block[block["term"].isna()].sort_values("source")
    given = block[block["term"].notna()]
    term, names = pd.factorize(given["term"])
    table = np.repeat(every["p"].to_numpy(dtype=np.int64)[:, None], len(names), axis=1)
    source = np.searchsorted(every["source"].to_numpy(dtype=object), given["source"].to_numpy(dtype=object))
    table[source, term] = given["p"].to_numpy(dtype=np.int64)
    names = every["source"].to_numpy(dtype=object)
    parts = []
    for i, name in enumerate(names):
        others = np.arange(len(names)) != i
        value = np.abs(table - table[i]).sum(axis=1)[others]
        parts.append(pd.DataFrame({"source": name, "item": names[others], "value": value}))
    out = pd.concat(parts)
    out.insert(0, "lang", block["lang"].iloc[0])
    return out


def audit(
    docs: DataFrame,
    least: int = LEAST_DOCUMENTS,
    top: int = TOP_TERMS,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
) -> DataFrame:
    """Rows lang, source, part, item, value, rank.

    Part ``pair`` ranks the other sources of the language by their distance, the summed
    difference of the shares of all kept terms; part ``term`` ranks the kept terms that
    the source uses more than its language does, the ``top`` of them. Equal values are
    ranked by the bytes of the item. Null texts, languages and sources count as
    empty; a source without terms has the smallest share of each. Repeated rows are
    documents of their own. A text of any length is sorted whole. A language that keeps no
    term has pairs of value 0 and no terms; one with a single source has no pairs.
    Other columns are not looked at; no rows give no rows.
    """
    prepared(docs.sparkSession)
    given = docs.select(
        *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (text, "text"), (source, "source"))]
    )
    runs = stored(given.mapInArrow(_sorted_shards, _RUNS), "runs")
    kept = runs.groupBy("lang", "term").agg(F.sum("documents").alias("documents"))
    kept = stored(kept.filter(F.col("documents") >= least).select("lang", "term"), "kept")
    cells = runs.join(bounded(kept, "lang", "term"), ["lang", "term"])
    cells = cells.select("lang", "term", F.explode(F.arrays_zip("sources", "counts")).alias("c"))
    cells = cells.groupBy("lang", F.col("c.sources").alias("source"), "term")
    cells = stored(cells.agg(F.sum("c.counts").alias("count")), "cells")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("v"))
    groups = given.select("lang", "source").distinct()
    totals = cells.groupBy("lang", "source").agg(F.sum("count").alias("n"))
    groups = groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    none = F.lit(0).cast("long")
    groups = groups.withColumns({"n": F.coalesce("n", none), "v": F.coalesce("v", none)})
    groups = stored(groups, "groups")
    few = bounded(groups, "lang", "source")
    cells = cells.join(few, ["lang", "source"]).withColumn("p", _share("count", "n", "v"))
    cells = stored(cells.select("lang", "source", "term", "count", "p"), "shares")
    return _pairs(cells, groups).unionByName(_terms(cells, groups, top))


def _pairs(cells: DataFrame, groups: DataFrame) -> DataFrame:
    # So many blocks that a block's table of sources by terms stays small.
    langs = groups.groupBy("lang").agg(
        F.greatest(F.lit(1), F.ceil(F.max("v") * F.count("*") / F.lit(_BLOCK_CELLS))).alias("blocks"),
    )
    langs = bounded(stored(langs, "blocks"), "lang")
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block")
    given = cells.join(langs, "lang").select("lang", block, "source", "term", "p")
    absent = F.when(F.col("v") > 0, _share("0", "n", "nullif(v, 0)")).otherwise(F.lit(0))
    every = groups.join(langs, "lang").select(
        "lang",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        "source",
        F.lit(None).cast("string").alias("term"),
        absent.cast("long").alias("p"),
    )
    parts = given.unionByName(every).groupBy("lang", "block")
    parts = parts.applyInPandas(_distances, "lang string, source string, item string, value long")
    pairs = parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    return _ranked(pairs, "pair")


def _terms(cells: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    every = groups.groupBy("lang").agg(F.sum("n").alias("n"), F.max("v").alias("v"))
    usual = cells.groupBy("lang", "term").agg(F.sum("count").alias("count"))
    usual = usual.join(bounded(stored(every, "langs"), "lang"), "lang")
    usual = usual.select("lang", "term", _share("count", "n", "v").alias("q"))
    both = cells.join(bounded(stored(usual, "usual"), "lang", "term"), ["lang", "term"])
    more = both.filter("p > q").select(
        "lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value")
    )
    return _ranked(more, "term").filter(F.col("rank") <= top)


def _ranked(rows: DataFrame, part: str) -> DataFrame:
    of_group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return rows.select(
        "lang",
        "source",
        F.lit(part).alias("part"),
        "item",
        "value",
        F.row_number().over(of_group).alias("rank"),
    )
