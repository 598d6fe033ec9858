"""Mixing sources to target weights by Pareto order sampling.

A source's target, in words, is its weight's part of the mix, at most MOST times
its size; what is above is shared by weight among the others. Within a source, a
document's expected copies are proportional to its merit (the number of binary
digits of its size: longer documents are worth more, slowly) up to MOST. Their
whole part is allocated for certain. For the rest each document draws a random
number u, and documents are ranked by the odds of u over the odds of the
fraction that is left; they are taken in this order as long as the source's
words come nearer to the target.

Ranks are cut into many ranges of log odds. Words of each range are summed first,
and only the range in which a source's target falls is sorted, so a source with a
third of all documents is no task of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almacen.llm.stored import bounded, stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
SEED = "mix"
#: Ranges over log odds from -_WIDEST to _WIDEST.
_RANGES = 1 << 15
_WIDEST = 64.0
_WORDS = r"[^\x20\x09-\x0D]+"


def _random(key: str, text: str, seed: str):
    """A number between 0 and 1 from the key, or from the text where there is no key."""
    name = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("no key "), F.md5(text)))
    digits = F.substring(F.md5(F.concat(F.coalesce(name, F.lit("none")), F.lit(f":{seed}"))), 1, 13)
    return (F.conv(digits, 16, 10).cast("long").cast("double") + 0.5) / float(1 << 52)


def _size(text: str):
    """Words of the text; null has none."""
    return F.coalesce(F.regexp_count(F.col(text), F.lit(_WORDS)), F.lit(0)).cast("long")


def _targets(sources: DataFrame, weights, share: float, most: int) -> DataFrame:
    """source_size and target of each source; ``sources`` has one row for each."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int"))
    rows = sources.withColumn("weight", weight)
    every = Window.partitionBy()
    rows = rows.withColumns(
        {"total": F.sum("source_size").over(every), "all_weights": F.sum("weight").over(every)}
    )
    fullest = F.col("source_size") * most / F.col("weight")
    before = Window.orderBy(fullest, F.col("source").asc_nulls_last())
    before = before.rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    full_words = F.coalesce(F.sum(F.col("source_size") * most).over(before), none)
    full_weight = F.coalesce(F.sum("weight").over(before), none)
    # Words for a unit of weight if all sources before this one are full and no later one is.
    rows = rows.withColumn(
        "level", (F.lit(share) * F.col("total") - full_words) / (F.col("all_weights") - full_weight)
    )
    rows = rows.withColumn("full", F.col("source_size") * most / F.col("weight") <= F.col("level"))
    last_level = F.max(F.when(~F.col("full"), F.col("level"))).over(every)
    target = F.when(F.col("full"), (F.col("source_size") * most).cast("double"))
    target = target.otherwise(last_level * F.col("weight"))
    return rows.select("source", "source_size", target.alias("target"))


def _copies_each(sizes: DataFrame, targets: DataFrame, most: int) -> DataFrame:
    """For each source the copies of a document for each point of merit."""
    rows = sizes.filter("size > 0").join(targets, F.col("s").eqNullSafe(F.col("source")))
    rows = rows.withColumn("merit", F.length(F.bin(F.col("size") + 1)).cast("long"))
    rows = rows.groupBy("s", "target", "merit").agg(F.sum("words").alias("words"))
    first = Window.partitionBy("s").orderBy(F.desc("merit"))
    before = first.rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.partitionBy("s").orderBy(F.desc("merit"))
    rest = rest.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    full = F.coalesce(F.sum(F.col("words") * most).over(before), F.lit(0).cast("long"))
    left = F.sum(F.col("words") * F.col("merit")).over(rest)
    rows = rows.withColumn("each", (F.col("target") - full) / left)
    open_ones = F.when(F.col("each") * F.col("merit") < most, F.col("each"))
    # Where even the least worthy document is full, any higher number says so.
    return rows.groupBy("s").agg(F.coalesce(F.max(open_ones), F.lit(float(most))).alias("each"))


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: str = SEED,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """One row for each row of ``docs``: doc_id, source, size, source_size, target, copies, taken.

    Sources by code point, null last, get the weights in turn. size counts words
    (null text: 0), copies is from 0 to ``most``, taken = copies * size. Documents
    without words are not taken. The choice depends on keys, sizes and the seed only,
    so reruns agree; rows without a key go by their text. Rows repeated with a key
    draw the same number and are taken one after the other. Other columns are not
    looked at; no rows give no rows; ``share`` is at most ``most``.
    """
    drawn, _, cuts = _planned(docs, weights, share, most, seed, key, text, source)
    return _taken(drawn, cuts)


def _planned(docs: DataFrame, weights, share: float, most: int, seed: str, key: str, text: str, source: str):
    """The documents as they are drawn, and by source what that needs: plans and cuts."""
    if share > most:
        raise ValueError("no mix of more than ``most`` times all words")
    rows = docs.select(*_asked(key, text, source, seed))
    rows = stored(rows, "sizes")
    sizes = rows.groupBy(F.col("source").alias("s"), "size").agg(F.count("*").alias("n"))
    sizes = stored(sizes.withColumn("words", F.col("size") * F.col("n")), "source_sizes")
    sources = sizes.groupBy(F.col("s").alias("source")).agg(F.sum("words").alias("source_size"))
    targets = _targets(sources, weights, share, most)
    targets = stored(targets, "targets")
    plans = targets.join(
        _copies_each(sizes, targets, most), F.col("source").eqNullSafe(F.col("s")), "left"
    )
    plans = plans.select(
        F.col("source").alias("of"), "source_size", "target", F.coalesce("each", F.lit(0.0)).alias("each")
    )
    plans = stored(plans, "plans")
    drawn = stored(_drawn(rows, plans, most), "drawn")
    return drawn, plans, stored(_cuts(drawn), "cuts")


def _asked(key: str, text: str, source: str, seed: str) -> list:
    """What a draw looks at."""
    return [
        F.col(key).alias("doc_id"),
        F.col(source).alias("source"),
        _size(text).alias("size"),
        _random(key, text, seed).alias("u"),
    ]


def _of_source(rows: DataFrame, by_source: DataFrame) -> DataFrame:
    by_source = bounded(by_source, "of")
    return rows.join(by_source, F.col("source").eqNullSafe(F.col("of"))).drop("of")


def _log_odds(p):
    return F.ln(p / (1 - p))


def _drawn(rows: DataFrame, plans: DataFrame, most: int, *kept: str) -> DataFrame:
    """Certain copies of each document, and its rank in the draw for one more; other columns to keep."""
    merit = F.length(F.bin(F.col("size") + 1))
    expected = F.when(F.col("size") > 0, F.least(F.col("each") * merit, F.lit(float(most))))
    rows = _of_source(rows, plans).withColumn("expected", F.coalesce(expected, F.lit(0.0)))
    rows = rows.withColumn("certain", F.floor("expected")).withColumn(
        "part", F.col("expected") - F.col("certain")
    )
    draws = _log_odds(F.col("u")) - _log_odds(F.col("part"))
    rows = rows.withColumn("rank", F.when((F.col("part") > 0) & (F.col("part") < 1), draws))
    inside = F.least(F.greatest(F.col("rank"), F.lit(-_WIDEST)), F.lit(_WIDEST)) + _WIDEST
    return rows.select(
        *kept,
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "certain",
        "rank",
        F.when(F.col("rank").isNotNull(), F.floor(inside / (2 * _WIDEST) * _RANGES)).alias("range"),
    )


def _cuts(drawn: DataFrame) -> DataFrame:
    """For each source the range in which its words reach the target, and the words before it."""
    ranges = drawn.groupBy("source", "target", "range").agg(
        F.sum(F.col("certain") * F.col("size")).alias("certain_words"), F.sum("size").alias("words")
    )
    all_certain = F.sum("certain_words").over(Window.partitionBy("source"))
    ranges = ranges.withColumn("wanted", F.col("target") - all_certain).filter("range is not null")
    until = Window.partitionBy("source").orderBy("range")
    ranges = ranges.withColumn("until", F.sum("words").over(until)).filter("until > wanted")
    cut = F.min(F.struct("range", "until", "words", "wanted")).alias("cut")
    cuts = ranges.groupBy(F.col("source").alias("of")).agg(cut)
    return cuts.select(
        "of",
        F.col("cut.range").alias("cut"),
        (F.col("cut.until") - F.col("cut.words")).alias("before"),
        F.col("cut.wanted").alias("wanted"),
    )


def _judged(drawn: DataFrame, cuts: DataFrame) -> DataFrame:
    """Rows outside of their source's cut with their copies; rows in it with none yet."""
    cuts = bounded(cuts, "of")
    rows = drawn.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left")
    at_cut = F.coalesce(F.col("range") == F.col("cut"), F.lit(False))
    beyond = F.coalesce(F.col("range") > F.col("cut"), F.lit(False))
    more = (F.col("rank").isNotNull() & ~beyond).cast("long")
    return rows.withColumn("copies", F.when(~at_cut, F.col("certain") + more))


def _in_cuts(drawn: DataFrame, cuts: DataFrame) -> DataFrame:
    """Rows in the cuts, by rank as long as the words come nearer to the target, with their copies."""
    last = _judged(drawn, cuts).filter("copies is null")
    in_order = Window.partitionBy("source").orderBy("rank", "doc_id", "size")
    words = F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    reached = F.col("before") + words - F.col("size") / 2
    more = (reached <= F.col("wanted")).cast("long")
    return last.withColumn("copies", F.col("certain") + more)


def _taken(drawn: DataFrame, cuts: DataFrame) -> DataFrame:
    """Documents by rank as long as the words of their source come nearer to its target."""
    clear = _judged(drawn, cuts).filter("copies is not null")
    rows = clear.unionByName(_in_cuts(drawn, cuts))
    return rows.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed_documents(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: float = SHARE,
    most: int = MOST,
    seed: str = SEED,
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``docs`` as the mix takes them: rows of two copies come twice, rows of none go.

    The columns are those of ``docs``. Each row's copies follow from its own values and
    its source's plan, so whole rows are neither shuffled nor stored; only rows in
    the range of ranks where a source reaches its target are looked up, and such
    rows that share a key, a source and a size share the larger number of copies.
    """
    drawn, plans, cuts = _planned(docs, weights, share, most, seed, key, text, source)
    last = _in_cuts(drawn, cuts).groupBy(
        F.col("doc_id").alias("k"), F.col("source").alias("s"), F.col("size").alias("n")
    )
    last = bounded(stored(last.agg(F.max("copies").alias("decided")), "last"), "s")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = _drawn(docs.select(row, *_asked(key, text, source, seed)), plans, most, "row")
    rows = _judged(rows, cuts)
    same = F.col("doc_id").eqNullSafe(F.col("k")) & F.col("source").eqNullSafe(F.col("s"))
    same = same & (F.col("size") == F.col("n"))
    looked_up = rows.filter("copies is null").join(last, same).select("row", F.col("decided").alias("copies"))
    rows = rows.select("row", "copies").filter("copies is not null").unionByName(looked_up)
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy")
    return rows.filter("copies > 0").select("row", times).select("row.*")
