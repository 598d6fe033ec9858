"""Language identification by interpolated Kneser-Ney character models.

Texts are folded: letters to lower case, everything else to single spaces. For
each language, character n-grams of one to ORDER letters are counted over a
bounded sample of labelled texts, and absolute discounting with continuation
counts for the lower orders gives interpolated Kneser-Ney probabilities. The
models of all languages lie in one sorted array of n-gram hashes for each order,
with a row of log probabilities and back-off weights, so one search serves every
language. A text gets the language of the lowest cross-entropy per character.

Part of the sample is kept from the counts to calibrate: it sets how sharply
cross-entropies turn into the score, and how far above its language's usual
cross-entropy a text may lie before it is rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from almacen.llm.stored import prepared, small_or_not, stored
from almacen.llm.words import mixed

ORDER = 5
#: The sample of one language: so many texts, the first in an order by hash. If they have
#: more characters than this, each is cut to an equal share. It bounds the models, whatever the input.
SAMPLE_TEXTS = 600
SAMPLE_CHARACTERS = 3_000_000
#: Of the sample, one text in so many calibrates.
_CALIBRATE = 5
#: A text is rejected this many deviations above the usual cross-entropy. Random letters lie
#: above it from about 100 characters on; shorter texts say too little to be told apart.
DEVIATIONS = 7.5
#: A language with fewer calibration texts has the relative deviation of all languages.
_OWN_TEXTS = 10
#: An unseen character has this share of what is left for new ones.
_NEW_CHARACTER = 1 / 4096
_SHARPNESS = (0.01, 0.03, 0.1, 0.3, 1.0)
_PIECE = 1 << 20
UNKNOWN = "und"

_PLACES = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93]
    + [0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3],
    dtype=np.uint64,
)


@lru_cache(maxsize=1)
def _folding() -> np.ndarray:
    """For each code point its lower-case letter, or a space."""
    fold = np.full(0x110000, 32, dtype=np.uint32)
    for c in range(0x110000):
        letter = chr(c)
        if letter.isalpha():
            fold[c] = ord(letter.lower()[0])
    fold[0x300:0x370] = np.arange(0x300, 0x370)  # combining accents stay with their letter
    return fold


def folded(text: str) -> np.ndarray:
    """Lower-case letters with single spaces between words and around them."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.concatenate([[32], _folding()[codes], [32]]).astype(np.uint32)
    keep = np.ones(len(codes), dtype=bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    return codes[keep]


def _hashes(codes: np.ndarray, order: int) -> np.ndarray:
    """The n-gram that ends at each position from ``ORDER - 1`` on."""
    out = np.full(len(codes) - ORDER + 1, order, dtype=np.uint64)
    wide = codes.astype(np.uint64)
    for j in range(order):
        out += wide[ORDER - 1 - j : len(wide) - j] * _PLACES[j]
    return mixed(out)


def _padded(codes: np.ndarray) -> np.ndarray:
    """With spaces before the text, so that each of its characters has a context."""
    return np.concatenate([np.full(ORDER - 1, 32, dtype=np.uint32), codes[1:]])


class _Counts:
    """Distinct n-grams of one order with their counts, prefixes and suffixes."""

    def __init__(self, codes: np.ndarray, order: int, keep: np.ndarray):
        grams = _hashes(codes, order)
        self.hashes, first, self.counts = np.unique(
            grams[keep], return_index=True, return_counts=True
        )
        at = np.flatnonzero(keep)[first]
        self.counts = self.counts.astype(np.float64)
        self.suffix = _hashes(codes, order - 1)[at] if order > 1 else None
        # A place of -1 is the padding before the first text.
        self.prefix = _at(codes, at - 1, order - 1) if order > 1 else None


def _train(texts: pd.Series) -> dict[int, tuple]:
    """For each order: n-grams, discounted shares, prefixes, suffixes, contexts, their weights."""
    parts = [_padded(folded(t)) for t in texts]
    codes = np.concatenate(parts)
    keep = np.ones(len(codes), dtype=bool)
    starts = np.cumsum([0] + [len(p) for p in parts[:-1]])
    for j in range(ORDER - 1):
        keep[starts + j] = False
    keep = keep[ORDER - 1 :]
    orders = {k: _Counts(codes, k, keep) for k in range(1, ORDER + 1)}
    out = {}
    for k, grams in orders.items():
        counts = grams.counts
        if k < ORDER:  # how many different characters come before
            ends, times = np.unique(orders[k + 1].suffix, return_counts=True)
            counts = np.zeros(len(grams.hashes))
            counts[np.searchsorted(grams.hashes, ends)] = times
            counts = np.maximum(counts, 1)
        once, twice = (counts == 1).sum(), (counts == 2).sum()
        discount = once / (once + 2 * twice) if once and twice else 0.5
        if k == 1:
            context, place = np.zeros(1, dtype=np.uint64), np.zeros(len(counts), dtype=np.int64)
        else:
            context, place = np.unique(grams.prefix, return_inverse=True)
        total = np.bincount(place, counts)
        share = np.maximum(counts - discount, 0) / total[place]
        weight = discount * np.bincount(place) / total
        out[k] = (grams.hashes, share, grams.prefix, grams.suffix, context, weight)
    return out


_MODEL = "lang string, k int, hashes binary, share binary, prefix binary, suffix binary"
_MODEL += ", context binary, weight binary"


def _train_language(sample: pd.DataFrame) -> pd.DataFrame:
    rows = [
        [sample["lang"].iloc[0], k, *(b"" if x is None else x.tobytes() for x in parts)]
        for k, parts in _train(sample["text"]).items()
    ]
    names = ["lang", "k", "hashes", "share", "prefix", "suffix", "context", "weight"]
    return pd.DataFrame(rows, columns=names)


def _place(sorted_hashes: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each hash is, and whether it is there at all."""
    if not len(sorted_hashes):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(sorted_hashes, wanted), len(sorted_hashes) - 1)
    return at, sorted_hashes[at] == wanted


@dataclass
class Models:
    """All languages' models: for each order sorted hashes, log probabilities, back-off weights.

    ``weights[k]`` belongs to the n-grams of order k as contexts of order k + 1.
    """

    langs: list[str]
    hashes: dict[int, np.ndarray]
    logs: dict[int, np.ndarray]
    weights: dict[int, np.ndarray]
    new: np.ndarray
    sharpness: float = 1.0
    usual: np.ndarray | None = None
    spread: np.ndarray | None = None
    spread_short: np.ndarray | None = None
    letters: np.ndarray | None = None

    @classmethod
    def of(cls, rows) -> Models:
        """From the rows of _train_language; probabilities of all languages are filled in."""
        langs = sorted({r["lang"] for r in rows})
        if not langs:
            return cls([], {}, {}, {}, np.zeros(0))
        given = {(r["lang"], r["k"]): r for r in rows}
        get = lambda lang, k, name, kind: np.frombuffer(given[lang, k][name], dtype=kind)
        # Contexts that nothing leads to, the padding before a text, have weights too.
        places = {k: [get(x, k, "hashes", np.uint64) for x in langs] for k in range(1, ORDER + 1)}
        for k in range(1, ORDER):
            places[k] += [get(x, k + 1, "context", np.uint64) for x in langs]
        hashes = {k: np.unique(np.concatenate(found)) for k, found in places.items()}
        new = np.array([get(x, 1, "weight", np.float64)[0] for x in langs]) * _NEW_CHARACTER
        weights = {
            k: np.ones((len(hashes[k]), len(langs)), dtype=np.float32) for k in range(1, ORDER)
        }
        for k in range(2, ORDER + 1):
            for i, x in enumerate(langs):
                at, there = _place(hashes[k - 1], get(x, k, "context", np.uint64))
                weights[k - 1][at[there], i] = get(x, k, "weight", np.float64)[there]
        below = np.zeros(0)
        logs = {}
        for k in range(1, ORDER + 1):
            p = np.zeros((len(hashes[k]), len(langs)))
            suffix = np.zeros(len(hashes[k]), dtype=np.int64)
            prefix = np.zeros(len(hashes[k]), dtype=np.int64)
            known = np.zeros(len(hashes[k]), dtype=bool)
            for i, x in enumerate(langs):
                at, _ = _place(hashes[k], get(x, k, "hashes", np.uint64))
                p[at, i] = get(x, k, "share", np.float64)
                if k > 1:
                    suffix[at], _ = _place(hashes[k - 1], get(x, k, "suffix", np.uint64))
                    place, there = _place(hashes[k - 1], get(x, k, "prefix", np.uint64))
                    prefix[at], known[at] = place, there
            if k == 1:
                p += new
            else:
                p += np.where(known[:, None], weights[k - 1][prefix], 1) * below[suffix]
            logs[k], below = np.log(p).astype(np.float32), p
        logged = {k: np.log(w) for k, w in weights.items()}
        letters = np.array([len(get(x, 1, "hashes", np.uint64)) for x in langs])
        return cls(langs, hashes, logs, logged, np.log(new), letters=letters)

    def _sums(self, codes: np.ndarray) -> np.ndarray:
        """Summed log probability of the characters from ``ORDER - 1`` on, by language."""
        grams = _hashes(codes, ORDER)
        ordered = np.sort(grams)
        starts = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
        distinct = ordered[starts]
        times = np.diff(np.append(starts, len(ordered)))
        at, there = _place(self.hashes[ORDER], distinct)
        total = times[there].astype(np.float64) @ self.logs[ORDER][at[there]]
        missing = distinct[~there]
        if len(missing):
            table = np.zeros(1 << 16, dtype=bool)
            table[(missing & np.uint64(0xFFFF)).astype(np.int64)] = True
            maybe = np.flatnonzero(table[(grams & np.uint64(0xFFFF)).astype(np.int64)])
            _, unseen = _place(missing, grams[maybe])
            total = total + self._backed_off(codes, maybe[unseen], ORDER)
        return total

    def _backed_off(self, codes: np.ndarray, places: np.ndarray, order: int) -> np.ndarray:
        """The same for places whose n-gram of this order is unseen in every language."""
        if not len(places):
            return np.zeros(len(self.langs))
        if order == 1:
            return len(places) * self.new
        # A place p ends at codes[p + ORDER - 1]; its context ends one before.
        context = _at(codes, places - 1, order - 1)
        at, there = _place(self.hashes[order - 1], context)
        total = self.weights[order - 1][at[there]].sum(axis=0, dtype=np.float64)
        at, there = _place(self.hashes[order - 1], _at(codes, places, order - 1))
        total = total + self.logs[order - 1][at[there]].sum(axis=0, dtype=np.float64)
        return total + self._backed_off(codes, places[~there], order - 1)

    def entropies(self, text: str | None) -> tuple[np.ndarray, int]:
        """Cross-entropy per character by language, and the number of characters.

        The number is 0 for texts without letters, and where no language was learned.
        """
        codes = folded(text or "")
        if not self.langs or not (codes != 32).any():
            return np.zeros(len(self.langs)), 0
        codes = _padded(codes)
        total = np.zeros(len(self.langs))
        for start in range(0, len(codes) - ORDER + 1, _PIECE):
            total += self._sums(codes[start : start + _PIECE + ORDER - 1])
        size = len(codes) - ORDER + 1
        return -total / size, size

    def judged(self, text: str | None) -> tuple[str, float, bool]:
        """Language, score from 0 to 1, and whether the text is rejected."""
        entropies, size = self.entropies(text)
        if not size or not self.langs:
            return UNKNOWN, 0.0, True
        best = int(entropies.argmin())
        odds = np.exp(-(entropies - entropies[best]) * size * self.sharpness)
        allowed = np.inf
        if self.usual is not None:
            per_text = self.spread[best] + self.spread_short[best] / np.sqrt(size)
            allowed = self.usual[best] + DEVIATIONS * per_text
        return self.langs[best], float(1 / odds.sum()), bool(entropies[best] > allowed)


def _at(codes: np.ndarray, places: np.ndarray, order: int) -> np.ndarray:
    """The n-gram of an order that ends at each of the places."""
    out = np.full(len(places), order, dtype=np.uint64)
    for j in range(order):
        out += codes[places + ORDER - 1 - j].astype(np.uint64) * _PLACES[j]
    return mixed(out)


def _measured(batches, models) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [models.value.entropies(t) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_pydict(
            {
                "lang": batch.column(0),
                "entropies": pa.array([e.tolist() for e, _ in found], pa.list_(pa.float64())),
                "size": pa.array([n for _, n in found], pa.int64()),
            }
        )


def _calibrated(models: Models, rows) -> Models:
    """Sharpness and limits from texts that were kept from the counts.

    A language with few such texts has the relative deviation of all languages; without
    any, or with few in all, it is allowed the cross-entropy of guessing among its letters.
    """
    n = len(models.langs)
    models.usual, models.spread = np.log(models.letters + 1.0), np.zeros(n)
    models.spread_short = np.zeros(n)
    rows = [r for r in rows if r["size"]]
    if not rows:
        return models
    place = {x: i for i, x in enumerate(models.langs)}
    right = np.array([place[r["lang"]] for r in rows])
    entropies = np.array([r["entropies"] for r in rows])
    sizes = np.array([r["size"] for r in rows], dtype=np.float64)
    above = entropies - entropies.min(axis=1)[:, None]
    losses = []
    for sharpness in _SHARPNESS:
        logs = -above * sizes[:, None] * sharpness
        logs = logs - np.log(np.exp(logs).sum(axis=1))[:, None]
        losses.append(-logs[np.arange(len(rows)), right].mean())
    models.sharpness = _SHARPNESS[int(np.argmin(losses))]
    known = [np.flatnonzero(right == i) for i in range(n)]
    usual = models.usual.copy()
    for i, at in enumerate(known):
        if len(at):
            usual[i] = np.average(entropies[at, i], weights=np.sqrt(sizes[at]))
    above = entropies[np.arange(len(rows)), right] - usual[right]
    several = np.concatenate([np.empty(0, np.int64), *(at for at in known if len(at) > 1)])
    pooled, pooled_sizes = above[several] / usual[right[several]], sizes[several]
    for i, at in enumerate(known):
        own, size, scale = above[at], sizes[at], 1.0
        if len(at) < _OWN_TEXTS:  # its usual cross-entropy is not well known either
            if not len(at) or len(several) < _OWN_TEXTS:
                continue
            own, size, scale = pooled, pooled_sizes, usual[i] * np.sqrt(1 + 1 / len(at))
        models.usual[i] = usual[i]
        models.spread[i] = scale * np.sqrt(np.average(own**2, weights=size))
        models.spread_short[i] = scale * np.sqrt(np.mean(own**2 * size))
    return models


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Models:
    """Models from the rows of ``docs`` that have a text and a language; a null key is a key.

    The sample of a language is bounded by SAMPLE_TEXTS and SAMPLE_CHARACTERS; its
    texts are cut to equal shares only if they have more characters. Repeated rows count once. No such rows give no languages.
    """
    spark = prepared(docs.sparkSession)
    # A row is known by its key and whole text: rows with one name are alike, any of them will do.
    given = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).alias("key"))
    given = given.dropna(subset=["text", "lang"])
    name = F.md5(F.concat(F.coalesce(F.col("key").cast("string"), F.lit("no key")), F.lit(":"), F.md5("text")))
    given = given.select("lang", "text", name.alias("name"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("name"))
    sizes = given.select("lang", "name", F.length("text").alias("size"))
    first = sizes.withColumn("rank", rank).filter(F.col("rank") <= SAMPLE_TEXTS)
    of_lang = Window.partitionBy("lang")
    share = F.floor(SAMPLE_CHARACTERS / F.count("*").over(of_lang)).cast("int")
    share = F.when(F.sum("size").over(of_lang) > SAMPLE_CHARACTERS, share)
    first = first.withColumn("share", share)
    chosen = first.groupBy("name", "lang").agg(F.min("rank").alias("rank"), F.min("share").alias("share"))
    chosen = small_or_not(stored(chosen, "chosen"), 64)
    sample = given.join(chosen, ["name", "lang"]).dropDuplicates(["name", "lang"])
    cut = F.coalesce(F.substring("text", F.lit(1), F.col("share")), F.col("text"))
    sample = stored(sample.withColumn("text", cut).drop("share"), "sample")
    # By rank, so that the first text of every language is counted.
    calibrates = F.col("rank") % _CALIBRATE == 0
    counted = sample.filter(~calibrates).groupBy("lang").applyInPandas(_train_language, _MODEL)
    models = Models.of(counted.collect())
    if models.langs:
        shared = spark.sparkContext.broadcast(models)
        kept = sample.filter(calibrates & F.col("lang").isin(models.langs)).select("lang", "text")
        kind = "lang string, entropies array<double>, size long"
        _calibrated(models, kept.mapInArrow(lambda b: _measured(b, shared), kind).collect())
    return models


def _judged(batches, models) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [models.value.judged(t) for t in batch.column(1).to_pylist()]
        langs, scores, rejected = zip(*found) if found else ((), (), ())
        yield pa.RecordBatch.from_pydict(
            {
                "key": batch.column(0),
                "lang_pred": pa.array(langs, pa.string()),
                "score": pa.array(scores, pa.float64()),
                "rejected": pa.array(rejected, pa.bool_()),
            }
        )


def identify(docs: DataFrame, models: Models, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: the key, lang_pred, score, rejected.

    Only the text is looked at, and all of it. Texts that are null or have no letter
    are ``und`` with score 0 and rejected; so is every text if no language was
    learned. Others get the language of the lowest cross-entropy, of equal ones the
    first by name, and are rejected if they are far above what its texts usually
    have. Repeated rows and null keys stay; no rows give no rows.
    """
    shared = prepared(docs.sparkSession).sparkContext.broadcast(models)
    given = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = given.schema["key"].dataType.simpleString()
    found = given.mapInArrow(
        lambda b: _judged(b, shared), f"key {kind}, lang_pred string, score double, rejected boolean"
    )
    return found.withColumnRenamed("key", key)


def _kept(batches, models, at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rejected = [models.value.judged(t)[2] for t in batch.column(at).to_pylist()]
        yield batch.filter(pa.array([not r for r in rejected], pa.bool_()))


def accepted(docs: DataFrame, models: Models, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose text is not rejected (see identify), with all their columns.

    One pass without a join, so repeated rows and null keys are judged each by its text.
    """
    shared = prepared(docs.sparkSession).sparkContext.broadcast(models)
    at = docs.columns.index(text)
    return docs.mapInArrow(lambda b: _kept(b, shared, at), docs.schema)
