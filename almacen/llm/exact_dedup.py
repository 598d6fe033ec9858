"""Exact dedup by an exchange of Golomb-coded fingerprints.

1. *Send.* Each partition takes the fingerprint (first 64 bits of the SHA-256)
   of its texts, sorts them and sends every owner, which holds a range of
   fingerprints, its share as Golomb codes: about two bytes a text at scale.
2. *Answer.* An owner merges the codes and answers each sender with a bitmap: the
   fingerprints that another partition holds too. A text that a sender holds
   twice is marked by the sender itself, so a hot text costs one code a sender.
3. *Verify.* Only suspects, texts with a marked fingerprint, are shuffled; they
   are grouped by SHA-256 and by their bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almacen.llm import golomb
from almacen.llm.stored import prepared, small_or_not, stored

_SENT = "sender long, part long, owner int, codes binary, twice binary"
#: A sender sends on after so many fingerprints; bounds its memory.
_SEND_AT = 1 << 20
_SUSPECT_BYTES = 16


def _fingerprint(sha):
    """The first 16 hex digits as a signed 64-bit number."""
    high = F.conv(F.substring(sha, 1, 8), 16, 10).cast("long")
    low = F.conv(F.substring(sha, 9, 8), 16, 10).cast("long")
    return F.shiftleft(high, 32).bitwiseOR(low)


def _owners_of(sorted_numbers: np.ndarray, owners: int) -> np.ndarray:
    """Bounds of each owner's range in sorted fingerprints."""
    starts = (np.arange(owners, dtype=object) * (1 << 64) // owners).astype(np.uint64)
    return np.append(np.searchsorted(sorted_numbers, starts), len(sorted_numbers))

#: Fingerprints of one owner.
_OWNED = 1 << 20


def _send(batches: Iterator[pa.RecordBatch], owners: int) -> Iterator[pa.RecordBatch]:
    sender = TaskContext.get().partitionId()
    held, part = [], 0

    def packed():
        numbers, counts = np.unique(np.concatenate(held), return_counts=True)
        cuts = _owners_of(numbers, owners)
        mine = [o for o in range(owners) if cuts[o] < cuts[o + 1]]
        ranges = [slice(cuts[o], cuts[o + 1]) for o in mine]
        return pa.RecordBatch.from_pydict(
            {
                "sender": pa.array([sender] * len(mine), pa.int64()),
                "part": pa.array([part] * len(mine), pa.int64()),
                "owner": pa.array(mine, pa.int32()),
                "codes": pa.array([golomb.encode(numbers[r]) for r in ranges], pa.binary()),
                "twice": pa.array(
                    [np.packbits(counts[r] > 1).tobytes() for r in ranges], pa.binary()
                ),
            }
        )

    for batch in batches:
        if batch.num_rows:
            held.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.uint64))
        if sum(map(len, held)) >= _SEND_AT:
            yield packed()
            held, part = [], part + 1
    if held:
        yield packed()


def _answer(codes: pd.DataFrame) -> pd.DataFrame:
    """For one owner: a bitmap for each sender of what others hold too."""
    lists = [golomb.decode(c) for c in codes["codes"]]
    every = np.sort(np.concatenate(lists))
    shared = np.unique(every[1:][every[1:] == every[:-1]])
    marks = [np.packbits(np.isin(x, shared, assume_unique=True)).tobytes() for x in lists]
    return codes[["sender", "part", "owner"]].assign(marks=marks)


def _suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A sender's marked fingerprints, from its own list and the bitmap it got back."""
    for batch in batches:
        found = [np.empty(0, dtype=np.uint64)]
        for codes, twice, marks in zip(*(batch.column(i).to_pylist() for i in range(3))):
            numbers = golomb.decode(codes)
            bits = np.frombuffer(twice, np.uint8) | np.frombuffer(marks, np.uint8)
            found.append(numbers[np.unpackbits(bits, count=len(numbers)).astype(bool)])
        numbers = np.concatenate(found).astype(np.int64)
        yield pa.RecordBatch.from_pydict({"fingerprint": pa.array(numbers, pa.int64())})


def suspect_fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """Fingerprints that more than one row holds, each once (column fingerprint)."""
    spark = prepared(docs.sparkSession)
    sha = F.sha2(F.coalesce(F.col(text), F.lit("")), 256)
    # As many owners as keep the lists of one at a few MB, however many texts there are.
    owners = max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.count() // _OWNED + 1)
    prints = docs.select(_fingerprint(sha).alias("fingerprint"))
    sent = stored(prints.mapInArrow(lambda b: _send(b, owners), _SENT), "sent")
    answers = (
        sent.select("sender", "part", "owner", "codes")
        .groupBy("owner")
        .applyInPandas(_answer, "sender long, part long, owner int, marks binary")
    )
    back = sent.join(answers, ["sender", "part", "owner"]).select("codes", "twice", "marks")
    return stored(back.mapInArrow(_suspects, "fingerprint long").distinct(), "suspects")


def _marked(docs: DataFrame, text: str) -> DataFrame:
    """The rows with _text, _sha and _suspect, which is null where no other row has the text."""
    suspects = suspect_fingerprints(docs, text).select(F.col("fingerprint").alias("_suspect"))
    content = F.coalesce(F.col(text), F.lit(""))
    rows = docs.withColumns({"_text": content, "_sha": F.sha2(content, 256)})
    suspects = small_or_not(suspects, _SUSPECT_BYTES)
    return rows.join(suspects, _fingerprint(F.col("_sha")) == F.col("_suspect"), "left")


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; null counts as empty. Of equal texts the
    row with the largest ``key`` stays; of rows repeated with the same key and text
    one stays. A null key counts as the smallest. Very long texts are read whole.
    Other columns are not looked at, whatever their names; no rows give no rows.
    """
    rows = _marked(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")), "text")
    rows = stored(
        rows.select(
            "doc_id",
            "_sha",
            F.col("_suspect").isNotNull().alias("suspect"),
            F.when(F.col("_suspect").isNotNull(), F.col("_text")).alias("_text"),
        ),
        "marked",
    )
    suspects = rows.filter("suspect")
    classes = suspects.groupBy("_sha", "_text").agg(
        F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")
    )
    # Rows of equal key and text, so that a hot text leaves one row for each key.
    repeats = suspects.groupBy("_sha", "_text", "doc_id").agg(F.count("*").alias("copies"))
    grouped = (
        repeats.join(classes, ["_sha", "_text"])
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
            F.col("_sha").alias("text_sha256"),
        )
    )
    alone = rows.filter("not suspect").select(
        "doc_id",
        F.col("doc_id").alias("keep_id"),
        F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )
    return alone.unionByName(grouped)


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row for each different text: the one with the largest ``key``.

    Of rows repeated with that key one stays, the one whose columns sort last; a null
    key counts as the smallest. The columns are those of ``docs``.
    """
    names = docs.columns
    row = F.struct(F.col(key).alias("k"), F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"))
    rows = _marked(docs.select(row.alias("row"), F.col(text).alias("text")), "text")
    alone = rows.filter("_suspect is null").select("row.row.*")
    best = rows.filter("_suspect is not null").groupBy("_sha", "_text").agg(F.max("row").alias("r"))
    return alone.unionByName(best.select("r.row.*"))
