"""Byte-level BPE: the vocabulary of ranks as a sentencepiece BPE model.

The model is serialised straight from the vocabulary. Each byte becomes one
letter of a block without spaces or case, a token becomes the string of its
bytes' letters, with its negative rank as score, and nothing is normalised; so
sentencepiece merges the adjacent pair of lowest rank, leftmost first, as the
ranks ask for. Matches of the pattern are encoded separately; one that is itself
a token is that token. Decoding maps the letters back to bytes.

The model, a few MB whatever the input, is broadcast; texts stay in their
partitions, and nothing is shuffled.
"""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import sentencepiece
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almacen.llm.stored import prepared

#: Byte b is the letter U+0100 + b.
_FIRST_LETTER = 0x100
_LETTERS = {b: _FIRST_LETTER + b for b in range(256)}
#: Field numbers and values of the public sentencepiece model format.
_NORMAL, _UNKNOWN, _BPE = 1, 2, 2
#: A worker forgets its encoded matches beyond so many.
_REMEMBERED = 200_000


def read_ranks(path: str) -> dict[bytes, int]:
    """Tokens and ranks of a tiktoken file: base64 of the bytes, a space, the rank."""
    with open(path, "rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def _varint(n: int) -> bytes:
    n &= (1 << 64) - 1
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    return bytes([*out, n])


def _number(field: int, n: int) -> bytes:
    return _varint(field << 3) + _varint(n)


def _block(field: int, content: bytes) -> bytes:
    return _varint(field << 3 | 2) + _varint(len(content)) + content


def _piece(text: str, score: float, kind: int) -> bytes:
    score_bytes = _varint(2 << 3 | 5) + struct.pack("<f", score)
    return _block(1, _block(1, text.encode()) + score_bytes + _number(3, kind))


def _as_letters(data: bytes) -> str:
    return data.decode("latin-1").translate(_LETTERS)


@lru_cache(maxsize=1)
def newer_letters() -> str:
    """Letters and numbers of ``regex`` that tiktoken's regular expressions don't know yet.

    Both follow Unicode, in different versions. Only texts with such a character
    are affected; tiktoken is asked by splitting one text of all characters.
    """
    every = "".join(chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000)
    byte_ranks = {bytes([b]): b for b in range(256)}
    known: set[str] = set()
    for kind in (r"\p{L}", r"\p{N}"):
        engine = tiktoken.Encoding(
            "classes", pat_str=kind, mergeable_ranks=byte_ranks, special_tokens={}
        )
        known |= set(bytes(engine.encode_ordinary(every)).decode())
    return "".join(sorted(set(regex.findall(r"[\p{L}\p{N}]", every)) - known))


def model_proto(ranks: dict[bytes, int]) -> bytes:
    """A sentencepiece model; its piece 0 is the unknown one, others follow by rank."""
    pieces = [_piece("<unk>", 0.0, _UNKNOWN)]
    for token, rank in sorted(ranks.items(), key=lambda x: x[1]):
        pieces.append(_piece(_as_letters(token), -float(rank), _NORMAL))
    trainer = _number(3, _BPE) + _number(4, len(pieces))
    trainer += _number(40, 0) + _number(41, -1) + _number(42, -1) + _number(43, -1)
    normaliser = _block(1, b"identity") + _number(3, 0) + _number(4, 0) + _number(5, 0)
    return b"".join(pieces) + _block(2, trainer) + _block(3, normaliser)


@dataclass(frozen=True)
class Vocabulary:
    """What workers need: the model, the rank of each piece and the pattern."""

    proto: bytes
    tokens: list[bytes]
    ranks: list[int]
    pattern: str
    newer: str

    @classmethod
    def load(cls, path: str, pattern: str) -> Vocabulary:
        ranks = read_ranks(path)
        if missing := [b for b in range(256) if bytes([b]) not in ranks]:
            raise ValueError(f"the vocabulary lacks bytes {missing}")
        order = sorted(ranks, key=ranks.get)
        return cls(model_proto(ranks), order, [ranks[t] for t in order], pattern, newer_letters())


class _Encoder(dict):
    """The ids of each match, as packed unsigned 32-bit numbers."""

    def __init__(self, v: Vocabulary):
        self.model = sentencepiece.SentencePieceProcessor(model_proto=v.proto)
        self.whole = {t: r for t, r in zip(v.tokens, v.ranks)}
        self.rank_of = np.array([0, *v.ranks], dtype="<u4")
        self.find = regex.compile(v.pattern).findall
        self.newer = frozenset(v.newer)
        self.find_older = self.find
        if v.newer:
            older = regex.sub(r"\\p\{[LN]\}", lambda m: f"[{m[0]}--[{v.newer}]]", v.pattern)
            self.find_older = regex.compile(older, regex.VERSION1).findall

    def __missing__(self, match: str) -> bytes:
        data = match.encode("utf-8", "surrogatepass")
        rank = self.whole.get(data)
        if rank is None:
            ids = self.rank_of[self.model.encode(_as_letters(data))]
        else:
            ids = np.array([rank], dtype="<u4")
        self[match] = packed = ids.tobytes()
        return packed

    def encode(self, text: str) -> bytes:
        if len(self) > _REMEMBERED:
            self.clear()
        plain = text.isascii() or self.newer.isdisjoint(text)
        return b"".join(map(self.__getitem__, (self.find if plain else self.find_older)(text)))


def _encoded(batches, vocabulary: Broadcast) -> Iterator[pa.RecordBatch]:
    encoder = _Encoder(vocabulary.value)
    for batch in batches:
        ids = [encoder.encode(t or "") for t in batch.column(1).to_pylist()]
        sizes = pa.array([len(x) // 4 for x in ids], pa.int64())
        columns = [batch.column(0), sizes, pa.array(ids, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "n_tokens", "ids"])


def _decoded(batches, vocabulary: Broadcast) -> Iterator[pa.RecordBatch]:
    v = vocabulary.value
    token = dict(zip(v.ranks, v.tokens))
    for batch in batches:
        out = []
        for packed in batch.column(2).to_pylist():
            ids = np.frombuffer(packed or b"", dtype="<u4").tolist()
            out.append(b"".join(map(token.__getitem__, ids)))
        columns = [*batch.columns[:3], pa.array(out, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["key", "n_tokens", "ids", "bytes"])


class ByteBpe:
    """Encoder and decoder of one vocabulary, for DataFrames."""

    def __init__(self, spark, path: str, pattern: str):
        prepared(spark)
        self.vocabulary = spark.sparkContext.broadcast(Vocabulary.load(path, pattern))

    def encode(self, docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
        """One row for each row of ``docs``: the key, n_tokens, ids.

        ids holds the tokens as little-endian unsigned 32-bit numbers. Null counts as
        empty and has no tokens; special tokens have no meaning, their names are plain
        text. Texts of any length are encoded whole; repeated rows and null keys stay
        as they are; other columns are not looked at; no rows give no rows.
        """
        vocabulary = self.vocabulary
        given = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
        kind = given.schema["key"].dataType.simpleString()
        ids = given.mapInArrow(
            lambda b: _encoded(b, vocabulary), f"key {kind}, n_tokens long, ids binary"
        )
        return ids.withColumnRenamed("key", key)

    def decode(self, ids: DataFrame, key: str = "doc_id") -> DataFrame:
        """``ids`` as encode returns them, and their bytes; null ids are empty."""
        vocabulary = self.vocabulary
        given = ids.select(F.col(key).alias("key"), "n_tokens", "ids")
        kind = given.schema["key"].dataType.simpleString()
        found = given.mapInArrow(
            lambda b: _decoded(b, vocabulary),
            f"key {kind}, n_tokens long, ids binary, bytes binary",
        )
        return found.withColumnRenamed("key", key)
