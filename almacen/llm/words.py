"""Words of texts as 64-bit hashes, computed for many texts at once with numpy.

A word is a maximal run of bytes other than space and U+0009 to U+000D; A-Z is
lower-cased. Whole texts are read; long ones go through in pieces that end
between words, so memory follows the piece and not the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are gathered into pieces of about this many bytes.
PIECE_BYTES = 1 << 20
#: Longer words are hashed one by one; they are rare.
_LONG_WORD = 1 << 12

_random = np.random.default_rng(20240917)
_BYTE_CODE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_CODE[ord("A") : ord("Z") + 1] = _BYTE_CODE[ord("a") : ord("z") + 1]
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE_CODE[_IS_SPACE] = 0
_POWERS = np.cumprod(np.full(_LONG_WORD, 0x9E3779B97F4A7C15, dtype=np.uint64))
_PLACE = _random.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all 64 (the finaliser of SplitMix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _long_word(word: bytes) -> int:
    lower = word.translate(bytes(c + 32 if 65 <= c <= 90 else c for c in range(256)))
    return int.from_bytes(hashlib.blake2b(lower, digest_size=8).digest(), "little")


def spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a byte array."""
    inside = np.empty(len(data) + 2, dtype=bool)
    inside[0] = inside[-1] = False
    np.logical_not(_IS_SPACE[data], out=inside[1:-1])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[0::2], edges[1::2]


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word."""
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    place = np.arange(starts[0], len(data), dtype=np.int64)
    place -= np.repeat(starts, np.diff(np.append(starts, len(data))))
    np.minimum(place, _LONG_WORD - 1, out=place)
    code = _BYTE_CODE[data[starts[0] :]] * _POWERS[place]
    lengths = ends - starts
    out = mixed(np.add.reduceat(code, starts - starts[0]) + lengths.astype(np.uint64))
    for i in np.flatnonzero(lengths > _LONG_WORD):
        out[i] = _long_word(data[starts[i] : ends[i]].tobytes())
    return out


def _cut(data: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in pieces that end between words."""
    start = 0
    while len(data) - start > PIECE_BYTES:
        end = start + PIECE_BYTES
        while end < len(data):
            space = np.flatnonzero(_IS_SPACE[data[end : end + PIECE_BYTES]])
            if len(space):
                end += int(space[0])
                break
            end = min(end + PIECE_BYTES, len(data))
        yield data[start:end]
        start = end
    yield data[start:]


def _flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array, and the bounds of its texts; null is empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    wide = pa.types.is_large_string(texts.type)
    bounds = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)
    bounds = bounds[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    return np.frombuffer(data or b"", dtype=np.uint8), bounds


def of_texts(texts: pa.Array, per_word=hashes) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text, words of several texts end to end, bounds of each text in them).

    ``per_word(bytes, starts, ends)`` gives one value, or one row, for each word.
    Consecutive texts come together as long as they are short.
    """
    if not len(texts):
        return
    data, bounds = _flat(texts)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(bounds, bounds[first] + PIECE_BYTES, side="right")) - 1
        last = min(max(last, first + 1), len(texts))
        part = data[bounds[first] : bounds[last]]
        if last == first + 1:
            pieces = [per_word(piece, *spans(piece)) for piece in _cut(part)]
            words = np.concatenate(pieces)
            yield first, words, np.array([0, len(words)])
        else:
            starts, ends, counts = _split_at(part, bounds[first : last + 1] - bounds[first])
            yield first, per_word(part, starts, ends), counts
        first = last


def _split_at(data: np.ndarray, bounds: np.ndarray):
    """Words that don't cross from one text into the next, and how many come before each bound."""
    starts, ends = spans(data)
    inner = np.unique(bounds[1:-1])
    at = np.searchsorted(starts, inner, side="right") - 1
    cut = inner[(at >= 0) & (starts[at] < inner) & (inner < ends[at])] if len(starts) else inner[:0]
    starts, ends = np.sort(np.append(starts, cut)), np.sort(np.append(ends, cut))
    return starts, ends, np.searchsorted(starts, bounds, side="left")


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words; of the whole sequence if it is shorter."""
    if not len(words):
        return np.empty(0, dtype=np.uint64)
    width = min(size, len(words))
    out = np.zeros(len(words) - width + 1, dtype=np.uint64)
    for k in range(width):
        out += words[k : k + len(out)] * _PLACE[k]
    return mixed(out + np.uint64(width))
