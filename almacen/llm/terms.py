"""Terms of texts: maximal runs of kept bytes, A-Z in lower case, found for many texts at once.

Every byte of a character beyond ASCII is kept, so runs of bytes and runs of
characters are the same. Other bytes become spaces first; then terms are words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

from almacen.llm import words

_LETTERS = [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
_DIGITS = [*range(0x30, 0x3A)]


def _folding(kept: list[int]) -> np.ndarray:
    table = np.full(256, 0x20, dtype=np.uint8)
    table[kept] = kept
    table[0x41:0x5B] += 0x20
    return table


#: For each byte what it becomes: terms of letters, or of letters and digits.
LETTERS = _folding(_LETTERS)
LETTERS_AND_DIGITS = _folding(_LETTERS + _DIGITS)


def flat(texts: pa.Array, folding: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array, folded, and the bounds of its texts; null is empty."""
    data, bounds = words._flat(texts)
    data = folding[data[bounds[0] : bounds[-1]]] if len(bounds) > 1 else data[:0]
    return data, bounds - bounds[0]


def spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the terms, and how many come before each bound."""
    return words._split_at(data, bounds)


def folded(texts: pa.Array, folding: np.ndarray) -> pa.Array:
    """The same texts with their bytes folded, for words.of_texts."""
    data, bounds = flat(texts, folding)
    return pa.LargeStringArray.from_buffers(
        len(texts), pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(data)
    )
