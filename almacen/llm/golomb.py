"""Golomb-Rice coding of sorted 64-bit numbers, vectorised.

Gaps are split by a power of two near their mean: the quotients go into one
stream in unary, the remainders into another at a fixed width. Layout: count
(8 bytes), width (1 byte), bytes of the unary stream (8 bytes), the streams.
"""

from __future__ import annotations

import numpy as np


def encode(numbers: np.ndarray) -> bytes:
    """Code of ascending uint64 numbers."""
    n = len(numbers)
    if not n:
        return bytes(17)
    gaps = np.diff(numbers, prepend=np.uint64(0))
    width = max(int(int(numbers[-1]) // n).bit_length() - 1, 0)
    quotients = (gaps >> np.uint64(width)).astype(np.int64)
    unary = np.zeros(int(quotients.sum()) + n, dtype=np.uint8)
    unary[np.cumsum(quotients + 1) - 1] = 1
    places = np.arange(width, dtype=np.uint64)
    rest = ((gaps[:, None] >> places) & np.uint64(1)).astype(np.uint8)
    first, second = np.packbits(unary).tobytes(), np.packbits(rest).tobytes()
    head = n.to_bytes(8, "little") + bytes([width]) + len(first).to_bytes(8, "little")
    return head + first + second


def decode(code: bytes) -> np.ndarray:
    n, width = int.from_bytes(code[:8], "little"), code[8]
    if not n:
        return np.empty(0, dtype=np.uint64)
    cut = 17 + int.from_bytes(code[9:17], "little")
    unary = np.unpackbits(np.frombuffer(code[17:cut], dtype=np.uint8))
    quotients = np.diff(np.flatnonzero(unary)[:n], prepend=-1) - 1
    rest = np.zeros(n, dtype=np.uint64)
    if width:
        bits = np.unpackbits(np.frombuffer(code[cut:], dtype=np.uint8), count=n * width)
        for k, bit in enumerate(bits.reshape(n, width).T):
            rest |= bit.astype(np.uint64) << np.uint64(k)
    gaps = (quotients.astype(np.uint64) << np.uint64(width)) | rest
    return np.cumsum(gaps, dtype=np.uint64)
