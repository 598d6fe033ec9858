"""Two-stage suffix sorting of many short pieces of text, up to a depth.

Pieces lie end to end with a zero byte after each. Of two neighbouring suffixes,
those smaller than their successor are sorted directly; the others follow by
scanning the buckets of first bytes from the smallest on: the suffix before a
sorted one, if it is larger, comes next in the bucket of its own first byte. A
bucket first takes what smaller buckets induced, then, round by round, what these
suffixes induce in the bucket itself, then its directly sorted suffixes.
"""

from __future__ import annotations

import numpy as np

from almacen.llm.pointer_sort import sort_pointers, symbols_of


def joined(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all pieces, one higher each, with a zero after every piece; where each ends."""
    ends = np.cumsum([len(p) + 1 for p in pieces], dtype=np.int64) - 1
    data = np.frombuffer(b"\0".join(pieces) + b"\0", dtype=np.uint8)
    # 0xFF is in no UTF-8 text.
    data = np.minimum(data, 0xFE) + np.uint8(1)
    data[ends] = 0
    return data, ends


def _smaller_than_next(data: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the zeros between pieces are."""
    differs = np.append(data[1:] != data[:-1], True)
    # A run of one byte is decided where it ends.
    last = np.flatnonzero(differs)
    smaller = np.append(data[1:], 0)[last] > data[last]
    smaller = np.repeat(smaller, np.diff(np.append(-1, last)))
    smaller[data == 0] = True
    return smaller


def suffix_array(data: np.ndarray, ends: np.ndarray, depth: int) -> np.ndarray:
    """All suffixes of the pieces in the order of their first ``depth`` bytes at least."""
    smaller = _smaller_than_next(data)
    view = symbols_of(data)
    left = np.repeat(ends, np.diff(np.append(-1, ends))) - np.arange(len(data))
    direct = np.flatnonzero(smaller & (data > 0))
    order, _ = sort_pointers(view, direct, left[direct], depth)
    direct = direct[order]
    first = data[direct]
    bounds = np.searchsorted(first, np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]

    def induce(scanned: np.ndarray, own: int) -> np.ndarray:
        """Hand the larger suffixes before these to their buckets; those of this bucket come back."""
        before = scanned[scanned > 0] - 1
        before = before[~smaller[before]]
        byte = data[before]
        mine = before[byte == own]
        others = byte != own
        before, byte = before[others], byte[others]
        by_byte = np.argsort(byte, kind="stable")
        before, byte = before[by_byte], byte[by_byte]
        cuts = np.flatnonzero(np.append(True, byte[1:] != byte[:-1])) if len(byte) else []
        for i, j in zip(cuts, [*cuts[1:], len(byte)]):
            induced[byte[i]].append(before[i:j])
        return mine

    induce(ends, 0)
    parts = [ends]
    for byte in range(1, 256):
        mine = np.concatenate(induced[byte]) if induced[byte] else np.empty(0, np.int64)
        while len(mine):
            parts.append(mine)
            mine = induce(mine, byte)
        straight = direct[bounds[byte] : bounds[byte + 1]]
        if len(straight):
            parts.append(straight)
            induce(straight, byte)
    return np.concatenate(parts)


def common_prefix_reaches(data, ends, order: np.ndarray, depth: int) -> np.ndarray:
    """Of sorted suffixes of at least ``depth`` bytes, whether each has that many in common with the one before."""
    view = symbols_of(data)
    same = np.zeros(len(order), dtype=bool)
    at = np.arange(1, len(order))
    for k in [*range(0, depth - 8, 8), depth - 8]:
        at = at[view[order[at] + k] == view[order[at - 1] + k]]
    same[at] = True
    return same
