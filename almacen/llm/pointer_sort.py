"""Multikey quicksort of pointers into one byte array.

The symbol of a pointer at a depth is the eight bytes found there as a number,
zero beyond the pointer's end. All pointers are sorted by their first symbol;
slices that are equal so far are sorted by the next one, until every slice has
ended or the limit is reached. Slices of two, by far the most, are only swapped.
"""

from __future__ import annotations

import numpy as np

_STEP = 8
#: The first n of eight bytes.
_FIRST = np.array([(1 << 64) - (1 << (64 - 8 * n)) for n in range(9)], dtype=np.uint64)


def symbols_of(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a big-endian number; zeros follow the data."""
    padded = np.zeros(len(data) + _STEP, dtype=np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 1,), dtype=">u8", buffer=padded, strides=(1,))


def symbols(view: np.ndarray, starts: np.ndarray, sizes: np.ndarray, depth: int) -> np.ndarray:
    """The symbol of each pointer at a depth."""
    left = sizes - depth
    at = np.minimum(starts + depth, len(view) - 1)
    return view[at].astype(np.uint64) & _FIRST[np.clip(left, 0, _STEP)]


def _in_slices(keys: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray | None:
    """Order of the keys within each slice; None where all slices are in order."""
    ordered = np.append(True, keys[1:] >= keys[:-1])
    ordered[starts] = True
    wrong = np.flatnonzero(~ordered)
    if not len(wrong):
        return None
    order = np.arange(len(keys))
    dirty = np.zeros(len(starts), dtype=bool)
    dirty[np.searchsorted(starts, wrong, side="right") - 1] = True
    first = starts[dirty & (counts == 2)]
    order[first], order[first + 1] = first + 1, first
    longer = np.flatnonzero(dirty & (counts > 2))
    if len(longer):
        inside = np.flatnonzero(np.repeat(dirty & (counts > 2), counts))
        slices = np.repeat(longer, counts[longer])
        order[inside] = inside[np.lexsort((keys[inside], slices))]
    return order


def sort_pointers(
    view: np.ndarray, starts: np.ndarray, sizes: np.ndarray, limit: int | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """Order of the pointers, and whether each equals the one before it in that order.

    A pointer is the ``sizes`` bytes at its start, none of them zero; only the first
    ``limit`` bytes (a multiple of eight) are looked at.
    """
    keys = symbols(view, starts, sizes, 0)
    order = np.argsort(keys)
    keys = keys[order]
    same = np.zeros(len(order), dtype=bool)
    same[1:] = keys[1:] == keys[:-1]
    at, depth = np.arange(len(order)), _STEP
    while len(at) and (limit is None or depth < limit):
        # Slices of two or more in which something is left.
        starts_at = np.flatnonzero(~same[at])
        counts = np.diff(np.append(starts_at, len(at)))
        longest = np.maximum.reduceat(sizes[order[at]], starts_at)
        open_ones = (counts > 1) & (longest > depth)
        at, counts = at[np.repeat(open_ones, counts)], counts[open_ones]
        if not len(at):
            break
        starts_at = np.cumsum(counts) - counts
        inside = order[at]
        keys = symbols(view, starts[inside], sizes[inside], depth)
        within = _in_slices(keys, starts_at, counts)
        if within is not None:
            order[at] = inside[within]
            keys = keys[within]
        equal = np.append(True, keys[1:] == keys[:-1])
        same[at] &= equal
        depth += _STEP
    return order, same
