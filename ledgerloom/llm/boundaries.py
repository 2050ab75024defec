"""A sorted set of offsets in Roaring style, with select.

Offsets are dealt by their high bits to containers of ``SPAN`` values.  A container holds the
low 16 bits as a sorted array, a bitmap or a list of runs, whichever is smallest.  Cumulative
cardinalities lead ``select`` to the container of the k-th offset; the container answers by
itself: an array by its place, a bitmap by the bit counts of its words and then of one word, runs
by their own cumulative lengths.
"""

from __future__ import annotations

import numpy as np

SPAN = 1 << 16
ARRAY, BITMAP, RUNS = "array", "bitmap", "runs"
_WORDS = SPAN // 64


def container(low: np.ndarray) -> tuple:
    """The smallest container of the sorted distinct values ``low``, all below ``SPAN``."""
    breaks = np.flatnonzero(np.diff(low) != 1)
    n_runs = len(breaks) + 1
    sizes = {ARRAY: 2 * len(low), BITMAP: SPAN // 8, RUNS: 4 * n_runs}
    kind = min(sizes, key=sizes.get)
    if kind == ARRAY:
        return kind, low.astype(np.uint16)
    if kind == RUNS:
        firsts = low[np.concatenate([[0], breaks + 1])]
        lasts = low[np.concatenate([breaks, [len(low) - 1]])]
        upto = np.cumsum(lasts - firsts + 1)
        return kind, firsts.astype(np.uint16), upto
    bits = np.zeros(SPAN, np.uint8)
    bits[low] = 1
    words = np.packbits(bits, bitorder="little").view(np.uint64)
    return kind, words, np.cumsum(np.bitwise_count(words).astype(np.int64))


def select_in(held: tuple, k: int) -> int:
    """The ``k``-th smallest value (from 0) of a container."""
    kind = held[0]
    if kind == ARRAY:
        return int(held[1][k])
    upto = held[2]
    at = int(np.searchsorted(upto, k, side="right"))
    left = k - (int(upto[at - 1]) if at else 0)
    if kind == RUNS:
        return int(held[1][at]) + left
    bits = np.unpackbits(held[1][at : at + 1].view(np.uint8), bitorder="little")
    return 64 * at + int(np.flatnonzero(bits)[left])


class BoundarySet:
    """``offsets``: sorted distinct integers from 0."""

    def __init__(self, offsets: np.ndarray) -> None:
        high = offsets // SPAN
        firsts = np.concatenate([[0], np.flatnonzero(np.diff(high)) + 1]) if len(offsets) else np.empty(0, np.int64)
        ends = np.append(firsts[1:], len(offsets)).astype(np.int64) if len(offsets) else firsts
        self.bases = high[firsts] * SPAN if len(offsets) else firsts
        self.containers = [container(offsets[a:b] - base) for a, b, base in zip(firsts, ends, self.bases)]
        self.upto = ends

    def __len__(self) -> int:
        return int(self.upto[-1]) if len(self.upto) else 0

    def select(self, k: int) -> int:
        """The ``k``-th smallest offset, from 0."""
        if not 0 <= k < len(self):
            raise IndexError(k)
        at = int(np.searchsorted(self.upto, k, side="right"))
        return int(self.bases[at]) + select_in(self.containers[at], k - (int(self.upto[at - 1]) if at else 0))

    def cuts(self, first: int, second: int) -> tuple[int, int]:
        """Where the first ``first`` and the first ``second`` units end, for offsets that are ends of units."""
        return self.select(first - 1) if first else 0, self.select(second - 1) if second else 0
