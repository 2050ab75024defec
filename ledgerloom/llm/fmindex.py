"""FM-index over a shard of word symbols, in numpy.

Symbol 0 separates: every separator differs from every other and is smaller than all words, so
no suffix is compared beyond it.  The Burrows-Wheeler text lies in a wavelet matrix whose bit
rows carry block ranks; positions are sampled every ``SAMPLE`` words and after each separator,
so a walk back to the next sample never crosses one.
"""

from __future__ import annotations

import numpy as np

SAMPLE = 8


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffix order by prefix doubling; only groups that are still tied are sorted again."""
    n = len(symbols)
    ends = symbols == 0
    first = symbols.astype(np.int64) + int(ends.sum())
    first[ends] = np.arange(int(ends.sum()))
    sa = np.argsort(first, kind="stable")
    rank = np.empty(n, np.int64)

    def ranked(slots: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """Give each group of equal keys its first slot as rank; the slots of groups over one."""
        new = np.ones(len(slots), bool)
        new[1:] = keys[1:] != keys[:-1]
        starts = np.flatnonzero(new)
        sizes = np.diff(np.append(starts, len(slots)))
        rank[sa[slots]] = np.repeat(slots[starts], sizes)
        return slots[np.repeat(sizes > 1, sizes)]

    tied, h = ranked(np.arange(n), first[sa]), 1
    while len(tied):
        at = sa[tied]
        key = rank[at] * np.int64(n) + rank[at + h]
        order = np.argsort(key, kind="stable")
        sa[tied] = at[order]
        tied, h = ranked(tied, key[order]), h * 2
    return sa


class WaveletMatrix:
    """Rank and access over small integers; one bit row a level."""

    def __init__(self, values: np.ndarray, bits: int):
        self.bits, self.rows, self.before, self.zeros = bits, [], [], []
        for level in range(bits - 1, -1, -1):
            bit = ((values >> level) & 1).astype(bool)
            packed = np.packbits(bit, bitorder="little")
            packed = np.pad(packed, (0, 8 - len(packed) % 8)).view(np.uint64)
            counts = np.bitwise_count(packed)
            self.rows.append(packed)
            self.before.append(np.concatenate([[0], np.cumsum(counts, dtype=np.int64)]).astype(np.int32))
            self.zeros.append(int(len(values) - bit.sum()))
            values = np.concatenate([values[~bit], values[bit]])

    def _ones(self, k: int, i: np.ndarray) -> np.ndarray:
        block, rest = i >> 6, (i & 63).astype(np.uint64)
        low = self.rows[k][block] & ((np.uint64(1) << rest) - np.uint64(1))
        return self.before[k][block] + np.bitwise_count(low).astype(np.int64)

    def rank(self, value: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``value`` stands before place ``i``."""
        start = np.zeros_like(i)
        for k in range(self.bits):
            bit = ((value >> (self.bits - 1 - k)) & 1).astype(bool)
            one_s, one_i = self._ones(k, start), self._ones(k, i)
            start = np.where(bit, self.zeros[k] + one_s, start - one_s)
            i = np.where(bit, self.zeros[k] + one_i, i - one_i)
        return i - start

    def access_rank(self, i: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The value at place ``i`` and how often it stands before."""
        value, start = np.zeros_like(i), np.zeros_like(i)
        for k in range(self.bits):
            bit = ((self.rows[k][i >> 6] >> (i & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)
            one_s, one_i = self._ones(k, start), self._ones(k, i)
            start = np.where(bit, self.zeros[k] + one_s, start - one_s)
            i = np.where(bit, self.zeros[k] + one_i, i - one_i)
            value = value * 2 + bit
        return value, i - start


class FMIndex:
    def __init__(self, symbols: np.ndarray, n_symbols: int):
        """``symbols`` ends with 0; words are 1 to n_symbols - 1."""
        sa = suffix_array(symbols)
        self.less = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=n_symbols))])
        self.bwt = WaveletMatrix(symbols[sa - 1].astype(np.int64), max(1, int(n_symbols - 1).bit_length()))
        kept = (sa % SAMPLE == 0) | (symbols[sa - 1] == 0)
        self.kept = kept
        self.slot = np.cumsum(kept, dtype=np.int32) - 1
        self.places = sa[kept].astype(np.int32)

    def ranges(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of all phrases (right-aligned in rows of symbols), by backward search."""
        n, width = len(self.kept), phrases.shape[1] if len(phrases) else 0
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), n, np.int64)
        for back in range(1, width + 1):
            live = np.flatnonzero((lo < hi) & (lengths >= back))
            if not len(live):
                break
            c = phrases[live, width - back].astype(np.int64)
            both = self.bwt.rank(np.concatenate([c, c]), np.concatenate([lo[live], hi[live]]))
            lo[live], hi[live] = self.less[c] + both[: len(c)], self.less[c] + both[len(c) :]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of rows: step back to the next sampled place, then add the steps."""
        rows, out, steps = rows.astype(np.int64), np.empty(len(rows), np.int64), 0
        open_ = np.arange(len(rows))
        while len(open_):
            at = rows[open_]
            done = self.kept[at]
            out[open_[done]] = self.places[self.slot[at[done]]] + steps
            open_, at = open_[~done], at[~done]
            if len(open_):
                value, before = self.bwt.access_rank(at)
                rows[open_] = self.less[value] + before
            steps += 1
        return out
