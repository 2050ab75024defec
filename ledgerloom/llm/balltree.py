"""Ball trees over sparse rows, searched for exactly the largest inner products.

The rows of a node are a run of the arranged rows: node ``i`` of level ``l`` has rows ``i * n >> l``
to ``(i + 1) * n >> l``.  ``arrange`` finds an order in which near rows stand together; ``Balls``
measures, for given values, centres and radii of the nodes, whatever the order was made from.

Most of a row's columns aren't in a query, and one radius over all columns would count them.  So the
columns are dealt to parts, and a node has a radius in each: with centre c, no row x of it has an
inner product with q above <q, c> + the sum over parts of |q in the part| * radius in the part.
A leaf's radii are measured; those of other nodes follow from their children's (the child's
radius and the way from centre to centre).

Sums of n doubles are off by less than n * 2.3e-16 of the sum of magnitudes; ``SLACK`` is far
above that for rows of up to a million values, and is added to squared distances, radii and
bounds, so a rounded bound is never below the true one.  Scores are sums of 64-bit integers.
"""

from __future__ import annotations

import heapq

import numpy as np

LEAF_ROWS = 16
PARTS = 2048
#: leaves opened together
STEP = 32
SLACK = 1e-9


def depth_of(n: int, leaf_rows: int = LEAF_ROWS) -> int:
    """Levels below the root, so that leaves hold about ``leaf_rows``."""
    return max(0, int(np.ceil(np.log2(max(n, 1) / leaf_rows))))


def edges(n: int, level: int) -> np.ndarray:
    return np.arange((1 << level) + 1, dtype=np.int64) * n >> level


def row_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the runs that begin at ``starts`` (n + 1 places); an empty run gives 0."""
    out = np.zeros(len(starts) - 1, values.dtype)
    some = starts[:-1] < starts[1:]
    if some.any():
        out[some] = np.add.reduceat(values, starts[:-1][some])
    return out


def spread_runs(firsts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """All integers of the runs ``firsts`` to ``ends`` (exclusive), one after another."""
    sizes = ends - firsts
    return np.repeat(firsts - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))


def arrange(starts: np.ndarray, cols: np.ndarray, values: np.ndarray, n_cols: int, depth: int) -> np.ndarray:
    """The order of rows: each node is cut at the median along the line from its longest row to the row
    farthest from that one."""
    n = len(starts) - 1
    order, starts, cols, values = np.arange(n), starts.copy(), cols.copy(), values.copy()
    line = np.zeros(n_cols)
    for level in range(depth):
        at = edges(n, level)
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            if b - a < 2:
                continue
            s, e = starts[a], starts[b]
            c, v, local = cols[s:e], values[s:e], starts[a : b + 1] - s
            norms = row_sums(v * v, local)
            one = int(np.argmax(norms))
            mine = slice(local[one], local[one + 1])
            line[c[mine]] = v[mine]
            two = int(np.argmax(norms - 2 * row_sums(v * line[c], local)))
            other = slice(local[two], local[two + 1])
            line[c[other]] -= v[other]
            place = np.argsort(row_sums(v * line[c], local), kind="stable")
            line[c[mine]] = 0
            line[c[other]] = 0
            sizes = np.diff(local)[place]
            to = np.concatenate([[0], np.cumsum(sizes)])
            take = spread_runs(local[:-1][place], local[1:][place])
            cols[s:e], values[s:e], starts[a : b + 1] = c[take], v[take], s + to
            order[a:b] = order[a:b][place]
    return order


class Balls:
    """Centres and radii of all nodes (node ``i`` of level ``l`` has number ``2^l - 1 + i``) of arranged rows, whose columns ascend."""

    def __init__(self, starts: np.ndarray, cols: np.ndarray, values: np.ndarray, n_cols: int, depth: int, parts: int = PARTS) -> None:
        n = len(starts) - 1
        self.n, self.depth, parts = n, depth, min(parts, n_cols)
        self.part = np.arange(n_cols) * parts // n_cols
        firsts = np.searchsorted(self.part, np.arange(parts))
        within = lambda dense: np.add.reduceat(dense * dense, firsts, axis=1)  # noqa: E731  squared length in each part

        at = edges(n, depth)
        row = np.repeat(np.arange(n), np.diff(starts))
        leaf = np.searchsorted(at, row, side="right") - 1
        sums = np.bincount(leaf * n_cols + cols, values, (1 << depth) * n_cols).reshape(1 << depth, n_cols)
        centre = sums / np.diff(at)[:, None]
        square = within(centre)
        # rows without a value in a part are as far as the centre is long; the others are measured
        most = square.ravel().copy()
        pair = row * parts + self.part[cols]
        first = np.flatnonzero(np.diff(pair, prepend=-1))
        if len(first):
            own, cross = np.add.reduceat(values * values, first), np.add.reduceat(values * centre[leaf, cols], first)
            cell = leaf[first] * parts + self.part[cols[first]]
            np.maximum.at(most, cell, own - 2 * cross + square.ravel()[cell] + SLACK * (own + square.ravel()[cell]))
        radius = np.sqrt(most.reshape(1 << depth, parts) * (1 + SLACK))
        centres, radii = [centre], [radius]
        for level in range(depth - 1, -1, -1):
            sums = sums[0::2] + sums[1::2]
            above = sums / np.diff(edges(n, level))[:, None]
            reach = radius + np.sqrt(within(centre - np.repeat(above, 2, axis=0)))
            centre, radius = above, np.maximum(reach[0::2], reach[1::2]) * (1 + SLACK)
            centres.append(centre)
            radii.append(radius)
        self.centres = np.ascontiguousarray(np.concatenate(centres[::-1]).T)
        self.radii = np.ascontiguousarray(np.concatenate(radii[::-1]).T)

    def bounds(self, cols: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """No row of a node has a larger inner product with the query (ascending ``cols``) than its bound."""
        part = self.part[cols]
        first = np.flatnonzero(np.diff(part, prepend=-1))
        length = np.sqrt(np.add.reduceat(weights * weights, first))
        return (weights @ self.centres[cols] + length @ self.radii[part[first]]) * (1 + SLACK) + SLACK

    def leaves(self, bounds: np.ndarray, least: float):
        """Up to ``STEP`` leaves at a time (first rows, last rows + 1), largest bounds first; send the score below which nothing matters, ``least`` at first."""
        heap, deep = [(-float(bounds[0]), 0)], (1 << self.depth) - 1
        bounds = bounds.tolist()
        while heap and -heap[0][0] >= least:
            found = []
            while heap and len(found) < STEP and -heap[0][0] >= least:
                _, node = heapq.heappop(heap)
                if node >= deep:
                    found.append(node - deep)
                    continue
                for child in (2 * node + 1, 2 * node + 2):
                    if bounds[child] >= least:
                        heapq.heappush(heap, (-bounds[child], child))
            if found:
                i = np.array(sorted(found))
                least = yield i * self.n >> self.depth, (i + 1) * self.n >> self.depth
