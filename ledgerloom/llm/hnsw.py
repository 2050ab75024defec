"""Hierarchical navigable small-world graphs in flat numpy arrays.

Nearness is the largest inner product.  For building, a vector gets one more component that
brings all to the same length, so that "nearest" is symmetric; queries get 0 there.  A node's
links are spread over its nearest members of the layer; queries are answered in batches that walk
the graph in step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

LINKS = 32
BUILD_BEAM = 96
SEARCH_BEAM = 256
BATCH = 512
STRIDE = 16
ENTRIES = 32
SLICE_BYTES = 16 << 20  # of what is gathered at a time
CACHE_BYTES = 1 << 20  # of vectors gathered for their products


def levels_of(ids: np.ndarray, links: int = LINKS) -> np.ndarray:
    """The top layer of each node, from a hash of its id."""
    x = (ids.astype(np.int64).view(np.uint64) + np.uint64(0x632BE59BD9B4E019)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    u = ((x ^ (x >> np.uint64(29))) >> np.uint64(11)).astype(np.float64) / (1 << 53)
    return np.floor(-np.log(np.maximum(u, 1e-18)) / np.log(links)).astype(np.int64)


def sliced(n: int, row_bytes: int, most: int | None = None, size: int = SLICE_BYTES) -> Iterator[slice]:
    """Slices of ``n`` rows, of about ``size`` bytes and at most ``most`` rows each."""
    step = max(1, min(most or n, size // max(1, row_bytes)))
    return (slice(a, a + step) for a in range(0, n, step))


def products(one: np.ndarray, i: np.ndarray, other: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of the rows ``i`` of one array with the rows ``j`` of the other, gathered a slice at a time."""
    out = np.empty(len(i), np.result_type(one, other))
    for a in sliced(len(i), one[:1].nbytes, size=CACHE_BYTES):
        out[a] = np.einsum("ed,ed->e", one.take(i[a], axis=0), other.take(j[a], axis=0))
    return out


def walk(vectors: np.ndarray, graph: np.ndarray, queries: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """Best nodes and inner products of each query, best first (-1 where there are fewer).

    ``entry`` has one or more starting nodes a query; each step opens the ``STRIDE`` best closed
    nodes of every beam at once.
    """
    b, n = len(queries), len(vectors)
    reached = np.zeros((b, n + 1), np.int32)  # when a query reached a node; node -1, in the first place, counts as reached
    reached[:, 0] = -1
    flat = reached.ravel()
    nodes, score, opened = np.full((b, beam), -1, np.int64), np.full((b, beam), -np.inf, np.float32), np.zeros((b, beam), bool)
    stride, clock = min(STRIDE, beam), 0
    row, near = np.repeat(np.arange(b), entry.shape[1]), entry.ravel()
    while True:
        place = row * (n + 1) + near + 1
        fresh = np.flatnonzero(flat.take(place) == 0)
        row, near, place = row.take(fresh), near.take(fresh), place.take(fresh)
        turn = np.arange(clock + 1, clock + 1 + len(near), dtype=np.int32)
        clock += len(near)
        flat[place] = turn
        once = np.flatnonzero(flat.take(place) == turn)  # a node reached twice in one step counts once
        row, near = row.take(once), near.take(once)
        found = products(vectors, near, queries, row)
        better = found > score[:, -1][row] if clock > len(turn) else np.ones(len(near), bool)
        row, near, found = row[better], near[better], found[better]
        if len(row):
            some, first, counts = np.unique(row, return_index=True, return_counts=True)
            width = int(counts.max())
            line, place = np.repeat(np.arange(len(some)), counts), np.arange(len(row)) - np.repeat(first, counts)
            more = lambda kept, new: np.concatenate([kept[some], new], axis=1)
            new_nodes, new_score = np.full((len(some), width), -1, np.int64), np.full((len(some), width), -np.inf, np.float32)
            new_nodes[line, place], new_score[line, place] = near, found
            all_score = more(score, new_score)
            best = np.argsort(-all_score, axis=1, kind="stable")[:, :beam]
            score[some] = np.take_along_axis(all_score, best, 1)
            nodes[some] = np.take_along_axis(more(nodes, new_nodes), best, 1)
            opened[some] = np.take_along_axis(more(opened, np.zeros((len(some), width), bool)), best, 1)
        closed = ~opened & (nodes >= 0)
        order = np.cumsum(closed, axis=1)
        row, place = np.nonzero(closed & (order <= stride))
        if not len(row):
            return nodes, score
        opened[row, place] = True
        links = graph[nodes[row, place]]
        row, near = np.repeat(row, links.shape[1]), links.ravel()


def spread(vectors: np.ndarray, cands: np.ndarray, score: np.ndarray, links: int) -> np.ndarray:
    """Up to ``links`` candidates of each row, nearest first, that are nearer to the row's node than to
    any chosen before; places left over go to the nearest of the others."""
    b, c = cands.shape
    points = vectors[cands]
    between = points @ points.transpose(0, 2, 1)
    chosen, full = np.zeros((b, c), bool), np.zeros(b, np.int64)
    shade = np.full((b, c), -np.inf, np.float32)
    for j in range(c):
        take = (cands[:, j] >= 0) & (score[:, j] > shade[:, j]) & (full < links)
        chosen[:, j] = take
        full += take
        shade = np.where(take[:, None], np.maximum(shade, between[:, j, :]), shade)
    rank = np.where(chosen, 0, np.where(cands >= 0, 1, 2)) * c + np.arange(c)
    order = np.argsort(rank, axis=1)[:, :links]
    out = np.take_along_axis(cands, order, 1)
    return np.pad(out, ((0, 0), (0, links - out.shape[1])), constant_values=-1)


def nearest_members(vectors: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``beam`` nearest others of each row, nearest first, and their inner products."""
    n = len(vectors)
    beam = min(beam, n - 1)
    cands, score = np.empty((n, beam), np.int64), np.empty((n, beam), np.float32)
    for a in sliced(n, vectors.itemsize * n, BATCH):
        near = vectors[a] @ vectors.T
        near[np.arange(len(near)), np.arange(a.start, a.start + len(near))] = -np.inf
        best = np.argpartition(near, n - beam, axis=1)[:, n - beam :] if beam else np.empty((len(near), 0), np.int64)
        near = np.take_along_axis(near, best, 1)
        order = np.argsort(-near, axis=1, kind="stable")
        cands[a], score[a] = np.take_along_axis(best, order, 1), np.take_along_axis(near, order, 1)
    return cands, score


def unreached(graph: np.ndarray, reached: np.ndarray) -> np.ndarray:
    """Nodes from which, and from those ``reached`` (a mask), every node is reached."""
    rows, at = np.nonzero(graph >= 0)
    to = graph[rows, at]
    known, ahead = reached.copy(), reached
    while ahead.any():
        found = np.zeros(len(graph), bool)
        found[to[ahead[rows]]] = True
        ahead = found & ~known
        known |= ahead
    inside = ~known[rows] & ~known[to]
    rows, to, least = rows[inside], to[inside], np.arange(len(graph))
    while True:
        before = least.copy()
        np.minimum.at(least, to, least[rows])
        if (least == before).all():
            return ~known & (least == np.arange(len(graph)))


def with_links_back(vectors: np.ndarray, graph: np.ndarray) -> np.ndarray:
    """Each link both ways; a node that gets too many is linked by ``spread`` anew, from its own links and
    the nearest of those that link to it."""
    n, links = graph.shape
    new, to = np.repeat(np.arange(n), links), graph.ravel()
    new, to = new[to >= 0], to[to >= 0]
    back = ~np.isin(to * n + new, new * n + to, assume_unique=True)  # not linked already
    new, to = new[back], to[back]
    near = products(vectors, to, vectors, new)
    order = np.lexsort((-near, to))
    new, to = new[order], to[order]
    place = np.arange(len(to)) - np.searchsorted(to, to)
    extra = np.full((n, links), -1, np.int64)
    some = place < links
    extra[to[some], place[some]] = new[some]
    out = np.empty_like(graph)
    for a in sliced(n, 2 * links * vectors[:1].nbytes, BATCH):
        c = np.concatenate([graph[a], extra[a]], axis=1)
        near = np.where(c >= 0, np.einsum("bed,bd->be", vectors[c], vectors[a]), -np.inf)
        order = np.argsort(-near, axis=1, kind="stable")
        c, near = np.take_along_axis(c, order, 1), np.take_along_axis(near, order, 1)
        over = (c >= 0).sum(axis=1) > links
        out[a] = c[:, :links]
        if over.any():
            out[a][over] = spread(vectors, c[over], near[over], links)
    return out


def build(vectors: np.ndarray, ids: np.ndarray, links: int = LINKS, beam: int = BUILD_BEAM) -> list[tuple[np.ndarray, np.ndarray]]:
    """Layers from top to bottom: (members, neighbours), both flat arrays of node numbers.

    A layer starts with the members of the one above it, which are the entries to it.  A node's links
    are chosen among its nearest members of the layer, which a shard's bounded size lets be found
    exactly.  Members of the layer above are drawn by hash; a group of nodes that no link from
    outside leads to sends one more.
    """
    v = vectors.astype(np.float32)
    length = np.einsum("nd,nd->n", v, v)
    v = np.concatenate([v, np.sqrt(np.maximum(length.max(initial=0) - length, 0))[:, None]], axis=1)
    level = levels_of(ids, links)
    layers, members = [], np.arange(len(v))
    while True:
        most = links if layers else links * 2
        local = v[members]
        cands, score = nearest_members(local, beam)
        graph = np.concatenate([spread(local, cands[a], score[a], most) for a in sliced(len(members), cands.shape[1] * local[:1].nbytes, BATCH)])
        layers.append((members, with_links_back(local, graph)))
        above = level[members] >= len(layers)
        above |= unreached(layers[-1][1], above)
        if len(members) <= ENTRIES or above.all():
            break
        members = members[above]
    out, order = [], np.empty(0, np.int64)
    for members, graph in reversed(layers):
        order = np.concatenate([order, members[~np.isin(members, order)]])
        row, place = np.empty(len(v), np.int64), np.empty(len(v), np.int64)
        row[members], place[order] = np.arange(len(members)), np.arange(len(order))
        graph = graph[row[order]]
        out.append((order, np.where(graph >= 0, place[members[graph]], -1)))
    return out


def descend(v: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]], queries: np.ndarray) -> np.ndarray:
    """Entries to the lowest of ``layers``: each layer's members are the first of the next one."""
    entry = np.tile(np.arange(min(ENTRIES, len(layers[0][0]))), (len(queries), 1))
    for members, graph in layers[:-1]:
        entry, _ = walk(v[members], graph, queries, entry, min(ENTRIES, len(members)))
    return np.where(entry < 0, entry[:, :1], entry)


def searched(vectors: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]], queries: np.ndarray, beam: int = SEARCH_BEAM) -> Iterator[tuple[slice, np.ndarray]]:
    """Slices of the queries, each with the node numbers of the best ``beam`` found of its queries (-1 where there are fewer)."""
    v = vectors.astype(np.float32)
    members, graph = layers[-1]
    local = v[members]
    for a in range(0, len(queries), BATCH):
        q = queries[a : a + BATCH].astype(np.float32)
        entry = descend(v, layers, q)
        found, _ = walk(local, graph, q, entry, beam)
        yield slice(a, a + len(q)), np.where(found >= 0, members[found], -1)


def search(vectors: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]], queries: np.ndarray, beam: int = SEARCH_BEAM) -> np.ndarray:
    """Node numbers of the best ``beam`` found of each query (-1 where there are fewer)."""
    out = np.full((len(queries), beam), -1, np.int64)
    for at, found in searched(vectors, layers, queries, beam):
        out[at] = found
    return out
