"""Ranked lexical search against plain Python, and the bounds of its trees."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerloom.llm import balltree, lexical

from .conftest import ODD

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return Counter(TERM.findall((text or "").translate(LOWER)))


def brute(docs, items, k=10):
    held = [(d, terms(t)) for d, t in docs]
    held = [(d, c) for d, c in held if c]
    big_n, big_l = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        found = []
        for d, c in held:
            m = 25 + 75 * sum(c.values()) * big_n // big_l
            score = 0
            for t, times in terms(text).items():
                if t in c:
                    w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                    score += times * w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        found.sort(key=lambda x: x[:3])
        out += [(item, rank, d, -s) for rank, (s, _, _, d) in enumerate(found[:k], 1)]
    return sorted(out, key=repr)


def made(rng, n, words):
    return [(i, " ".join(rng.choices(words, k=rng.randrange(1, 60)))) for i in range(n)]


def hold(spark, documents, docs, items, index=None, **how):
    rows = spark.createDataFrame([(*i, 9) for i in items], "item_id long, text string, rank int")
    frame = documents([(d, t, "a") for d, t in docs])
    built, _ = lexical.build_index(frame, **(index or {}))
    got = lexical.search(built, rows, **how).collect()
    assert sorted((tuple(r) for r in got), key=repr) == brute(docs, items, how.get("k", 10))
    return built


def test_against_plain_python(spark, documents):
    rng = random.Random(1)
    words = [f"w{int(rng.paretovariate(0.7))}" for _ in range(3000)] + ["É", "Straße", "X1", "a-b"]
    docs = made(rng, 1500, words)
    docs += [(i + 5000, t) for i, (_, t) in enumerate(docs[:30])] + docs[:5] + [(d, t) for d, t, _ in ODD]  # copies, repeated rows
    docs += [(7, "hot " * 500 + "w1"), (8, "hot " * 500 + "w1")] + [(9000 + i, "tie breaker") for i in range(40)]
    items = made(rng, 60, words) + [(60, "tie"), (61, "HOT w1 w1"), (62, None), (63, "..."), (64, "nowhere"), (61, "HOT w1 w1"), (65, "word " * 400), (None, "tie w2")]
    hold(spark, documents, docs, items)
    hold(spark, documents, docs, items, index={"shard_docs": 40}, k=3, block_terms=100)  # many shards, many blocks


def test_empty_tables(spark, documents):
    no_items = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "one")], "item_id long, text string")
    assert lexical.rank(documents([]), some).collect() == []
    assert lexical.rank(documents([(1, "one", "a")]), no_items).collect() == []
    assert [tuple(r) for r in lexical.rank(documents([(1, "one", "a"), (2, "two", "a")]), some).collect()] == brute([(1, "one"), (2, "two")], [(1, "one")])


@pytest.mark.parametrize("parts, n", [(1, 300), (16, 1000), (10**6, 33), (4, 1)])
def test_bounds_are_never_below_a_row(parts, n):
    rng = np.random.default_rng(parts)
    n_cols = 400
    dense = rng.integers(0, 10**6, (n, n_cols)) * (rng.random((n, n_cols)) < 0.05)
    dense[n // 3 :: 3] = dense[n // 3]  # copies: balls of radius 0
    cells = np.nonzero(dense)
    starts, cols, values = np.searchsorted(cells[0], np.arange(n + 1)), cells[1], dense[cells].astype(np.float64)
    depth = balltree.depth_of(n, 8)
    order = balltree.arrange(starts, cols, values, n_cols, depth)
    assert sorted(order) == list(range(n))
    dense = dense[order]
    cells = np.nonzero(dense)
    starts, cols, values = np.searchsorted(cells[0], np.arange(n + 1)), cells[1], dense[cells].astype(np.float64)
    balls = balltree.Balls(starts, cols, values, n_cols, depth, parts)
    for _ in range(50):
        some = np.sort(rng.choice(n_cols, 30, replace=False))
        weights = rng.integers(1, 20_000, 30).astype(np.float64)
        exact = (dense[:, some] * weights.astype(np.int64)).sum(axis=1)
        bounds = balls.bounds(some, weights)
        for level in range(depth + 1):
            at = balltree.edges(n, level)
            assert (bounds[(1 << level) - 1 :][: 1 << level] >= np.maximum.reduceat(exact, at[:-1])).all()


def test_trees_leave_out_documents(documents):
    """Three topics without a common word: a query opens few of the leaves."""
    rng = random.Random(3)
    docs = [(i, " ".join(rng.choices([f"{'abc'[i % 3]}{j}" for j in range(200)], k=40)), "s") for i in range(3000)]
    row = lexical.build_index(documents(docs).coalesce(1))[0].first()
    shard = {name: np.frombuffer(row[name], kind) for name, kind in lexical._ARRAYS.items()}
    query = next(lexical._queries(iter([_batch(["a1 a2 a3 a4 a5"])]))).to_pylist()[0]
    names = np.array(query["terms"], np.int64).view(np.uint64)
    block = {"terms": names, "weights": np.full(5, 2000), "queries": [(np.arange(5), np.ones(5, np.int64))], "documents": 3000, "words": 120_000}
    best = [[]]
    opened = lexical.search_shard(shard, block, best, 10)
    assert len(best[0]) == 10
    assert opened < 0.5 * (1 << balltree.depth_of(3000))


def _batch(texts):
    import pyarrow as pa

    return pa.RecordBatch.from_pydict({"item_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts, pa.string())})
