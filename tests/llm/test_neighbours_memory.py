"""Nearest neighbours: what a task holds follows neither the number of queries nor that of its shards."""

from __future__ import annotations

import tracemalloc
from glob import glob

import numpy as np
import pyarrow.parquet as pq

from ledgerloom.llm import hnsw, neighbours


def peak_mb(fn) -> float:
    tracemalloc.start()
    try:
        fn()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_many_queries_are_searched_in_little_memory():
    v = np.random.default_rng(3).normal(size=(1000, 64))
    index = {"vectors": v, "ids": np.arange(1000), "starts": np.arange(1001), "layers": hnsw.build(v, np.arange(1000))}
    ids = np.arange(6000)
    out = []
    assert peak_mb(lambda: out.append(neighbours.search_shard(index, ids, v[ids % 1000], 20, hnsw.SEARCH_BEAM))) < 250
    near, score = np.asarray(out[0].column("vec_id")).reshape(6000, 20), np.asarray(out[0].column("score")).reshape(6000, 20)
    assert (near[1000:2000] == near[2000:3000]).all() and (np.diff(score) <= 0).all()
    want = v[:50] @ v.T
    want[np.arange(50), np.arange(50)] = -np.inf
    best = np.argsort(-want, axis=1)[:, :20]
    assert np.mean([len(set(a) & set(b)) / 20 for a, b in zip(best.tolist(), near[:50].tolist())]) > 0.95


def test_long_vectors_are_linked_in_little_memory():
    v = np.random.default_rng(4).normal(size=(600, 1536))
    assert peak_mb(lambda: hnsw.build(v, np.arange(600))) < 150


def test_a_row_group_holds_few_shards_and_repeated_ids_one_row(spark, monkeypatch):
    n, seen = 40_000, []
    v = np.random.default_rng(5).normal(size=(n, 32))
    v[:, 0] += 1
    df = spark.createDataFrame([(i if i % 4 else 20, x) for i, x in enumerate(v.tolist())], "vec_id long, embedding array<double>")
    before = neighbours.written

    def written(rows, what, **options):
        out, path = before(rows, what, **options)
        if what == "neighbours-index":
            files = [pq.ParquetFile(f) for f in glob(path.removeprefix("file:") + "/*.parquet")]
            seen.extend((f.metadata.row_group(i).num_rows, f.metadata.row_group(i).total_byte_size) for f in files for i in range(f.metadata.num_row_groups))
        return out, path

    monkeypatch.setattr(neighbours, "written", written)
    got = neighbours.nearest(df.coalesce(1), df.where("vec_id = 41"), shard_bytes=1 << 20).collect()
    assert len(got) == 20 and 41 not in {r["vec_id"] for r in got}
    assert sum(rows for rows, _ in seen) == 8  # 30,001 ids, not 40,000 rows
    monkeypatch.setattr(neighbours, "LARGE_ROWS", neighbours.LARGE_ROWS | {"parquet.block.size": str(2 << 20)})
    seen.clear()
    neighbours.nearest(df.coalesce(1), df.where("vec_id = 20"), shard_bytes=1 << 20)
    assert len(seen) > 1 and max(size for _, size in seen) < 6 << 20
