"""Approximate nearest neighbours: one navigable small-world graph a shard, shard results merged.

Vectors are dealt to shards of about ``SHARD_BYTES`` by a hash of their id.  A shard's index is one
row (ids and vectors, neighbour arrays and members of each layer) in the shared folder.  Queries
are broadcast in blocks of about ``BLOCK_BYTES``; for each block the tasks read the index where it
lies, and send on the best of their shards only.  Equal vectors are one node of a graph, so
thousands of copies don't fill a neighbourhood; their ids come back at the end.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm import hnsw
from ledgerloom.llm.store import scratch, setting, written

SHARD_BYTES = 8 << 20
SHARD_ROWS = 32_768  # short vectors: links are found by comparing all of a shard
BLOCK_BYTES = 16 << 20
#: a shard's index is a row of some 10 MB: the writer looks at its size after each, not after 100
LARGE_ROWS = {"parquet.block.size": str(16 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}
_FOUND = "query_id long, vec_id long, score double"


def usable(embedding: Column) -> Column:
    """Neither null, empty nor zero, and every component finite."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return embedding.isNotNull() & (F.size(embedding) > 0) & finite & F.exists(embedding, lambda x: x != 0)


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.float64).reshape(len(column), -1)


def build_shard(key: tuple, table: pa.Table) -> pa.Table:
    """The index row of one shard: distinct vectors with the ids of their copies, and the graph."""
    ids, vectors = np.asarray(table.column("id").combine_chunks()), _matrix(table.column("vector"))
    order = np.lexsort((*vectors.T[::-1], ids))
    ids, vectors = ids[order], vectors[order]
    first = np.ones(len(ids), bool)
    first[1:] = ids[1:] != ids[:-1]
    ids, vectors = ids[first], vectors[first]
    distinct, node = np.unique(vectors, axis=0, return_inverse=True)
    node = node.ravel()
    by_node = np.lexsort((ids, node))
    starts = np.concatenate([[0], np.cumsum(np.bincount(node, minlength=len(distinct)))])
    layers = hnsw.build(distinct, ids[by_node][starts[:-1]])
    flat = [(members.astype(np.int32), graph.astype(np.int32)) for members, graph in layers]
    blob = pickle.dumps({"vectors": distinct, "ids": ids[by_node], "starts": starts, "layers": flat})
    return pa.table({"shard": pa.array([key[0].as_py()]), "index": pa.array([blob], pa.large_binary()).cast(pa.binary())})


def _best_of(index: dict, ids: np.ndarray, queries: np.ndarray, found: np.ndarray, k: int) -> list[np.ndarray]:
    """query_id, vec_id and score of the best ``k`` among the nodes ``found`` for each query."""
    vectors, starts = index["vectors"], index["starts"]
    q, cand = np.repeat(np.arange(len(ids)), found.shape[1]), found.ravel()
    q, cand = q[cand >= 0], cand[cand >= 0]
    score = np.empty(len(q))
    for a in hnsw.sliced(len(q), vectors[:1].nbytes):
        score[a] = (vectors[cand[a]] * queries[q[a]]).sum(axis=1)
    copies = np.minimum(starts[cand + 1] - starts[cand], k + 1)  # more can't be among the best k
    at = np.repeat(starts[cand], copies) + np.arange(int(copies.sum())) - np.repeat(np.cumsum(copies) - copies, copies)
    q, score, near = np.repeat(q, copies), np.repeat(score, copies), index["ids"][at]
    other = near != ids[q]
    q, score, near = q[other], score[other], near[other]
    order = np.lexsort((near, -score, q))
    q, score, near = q[order], score[order], near[order]
    place = np.arange(len(q)) - np.searchsorted(q, q)
    top = place < k
    return [ids[q[top]], near[top], score[top]]


def search_shard(index: dict, ids: np.ndarray, queries: np.ndarray, k: int, beam: int) -> pa.RecordBatch:
    """(query_id, vec_id, score): the best ``k`` of the shard, without the query itself.

    What is found for a slice of the queries is cut to the best ``k`` before the next slice.
    """
    found = hnsw.searched(index["vectors"], index["layers"], queries, max(beam, k + 1))
    best = [_best_of(index, ids[at], queries[at], nodes, k) for at, nodes in found]
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(column)) for column in zip(*best, strict=True)], ["query_id", "vec_id", "score"])


def _search(batches: Iterator[pa.RecordBatch], ids: np.ndarray, queries: np.ndarray, k: int, beam: int) -> Iterator[pa.RecordBatch]:
    """The best ``k`` of each query in all shards of the task."""
    best = None
    for batch in batches:
        for blob in batch.column("index"):
            found = search_shard(pickle.loads(blob.as_buffer()), ids, queries, k, beam)
            best = found if best is None else _merged(best, found, k)
    if best is not None:
        yield best


def _merged(one: pa.RecordBatch, other: pa.RecordBatch, k: int) -> pa.RecordBatch:
    """The best ``k`` of each query among both."""
    both = pa.Table.from_batches([one, other]).sort_by([("query_id", "ascending"), ("score", "descending"), ("vec_id", "ascending")])
    query = np.asarray(both.column("query_id"))
    top = np.arange(len(query)) - np.searchsorted(query, query) < k
    return both.filter(pa.array(top)).combine_chunks().to_batches()[0] if len(query) else one


def _one_each(rows: DataFrame) -> DataFrame:
    """One row an id, with its least vector."""
    return rows.groupBy("id").agg(F.min("vector").alias("vector"))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, beam: int = hnsw.SEARCH_BEAM, shard_bytes: int = SHARD_BYTES, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The ``k`` nearest of ``vectors`` found for each row of ``queries`` (both vec_id, embedding), by the
    largest inner product, ties to the smaller id: query_id, rank, vec_id, score.

    Rows without id, and vectors that are null, empty, zero or hold null or non-finite components,
    take no part; an id that repeats counts once, with its least vector, among vectors and queries
    alike; a query is never its own neighbour; vectors are compared with queries of their own
    length; where there are fewer than ``k`` others, all come.  Empty tables give no rows; other
    columns don't matter.
    """
    spark = vectors.sparkSession
    plain = lambda df: df.select(F.col("vec_id").cast("long").alias("id"), F.col("embedding").cast("array<double>").alias("vector")).where(F.col("id").isNotNull() & usable(F.col("vector")))
    with scratch(spark) as keep:
        rows = plain(vectors)
        if not rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
            rows, _ = written(_one_each(rows), "neighbours-vectors")  # else all rows of an id are one shard's
        asked, _ = written(_one_each(plain(queries)), "neighbours-queries")
        size = F.size("vector").alias("d")
        sizes = {r["d"]: r["n"] for r in rows.groupBy(size).agg(F.count(F.lit(1)).alias("n")).collect()}
        n_asked = {r["d"]: r["n"] for r in asked.groupBy(size).agg(F.count(F.lit(1)).alias("n")).collect()}
        parts = []
        for dim, n in sorted(sizes.items()):  # one length, as a rule
            shards = max(1, math.ceil(8 * dim * n / shard_bytes), math.ceil(n / SHARD_ROWS))
            of = rows.where(F.size("vector") == dim).withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("long"))
            index, _ = written(of.groupBy("shard").applyInArrow(build_shard, "shard long, index binary"), "neighbours-index", **LARGE_ROWS)
            blocks = math.ceil(8 * dim * n_asked.get(dim, 0) / block_bytes)
            for b in range(blocks):
                block = asked.where((F.size("vector") == dim) & (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)) == b)).toArrow()
                if not len(block):
                    continue
                sent = spark.sparkContext.broadcast((np.asarray(block.column("id").combine_chunks()), _matrix(block.column("vector"))))
                task = lambda batches, sent=sent: _search(batches, *sent.value, k, beam)
                with setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", "1"):  # a task holds one shard at a time
                    parts.append(written(index.select("index").mapInArrow(task, _FOUND), "neighbours-found")[0])
                sent.destroy()
        found = parts[0] if parts else spark.createDataFrame([], _FOUND)
        for part in parts[1:]:
            found = found.unionByName(part)
        rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
        best = found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        out, path = written(best, "neighbours-nearest")
        keep(path)
    return out
