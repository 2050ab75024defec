"""Ranked lexical search: exact inner products found with sparse ball trees.

A score is the inner product of an item's weights and a document's values, term by term; values
need no more than the term's count, the document's size and two totals over all documents.

The index has one row a shard, a run of documents cut inside a task: term counts of each document
as flat arrays, arranged so that near documents stand together (``balltree.py``).  It depends on no
query and no total, so shards can be added.  Distinct items are searched in blocks of about
``BLOCK_TERMS`` terms: the block's document frequencies are read off the index, then each task
walks its shards' trees best first with the best documents it has so far, and the tasks' best are merged.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm import words as W
from ledgerloom.llm.balltree import Balls, arrange, depth_of, row_sums, spread_runs
from ledgerloom.llm.store import dropped, scratch, written

SHARD_DOCS = 8192
SHARD_ENTRIES = 1 << 20
BLOCK_TERMS = 32_768
#: share of a term's weight, as a power, that goes to the documents' side of the bounds; any gives the same results
LEAN = 0.5

_ARRAYS = {"terms": np.uint64, "held": np.int64, "ids": np.int64, "known": np.bool_, "sizes": np.int64, "starts": np.int64, "cols": np.int32, "counts": np.int32}
_FOUND = "key string, doc_id long, score long"
_INDEX = "documents long, words long, " + ", ".join(f"{name} binary" for name in _ARRAYS)


def damping(sizes: np.ndarray, documents: int, words: int) -> np.ndarray:
    """m of each document, from its number of words and the totals."""
    return 25 + (75 * sizes * documents) // max(words, 1)


def saturated(counts: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The value of a term that occurs ``counts`` times."""
    counts = counts.astype(np.int64)
    return (1_000_000_000 * counts) // (1000 * counts + 8 * m)


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def term_counts(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of each document, sorted, with their counts, and n + 1 offsets of the documents."""
    names, local = np.unique(hashes, return_inverse=True)
    doc = np.repeat(np.arange(len(at) - 1), np.diff(at))
    pairs, counts = np.unique(doc * np.int64(len(names)) + local, return_counts=True)
    return names[pairs % max(len(names), 1)], counts, np.searchsorted(pairs, np.arange(len(at)) * np.int64(len(names)))


class _Shard:
    """Documents of a shard to be, until it is full."""

    def __init__(self) -> None:
        self.parts, self.documents, self.entries = [], 0, 0

    def add(self, ids, known, sizes, lengths, terms, counts) -> None:
        self.parts.append((ids, known, sizes, lengths, terms, counts))
        self.documents += len(ids)
        self.entries += len(terms)

    def row(self) -> pa.RecordBatch:
        ids, known, sizes, lengths, terms, counts = (np.concatenate(x) for x in zip(*self.parts))
        starts = np.concatenate([[0], np.cumsum(lengths)])
        names, cols = np.unique(terms, return_inverse=True)
        # the order needs no totals: the shard's own will do
        m = damping(sizes, len(sizes), int(sizes.sum()))
        values = saturated(counts, np.repeat(m, lengths)).astype(np.float64)
        held = np.bincount(cols, minlength=len(names))
        rarity = np.log((2 * len(sizes) + 2) / (2 * held + 1))
        order = arrange(starts, cols, values * rarity[cols] ** LEAN, len(names), depth_of(len(sizes)))
        to = np.concatenate([[0], np.cumsum(lengths[order])])
        take = spread_runs(starts[:-1][order], starts[1:][order])
        made = {"terms": names, "held": held, "ids": ids[order], "known": known[order], "sizes": sizes[order], "starts": to, "cols": cols[take], "counts": counts[take]}
        blobs = [pa.array([made[name].astype(kind).tobytes()], pa.binary()) for name, kind in _ARRAYS.items()]
        return pa.RecordBatch.from_arrays([pa.array([len(sizes)], pa.int64()), pa.array([int(sizes.sum())], pa.int64()), *blobs], ["documents", "words", *_ARRAYS])


def _shards(batches: Iterator[pa.RecordBatch], shard_docs: int, shard_entries: int) -> Iterator[pa.RecordBatch]:
    shard = _Shard()
    for batch in batches:
        column = batch.column("doc_id")
        known, ids = np.asarray(column.is_valid()), np.asarray(column.fill_null(0))
        raw, offsets = W.text_buffers(batch.column("text"))
        for a, b in W.pieces(offsets):
            part = offsets[a : b + 1]
            hashes, at = W.word_hashes(raw[part[0] : part[-1]], part - part[0], W.ALNUM)
            terms, counts, to = term_counts(hashes, at)
            some = np.flatnonzero(np.diff(at) > 0)
            if len(some):
                shard.add(ids[a:b][some], known[a:b][some], np.diff(at)[some], np.diff(to)[some], terms, counts)
            if shard.documents >= shard_docs or shard.entries >= shard_entries:
                yield shard.row()
                shard = _Shard()
    if shard.documents:
        yield shard.row()


def build_index(docs: DataFrame, shard_docs: int = SHARD_DOCS, shard_entries: int = SHARD_ENTRIES) -> tuple[DataFrame, str]:
    """The index of ``docs`` (doc_id, text) as a table of the shared folder, and its path."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return written(rows.mapInArrow(lambda batches: _shards(batches, shard_docs, shard_entries), _INDEX), "lexical-index")


def _queries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items that have words: their terms with counts, and a key that equal ones share."""
    for batch in batches:
        hashes, at = W.word_hashes(*W.text_buffers(batch.column("text")), W.ALNUM)
        terms, counts, to = term_counts(hashes, at)
        keep = [i for i in range(len(to) - 1) if to[i] < to[i + 1]]
        runs = [slice(to[i], to[i + 1]) for i in keep]
        keys = [hashlib.sha256(terms[r].tobytes() + counts[r].tobytes()).hexdigest() for r in runs]
        lists = [pa.array([x[r] for r in runs], pa.list_(pa.int64())) for x in (terms.view(np.int64), counts)]
        yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(keep, pa.int64())), pa.array(keys, pa.string()), *lists], ["item_id", "key", "terms", "counts"])


def _arrays(batch: pa.RecordBatch, i: int, names) -> dict[str, np.ndarray]:
    return {name: np.frombuffer(batch.column(name)[i].as_buffer(), _ARRAYS[name]) for name in names}


def _holding(batches: Iterator[pa.RecordBatch], wanted: np.ndarray) -> Iterator[pa.RecordBatch]:
    """How many documents of these shards hold each wanted term (sorted hashes)."""
    total = np.zeros(len(wanted), np.int64)
    for batch in batches:
        for i in range(len(batch)):
            shard = _arrays(batch, i, ("terms", "held"))
            near = np.minimum(np.searchsorted(shard["terms"], wanted), len(shard["terms"]) - 1)
            total += np.where(shard["terms"][near] == wanted, shard["held"][near], 0)
    some = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(wanted[some].view(np.int64)), pa.array(total[some])], ["term", "held"])


def search_shard(shard: dict[str, np.ndarray], block: dict, best: list[list[tuple]], k: int) -> int:
    """Put documents of a shard among the ``best`` (-score, id is null, id) of each query; the number of leaves opened."""
    vocabulary, weights = block["terms"], block["weights"]
    near = np.minimum(np.searchsorted(vocabulary, shard["terms"]), max(len(vocabulary) - 1, 0))
    known = vocabulary[near] == shard["terms"] if len(vocabulary) else np.zeros(len(shard["terms"]), bool)
    place = np.full(len(shard["terms"]), -1, np.int64)
    place[known] = np.arange(int(known.sum()))
    if not known.any():
        return 0
    here = np.full(len(vocabulary), -1, np.int64)  # block's term to column
    here[near[known]] = place[known]
    local_weight = weights[near[known]]
    m = damping(shard["sizes"], block["documents"], block["words"])
    cols = place[shard["cols"]]
    kept = cols >= 0
    starts = np.concatenate([[0], np.cumsum(kept)])[shard["starts"]]
    row = np.repeat(np.arange(len(m)), np.diff(shard["starts"]))[kept]
    cols, values = cols[kept], saturated(shard["counts"][kept], m[row])
    lean = local_weight.astype(np.float64) ** LEAN
    balls = Balls(starts, cols, values * lean[cols], len(local_weight), depth_of(len(m)))
    opened, mine = 0, np.zeros(len(local_weight), np.int64)
    for q, (terms, counts) in enumerate(block["queries"]):
        at = here[terms]
        at, counts = at[at >= 0], counts[at >= 0]
        if not len(at):
            continue
        mine[at] = counts * local_weight[at]
        top, least = best[q], -best[q][-1][0] if len(best[q]) == k else 1
        walk = balls.leaves(balls.bounds(at, mine[at] / lean[at]), least)
        leaf = next(walk, None)
        while leaf:
            rows = spread_runs(*leaf)
            opened += len(leaf[0])
            entries = spread_runs(starts[rows], starts[rows + 1])
            score = row_sums(values[entries] * mine[cols[entries]], np.concatenate([[0], np.cumsum(starts[rows + 1] - starts[rows])]))
            good = np.flatnonzero(score >= least)
            if len(good) > 4 * k:
                good = good[score[good] >= np.partition(score[good], -k)[-k]]
            if len(good):
                top += [(-int(score[i]), not shard["known"][rows[i]], int(shard["ids"][rows[i]])) for i in good.tolist()]
                top.sort()
                del top[k:]
                least = -top[-1][0] if len(top) == k else 1
            try:
                leaf = walk.send(least)
            except StopIteration:
                leaf = None
        mine[at] = 0
    return opened


def _search(batches: Iterator[pa.RecordBatch], block: dict, k: int) -> Iterator[pa.RecordBatch]:
    best: list[list[tuple]] = [[] for _ in block["queries"]]
    for batch in batches:
        for i in range(len(batch)):
            search_shard(_arrays(batch, i, _ARRAYS), block, best, k)
    rows = [(key, None if null else doc, -score) for key, top in zip(block["keys"], best) for score, null, doc in top]
    keys, docs, scores = zip(*rows) if rows else ((), (), ())
    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(docs, pa.int64()), pa.array(scores, pa.int64())], ["key", "doc_id", "score"])


def _block(queries: list, index: DataFrame, documents: int, words: int) -> dict:
    """What tasks need to search for some queries: terms with weights above 0, and each query's places and counts."""
    terms = np.unique(np.concatenate([np.array(q.terms, np.int64).view(np.uint64) for q in queries]))
    spark = index.sparkSession
    wanted = spark.sparkContext.broadcast(terms)
    held = index.select("terms", "held").mapInArrow(lambda batches: _holding(batches, wanted.value), "term long, held long").groupBy("term").agg(F.sum("held").alias("held")).collect()
    wanted.destroy()
    weights = np.zeros(len(terms), np.int64)
    at = np.searchsorted(terms, np.array([r.term for r in held], np.int64).view(np.uint64))
    weights[at] = [weight(documents, r.held) for r in held]
    to = np.cumsum(weights > 0) - 1
    parts = []
    for q in queries:
        place = np.searchsorted(terms, np.array(q.terms, np.int64).view(np.uint64))
        heavy = weights[place] > 0
        parts.append((to[place[heavy]], np.array(q.counts, np.int64)[heavy]))
    return {"terms": terms[weights > 0], "weights": weights[weights > 0], "queries": parts, "keys": [q.key for q in queries], "documents": documents, "words": words}


def search(index: DataFrame, items: DataFrame, k: int = 10, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """The ``k`` documents with the highest scores above 0 of each row of ``items`` (item_id, text): item_id, rank, doc_id, score.

    Equal scores go by ascending doc_id, a null id last.  Null and wordless items and documents have
    no results; a row of ``items`` that repeats gives its rows again, and each row of the documents is a
    document, whatever its id.  Terms are compared by 64-bit hashes.
    """
    spark = index.sparkSession
    totals = index.agg(F.sum("documents").alias("documents"), F.sum("words").alias("words")).first()
    kind = items.schema["item_id"].dataType.simpleString()
    with scratch(spark) as keep:
        asked = items.select("item_id", F.col("text").cast("string").alias("text"))
        asked, _ = written(asked.mapInArrow(_queries, f"item_id {kind}, key string, terms array<long>, counts array<long>"), "lexical-items")
        distinct, _ = written(asked.dropDuplicates(["key"]).drop("item_id"), "lexical-queries")
        n_terms = distinct.agg(F.sum(F.size("terms"))).first()[0] or 0
        blocks = max(1, math.ceil(n_terms / block_terms))
        found = spark.createDataFrame([], _FOUND)
        for b in range(blocks):  # copies are one query, so a block is about block_terms, or one long item
            queries = distinct.where(F.pmod(F.xxhash64("key"), F.lit(blocks)) == b).collect()
            if not queries or not totals["documents"]:
                continue
            block = spark.sparkContext.broadcast(_block(queries, index, totals["documents"], totals["words"]))
            part, _ = written(index.mapInArrow(lambda batches, block=block: _search(batches, block.value, k), _FOUND), "lexical-found")
            block.destroy()
            found = found.unionByName(part)
        order = Window.partitionBy("key").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        out, path = written(asked.select("item_id", "key").join(best, "key").select("item_id", "rank", "doc_id", "score"), "lexical-ranked")
        keep(path)
    return out


def rank(docs: DataFrame, items: DataFrame, k: int = 10, **how) -> DataFrame:
    """``search`` over all ``docs`` (doc_id, text), with an index made for it and deleted after.  Empty tables
    give no rows; other columns don't matter."""
    index, path = build_index(docs, **how)
    out = search(index, items, k)
    dropped(docs.sparkSession, path)
    return out
