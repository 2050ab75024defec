"""Benchmark decontamination with an FM-index per training shard.

A shard is a run of whole documents of about ``SHARD_BYTES``, cut inside a task.  Its words are
numbered by the phrases' vocabulary; runs of other words, which no phrase can cross, shrink to
one separator.  All test phrases of a block are searched backward together, occurrences are
located by sampled suffix positions, and the spans of each document are merged.

Phrases come in blocks of bounded words (``BLOCK_WORDS``): a block is broadcast and searched
against all documents; with several blocks the documents' spans are merged by document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm import words as W
from ledgerloom.llm.fmindex import FMIndex
from ledgerloom.llm.store import ROW, fresh_id, numbered, scratch, written

WINDOW = 13
SHARD_BYTES = 4 << 20
BLOCK_WORDS = 200_000
_FOUND = f"row {ROW}, doc_id long, n_words long, spans array<struct<start:long,end:long>>, items array<string>"


def item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(item_id, word hashes) of benchmark items that have words."""
    for batch in batches:
        hashes, at = W.word_hashes(*W.text_buffers(batch.column("text")), W.ALNUM)
        keep = [i for i in range(len(at) - 1) if at[i] < at[i + 1]]
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id").take(pa.array(keep, pa.int64())), pa.array([hashes[at[i] : at[i + 1]].view(np.int64) for i in keep], pa.list_(pa.int64()))],
            ["item_id", "words"],
        )


def phrase_table(items: list[tuple[str | None, np.ndarray]], window: int) -> dict:
    """Distinct windows of a block, right-aligned in rows of symbols, with the items of each."""
    vocabulary = np.unique(np.concatenate([w for _, w in items])) if items else np.empty(0, np.uint64)
    owners: dict[tuple[int, ...], set] = {}
    for item, w in items:
        ids = (np.searchsorted(vocabulary, w) + 1).tolist()
        for i in range(max(1, len(ids) - window + 1)):
            owners.setdefault(tuple(ids[i : i + window]), set()).add(item)
    lengths = np.array([len(p) for p in owners], np.int64)
    rows = np.zeros((len(owners), window), np.int32)
    for r, p in enumerate(owners):
        rows[r, window - len(p) :] = p
    return {"vocabulary": vocabulary, "rows": rows, "lengths": lengths, "items": [sorted(x for x in s if x is not None) for s in owners.values()]}


def search_shard(hashes: np.ndarray, at: np.ndarray, phrases: dict) -> tuple[np.ndarray, list[list[list[int]]], list[list[str]]]:
    """Word counts, merged hit spans (in words of the document) and items found, by document."""
    n_docs, vocabulary = len(at) - 1, phrases["vocabulary"]
    counts, spans, items = np.diff(at), [[] for _ in range(n_docs)], [[] for _ in range(n_docs)]
    if not len(hashes) or not len(vocabulary):
        return counts, spans, items
    near = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    known = vocabulary[near] == hashes
    # a separator before each word that doesn't follow a known word of its document, and at the end
    place = np.flatnonzero(known)
    if not len(place):
        return counts, spans, items
    doc = np.searchsorted(at, place, side="right") - 1
    apart = np.ones(len(place), bool)
    apart[1:] = (np.diff(place) > 1) | (np.diff(doc) > 0)
    to = np.arange(len(place)) + np.cumsum(apart)
    symbols = np.zeros(len(place) + int(apart.sum()) + 1, np.int32)
    symbols[to] = near[place] + 1
    origin = np.zeros(len(symbols), np.int64)
    origin[to] = place

    index = FMIndex(symbols, len(vocabulary) + 1)
    lo, hi = index.ranges(phrases["rows"], phrases["lengths"])
    found = np.flatnonzero(lo < hi)
    if not len(found):
        return counts, spans, items
    sizes = hi[found] - lo[found]
    phrase = np.repeat(found, sizes)
    rows = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(lo[found], sizes)
    start = origin[index.locate(rows)]
    end = start + phrases["lengths"][phrase]

    owner = np.searchsorted(at, start, side="right") - 1
    pairs = np.unique(owner * np.int64(len(phrases["lengths"])) + phrase)
    for p in pairs.tolist():
        items[p // len(phrases["lengths"])].extend(phrases["items"][p % len(phrases["lengths"])])
    order = np.lexsort((start, owner))
    owner, start, end = owner[order], start[order], end[order]
    # ends rise with starts inside a document only after a running maximum; documents don't overlap
    reach = np.maximum.accumulate(end)
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] > reach[:-1]) | (owner[1:] != owner[:-1])
    firsts = np.flatnonzero(new)
    lasts = reach[np.append(firsts[1:], len(start)) - 1]
    for d, s, e in zip(owner[firsts].tolist(), start[firsts].tolist(), lasts.tolist()):
        spans[d].append([s - int(at[d]), e - int(at[d])])
    return counts, spans, [sorted(set(x)) for x in items]


def _shards(raw: np.ndarray, offsets: np.ndarray, shard_bytes: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of documents (first, last + 1) with their word hashes and word offsets."""
    for a, b in W.pieces(offsets, shard_bytes):
        hashes, ats = [], [np.zeros(1, np.int64)]
        for c, d in W.pieces(offsets[a : b + 1]):
            part = offsets[a + c : a + d + 1]
            h, at = W.word_hashes(raw[part[0] : part[-1]], part - part[0], W.ALNUM)
            hashes.append(h)
            ats.append(at[1:] + ats[-1][-1])
        yield a, b, np.concatenate(hashes), np.concatenate(ats)


def _search(batches: Iterator[pa.RecordBatch], phrases: dict, shard_bytes: int) -> Iterator[pa.RecordBatch]:
    kind = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    for batch in batches:
        for a, b, hashes, at in _shards(*W.text_buffers(batch.column("text")), shard_bytes):
            counts, spans, items = search_shard(hashes, at, phrases)
            flat = pa.array([{"start": s, "end": e} for doc in spans for s, e in doc], kind)
            ends = pa.array(np.concatenate([[0], np.cumsum([len(x) for x in spans])]), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").slice(a, b - a), batch.column("doc_id").slice(a, b - a), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(ends, flat), pa.array(items, pa.list_(pa.string()))],
                ["row", "doc_id", "n_words", "spans", "items"],
            )


def _merged(spans) -> F.Column:
    """Sorted spans with overlapping and touching ones joined."""
    kind = "array<struct<start:long,end:long>>"
    last = lambda acc: F.element_at(acc, -1)
    return F.aggregate(
        F.array_sort(spans),
        F.array().cast(kind),
        lambda acc, s: F.when((F.size(acc) > 0) & (s["start"] <= last(acc)["end"]), F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(last(acc)["start"].alias("start"), F.greatest(last(acc)["end"], s["end"]).alias("end"))))).otherwise(F.concat(acc, F.array(s))),
    )


def phrase_blocks(benchmark: DataFrame, window: int, block_words: int) -> list:
    """Broadcast phrase tables of about ``block_words`` words each."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    items, _ = written(items.mapInArrow(item_words, "item_id string, words array<long>"), "decontaminate-items")
    total = items.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks, out = max(1, math.ceil(total / block_words)), []
    for b in range(blocks):
        block = items.where(F.pmod(F.xxhash64("words"), F.lit(blocks)) == b).collect()
        out.append(spark.sparkContext.broadcast(phrase_table([(r.item_id, np.array(r.words, np.int64).view(np.uint64)) for r in block], window)))
    return out


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, shard_bytes: int = SHARD_BYTES, row: Column | None = None) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): row (its id, ``row`` or one made here), doc_id, n_words, spans (hit
    words, merged, end exclusive) and items (ids as strings, sorted).

    Null and empty texts have no words and no hits; null or wordless items have no windows; an
    item without an id hits but isn't listed; items with the same id count as one.  Empty tables
    give no hits or no rows; other columns don't matter.  Words are compared by 64-bit hashes.
    """
    blocks = phrase_blocks(benchmark, window, block_words)
    row = fresh_id() if row is None else row
    docs = docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    if len(blocks) > 1:
        docs, _ = written(docs, "decontaminate-docs")
    found = None
    for phrases in blocks:
        part = docs.mapInArrow(lambda batches, phrases=phrases: _search(batches, phrases.value, shard_bytes), _FOUND)
        found = part if found is None else found.unionByName(part)
    if len(blocks) == 1:
        return found
    every = found.groupBy("row").agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return every.withColumn("spans", _merged(F.col("spans")))


def _hit() -> F.Column:
    return F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])


def contaminated(n_hit, n_words) -> F.Column:
    """The contract's rule: a twentieth of the words or more are hit."""
    return (n_hit > 0) & (20 * n_hit >= n_words)


def report(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    found = find_contamination(docs, benchmark, **how).withColumn("n_hit", _hit())
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


def keep_clean(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that aren't contaminated; all columns as they were."""
    rows, row = numbered(docs, "decontaminate-rows")
    with scratch(docs.sparkSession) as keep:
        bad = find_contamination(rows, benchmark, row=F.col(row), **how).where(contaminated(_hit(), F.col("n_words"))).select("row")
        bad, path = written(bad, "decontaminate-gone")
        keep(path)
    return rows.join(bad, rows[row] == bad["row"], "left_anti").select(*docs.columns)
