"""Exact Jaccard join of word-shingle sets by universe partition and pigeonhole.

Sets fall into bands by size.  Two sets of one band that link differ in at most ``errors``
tokens, so if the token universe is cut into segments whose allocations add up to
``errors + spare``, some segments agree: exactly (allocation 0), or but for one token
(allocation 1, found by one-deletion neighbourhoods).  Allocation follows cost: bands of short
sets take long segments with deletions, since their plain segments would hold a token or two and
meet everywhere; all others take plain segments, more than errors, so that many must agree.  A set
skips its most crowded segments, one fewer than those in which it must agree with any partner
of its size, by counts over all sets: the rarest common segment of a linked pair is never skipped.

Segments that stay crowded are cut into single tokens, the finest partition: there a set's rarest
tokens, one more than it may lack in a partner, must meet the partner's.

Equal sets are one node (128 bits of hash), so copies never meet.  Inside a crowded segment,
pairs are tried from a few central members outwards, ever more each round, and a pair is only tried while
its two sets are in different components; rounds end when no segment holds two untried.
Every link is verified on the whole sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm import words as W
from ledgerloom.llm.components import smallest_reachable
from ledgerloom.llm.store import ROW, dropped, fresh_id, numbered, scratch, written

SHINGLE = 5
#: links need 100 * intersection >= PERCENT * union
PERCENT = 80
BAND_RATIO = 1.5
SHORT = 24
SPARE_SHARE = 0.5
CENTRES = 2
COUNTED = 4096
#: signatures are shuffled in so many parts, one after the other: the disk holds one part's rows at a time
PASSES = 3
BROADCAST_NODES = 2_000_000
#: sets in a segment from which it is cut into tokens
CROWD = 64
U = np.uint64


def bands(percent: int = PERCENT) -> list[dict]:
    """Size bands: lo, hi, errors, segments and one (do segments take a deletion).

    The larger set of a pair is in the band; |x ^ y| <= (1 - t) / (1 + t) * (|x| + |y|).
    """
    out, lo = [], 1
    while lo < 1 << 40:
        hi = max(lo, math.ceil(lo * BAND_RATIO) - 1)
        errors = (100 - percent) * 2 * hi // (100 + percent)
        if hi <= SHORT:
            out.append({"lo": lo, "hi": hi, "errors": errors, "one": True, "segments": (errors + 2) // 2})
        else:
            out.append({"lo": lo, "hi": hi, "errors": errors, "one": False, "segments": errors + 1 + math.ceil(SPARE_SHARE * errors)})
        lo = hi + 1
    return out


def of_bands(sizes: np.ndarray, table: list[dict], percent: int) -> list[tuple[int, np.ndarray]]:
    """(band, sets) for every band a set takes part in: its own, and those it can be the smaller one in."""
    out = []
    top = int(sizes.max(initial=0))
    for b, band in enumerate(table):
        if percent * band["lo"] > 100 * top:
            break
        if band["errors"]:  # else only equal sets link, and those are one node
            some = np.flatnonzero((sizes <= band["hi"]) & (100 * sizes >= percent * band["lo"]))
            if len(some):
                out.append((b, some))
    return out


def shingle_sets(raw: np.ndarray, offsets: np.ndarray, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document."""
    hashes, at = W.word_hashes(raw, offsets, W.SPACED)
    grams, at = W.windows(hashes, at, k)
    return [np.unique(grams[at[i] : at[i + 1]]) for i in range(len(at) - 1)]


def set_ids(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each set."""
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    flat = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    out = []
    for salt in (0x1B873593CC9E2D51, 0x85EBCA6BC2B2AE35):
        run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(W.mix(flat ^ U(salt)), dtype=np.uint64)])
        out.append(W.mix(run[at[1:]] - run[at[:-1]] + np.diff(at).astype(np.uint64)))
    return out[0], out[1]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _pieces(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    for batch in batches:
        raw, offsets = W.text_buffers(batch.column("text"))
        for a, b in W.pieces(offsets):
            part = offsets[a : b + 1]
            yield batch.slice(a, b - a), shingle_sets(raw[part[0] : part[-1]], part - part[0], k)


def signatures(sets: list[np.ndarray], table: list[dict], percent: int, turn: int = 0, passes: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """(set number, signature) of all segments and deletions; the low byte of a signature is its band.

    Of several ``passes`` each takes its own segments, the same ones of every set, so rows that agree are in one pass.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    numbers, sigs = [], []
    for b, some in of_bands(sizes, table, percent):
        band = table[b]
        m = band["segments"]
        tokens = np.concatenate([sets[i] for i in some])
        owner = np.repeat(np.arange(len(some)), sizes[some])
        h = W.mix(tokens ^ U((b + 1) * 0x9E3779B97F4A7C15 % (1 << 64)))
        segment = ((h >> U(32)) * U(m) >> U(32)).astype(np.int64)
        mine = np.flatnonzero((np.arange(m) + b) % passes == turn)
        if not len(mine):
            continue
        if passes > 1:
            place_of = np.full(m, -1)
            place_of[mine] = np.arange(len(mine))
            segment = place_of[segment]
            taken = segment >= 0
            h, owner, segment, m = h[taken], owner[taken], segment[taken], len(mine)
        cell = owner * m + segment
        h = W.mix(h)
        low = np.bincount(cell, (h & U(0xFFFFFFFF)).astype(np.float64), len(some) * m).astype(np.uint64)
        high = np.bincount(cell, (h >> U(32)).astype(np.float64), len(some) * m).astype(np.uint64)
        total = low + (high << U(32))
        place = U(0xC2B2AE3D27D4EB4F) * (mine.astype(np.uint64) + U(1))
        whole = W.mix(total + np.tile(place, len(some)))
        numbers.append(np.repeat(some, m))
        sigs.append((whole & ~U(255)) | U(b))
        if band["one"]:
            less = W.mix(total[cell] - h + place[segment])
            numbers.append(some[owner])
            sigs.append((less & ~U(255)) | U(b))
    if not numbers:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(numbers), np.concatenate(sigs)


def crowded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (sig, node), those of signatures with two nodes or more, and the number of
    nodes, which counts up to ``COUNTED`` (alike for all rows of a signature, so an order by it is the
    same for every set).  Only the open signature's rows are held, at most ``COUNTED`` of them."""
    held_sig, held_node, over = np.empty(0, np.int64), np.empty(0, np.int64), None

    def rows(sig, node, n):
        return pa.RecordBatch.from_arrays([pa.array(node), pa.array(sig), pa.array(n)], ["node", "sig", "n"])

    for batch in batches:
        sig = np.concatenate([held_sig, np.asarray(batch.column("sig"))])
        node = np.concatenate([held_node, np.asarray(batch.column("node"))])
        if not len(sig):
            continue
        new = np.ones(len(sig), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
        sig, node = sig[new], node[new]
        if over is not None:  # the signature went over COUNTED in an earlier batch
            more = int(np.searchsorted(sig != over[0], True))
            if more:
                at = 1 if node[0] == over[1] else 0
                over = (over[0], node[more - 1])
                yield rows(sig[at:more], node[at:more], np.full(more - at, COUNTED))
                sig, node = sig[more:], node[more:]
                if not len(sig):
                    held_sig, held_node = sig, node
                    continue
            over = None
        starts = np.flatnonzero(np.concatenate([[True], sig[1:] != sig[:-1]]))
        sizes = np.diff(np.append(starts, len(sig)))
        if sizes[-1] >= COUNTED:
            over, end = (sig[-1], node[-1]), len(sig)
        else:
            end = int(starts[-1])
        held_sig, held_node = sig[end:], node[end:]
        n = np.repeat(np.minimum(sizes, COUNTED), sizes)[:end]
        keep = n > 1
        yield rows(sig[:end][keep], node[:end][keep], n[keep])
    if len(held_sig) > 1:
        yield rows(held_sig, held_node, np.full(len(held_sig), len(held_sig)))


def document_sets(docs: DataFrame, k: int = SHINGLE, row: Column | None = None) -> DataFrame:
    """One row for each row of ``docs``: row, doc_id, n_shingles, node and check (hashes of the set; null if empty)."""

    def task(batches):
        for batch, sets in _pieces(batches, k):
            a, b = set_ids(sets)
            sizes = np.array([len(s) for s in sets], np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(sizes), pa.array(a.view(np.int64), mask=sizes == 0), pa.array(b.view(np.int64), mask=sizes == 0)], ["row", "doc_id", "n_shingles", "node", "check"]
            )

    row = fresh_id() if row is None else row
    rows = docs.select(row.alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(task, f"row {ROW}, doc_id long, n_shingles long, node long, check long")


def crowded_segments(docs: DataFrame, sizes: DataFrame, k: int = SHINGLE, percent: int = PERCENT, partitions: int | None = None, made: list[str] | None = None) -> DataFrame:
    """(sig, node, weight, size, rarer, token): segments that several sets share, after each set's skips;
    ``weight`` tells how central the set is among those it shares segments with, ``rarer`` how many of its
    segments are less crowded, ``token`` if a segment is one token.  ``sizes``: node and n_shingles.
    ``made`` gets the paths of the tables the result reads."""
    table = bands(percent)

    def sign(turn, batches):
        done = np.empty(0, np.uint64)  # nodes this task has signed: copies are signed once
        for _, sets in _pieces(batches, k):
            ids, _ = set_ids(sets)
            _, first = np.unique(ids, return_index=True)
            first = first[~np.isin(ids[first], done)]
            done = np.concatenate([done, ids[first]])
            numbers, sigs = signatures([sets[i] for i in first], table, percent, turn, PASSES)
            yield pa.RecordBatch.from_arrays([_signed(sigs), _signed(ids[first][numbers] if len(numbers) else np.empty(0, np.uint64))], ["sig", "node"])

    texts = docs.select(F.col("text").cast("string").alias("text"))
    n = partitions or max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), texts.rdd.getNumPartitions())
    met = None
    for turn in range(PASSES):
        signed = texts.mapInArrow(partial(sign, turn), "sig long, node long")
        part = signed.repartition(n, "sig").sortWithinPartitions("sig", "node").mapInArrow(crowded, "node long, sig long, n long")
        part, path = written(part, "jaccard-segments")
        if made is not None:
            made.append(path)
        met = part if met is None else met.unionByName(part)

    # (sets of fewer than 2 ** 31 shingles) segments - skip - 1 is the most tokens in which a set can differ from a partner
    column = lambda name: F.array(*[F.lit(int(t[name])) for t in table])
    of_band = lambda name: F.element_at(column(name), F.col("band") + 1)
    size = F.col("n_shingles")
    partner = F.least(of_band("hi").cast("long"), F.floor(size * 100 / percent))
    skip = F.when(of_band("one") == 1, 0).otherwise(of_band("segments") - F.floor((100 - percent) * (size + partner) / (100 + percent)) - 1)
    by_crowd = Window.partitionBy("node", "band").orderBy(F.col("n").desc(), "sig")
    sizes = sizes.select(F.col("node").alias("of"), "n_shingles").distinct()
    sized = met.join(sizes, F.col("node") == F.col("of")).select("node", "sig", "n", "n_shingles", F.col("sig").bitwiseAND(F.lit(255)).cast("int").alias("band"))
    kept = sized.withColumn("rank", F.row_number().over(by_crowd)).where(F.col("rank") > skip)
    rarer = F.when(of_band("one") == 1, 0).otherwise(of_band("segments") - F.col("rank"))
    kept = kept.withColumn("weight", F.sum("n").over(Window.partitionBy("node")))
    return kept.select("sig", "node", "weight", F.col("n_shingles").alias("size"), rarer.cast("long").alias("rarer"), F.lit(False).alias("token"))


def linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets link, counted on the whole sets."""
    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    both = pairs.join(left, "a").join(right, "b").where((100 * F.least(F.size("x"), F.size("y"))) >= percent * F.greatest(F.size("x"), F.size("y")))
    same = F.size(F.array_intersect("x", "y"))
    return both.withColumn("same", same).where(100 * F.col("same") >= percent * (F.size("x") + F.size("y") - F.col("same"))).select("a", "b")


def node_components(docs: DataFrame, rows: DataFrame, k: int = SHINGLE, percent: int = PERCENT, centres: int = CENTRES) -> tuple[DataFrame, DataFrame]:
    """(node, component) of all nodes with links, and the links (a, b) that were verified.  ``rows``: ``document_sets``."""
    spark = docs.sparkSession
    place = Window.partitionBy("sig").orderBy(F.col("weight").desc(), "node")
    segments = []
    several = crowded_segments(docs, rows, k, percent, made=segments).withColumn("place", F.row_number().over(place))
    several, _ = written(several.drop("weight"), "jaccard-places")
    for path in segments:
        dropped(spark, path)
    nodes = several.select(F.col("node").alias("wanted")).distinct()
    nodes, _ = written(nodes, "jaccard-nodes")

    def tokens(batches):
        for _, sets in _pieces(batches, k):
            ids, _ = set_ids(sets)
            _, first = np.unique(ids, return_index=True)
            yield pa.RecordBatch.from_arrays([_signed(ids[first]), pa.array([sets[i].view(np.int64) for i in first], pa.list_(pa.int64()))], ["node", "tokens"])

    every = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(tokens, "node long, tokens array<long>")
    if nodes.count() <= BROADCAST_NODES:  # 8 bytes each
        nodes = F.broadcast(nodes)
    sets = every.join(nodes, F.col("node") == F.col("wanted")).groupBy("node").agg(F.first("tokens").alias("tokens"))
    sets, _ = written(sets, "jaccard-sets")

    links = labels = None
    first, finer = 1, False
    while True:
        open_ = _torn(several, labels, first)
        if labels is not None and not finer:
            finer = True
            crowd, _ = written(open_.groupBy("sig").count().where(F.col("count") >= CROWD).select("sig"), "jaccard-crowd")
            if not crowd.isEmpty():
                members = open_.join(crowd, "sig").select("node").distinct()
                tokens_of = _token_segments(sets, members, percent).withColumn("place", F.col("place") + (first - 1))
                several, _ = written(several.join(crowd, "sig", "left_anti").unionByName(tokens_of), "jaccard-finer")
                open_ = _torn(several, labels, first)
        open_, _ = written(open_, "jaccard-open")
        if open_.isEmpty():
            break
        heads = open_.where(F.col("place") < first + centres)
        heads = heads.select("sig", F.col("node").alias("a"), F.col("place").alias("at"), F.col("component").alias("ca"), F.col("size").alias("size_a"), F.col("rarer").alias("rarer_a"))
        pairs = heads.join(open_, "sig").where((F.col("place") > F.col("at")) & (F.col("component") != F.col("ca")) & _may_link(percent))
        pairs = pairs.select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()
        found, _ = written(linked(pairs, sets, percent), "jaccard-links")
        if not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            labels, _ = written(smallest_reachable(links), "jaccard-labels")
        elif labels is None:
            labels = spark.createDataFrame([], "node long, component long")
        first, centres = first + centres, 8 * centres
    none = spark.createDataFrame([], "node long, component long")
    return none if labels is None else labels, links


def _may_link(percent: int) -> Column:
    """Could a segment be the rarest that a pair has in common: does neither set have more segments before
    it than it may lack in the other?"""
    sizes = F.col("size") + F.col("size_a")
    errors = F.floor((100 - percent) * sizes / (100 + percent))
    common = F.ceil(percent * sizes / (100 + percent))
    lacks = lambda size: F.when(F.col("token"), F.col(size) - common).otherwise(errors)
    return (F.col("rarer") <= lacks("size")) & (F.col("rarer_a") <= lacks("size_a"))


def _torn(several: DataFrame, labels: DataFrame | None, first: int) -> DataFrame:
    """Members from place ``first`` on of the segments in which these are of more than one component."""
    if labels is None:
        state = several.withColumn("component", F.col("node"))
    else:
        state = several.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    state = state.where(F.col("place") >= first)
    torn = state.groupBy("sig").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("sig")
    return state.join(torn, "sig")


def _token_segments(sets: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Single tokens as segments, among ``members``: of each set's tokens, rarest first, as many as it may
    lack in a partner and one more."""
    single = sets.join(members, "node").select("node", F.size("tokens").alias("s"), F.explode("tokens").alias("sig"))
    counts = single.groupBy("sig").agg(F.count(F.lit(1)).alias("n"))
    ranked = single.join(counts, "sig").withColumn("rank", F.row_number().over(Window.partitionBy("node").orderBy("n", "sig")))
    rare = ranked.where((F.col("rank") <= F.col("s") - F.ceil(F.col("s") * percent / 100) + 1) & (F.col("n") > 1))
    place = F.row_number().over(Window.partitionBy("sig").orderBy("rank", "node"))
    return rare.select("sig", "node", F.col("s").cast("long").alias("size"), (F.col("rank") - 1).cast("long").alias("rarer"), F.lit(True).alias("token"), place.alias("place"))


def row_components(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT, row: Column | None = None) -> DataFrame:
    """One row for each row of ``docs``: row (its id, ``row`` or one made here), doc_id, n_shingles, component_id (smallest id
    of the component) and first_row (the row with that id; the first of several).  Rows with an empty
    set stand alone."""
    with scratch(docs.sparkSession) as keep:
        rows, rows_at = written(document_sets(docs, k, row), "jaccard-documents")
        labels, _ = node_components(docs, rows, k, percent)
        # a set without links keeps its second hash as well, so no two sets are taken for one
        per_set = rows.where("n_shingles > 0").groupBy("node", "check").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
        per_set = per_set.join(labels.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left")
        alone = F.when(F.col("component").isNull(), F.col("check")).alias("alone")
        per_set, sets_at = written(per_set.select("node", "check", "first", F.coalesce("component", "node").alias("component"), alone), "jaccard-merged")
        keep(rows_at)
        keep(sets_at)
    firsts = per_set.groupBy(F.col("component").alias("c"), F.col("alone").alias("a")).agg(F.min("first").alias("least"))
    firsts = per_set.join(firsts, (F.col("component") == F.col("c")) & F.col("alone").eqNullSafe(F.col("a")))
    firsts = firsts.select(F.col("node").alias("of"), F.col("check").alias("of_check"), "least")
    out = rows.join(firsts, (F.col("node") == F.col("of")) & (F.col("check") == F.col("of_check")), "left")
    empty = F.col("n_shingles") == 0
    return out.select("row", "doc_id", "n_shingles", F.when(empty, F.col("doc_id")).otherwise(F.col("least.doc_id")).alias("component_id"), F.when(empty, F.col("row")).otherwise(F.col("least.row")).alias("first_row"))


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_shingles (set size) and component_id
    (smallest doc_id reachable by links, its own included).

    Null and blank texts have an empty set, link with nothing and keep their own id; texts of fewer
    words than ``k`` have their whole sequence as one shingle; rows with equal sets are linked;
    rows without id take part and count as larger than any id.  An empty table gives no rows; other
    columns don't matter.
    """
    return row_components(docs, k, percent).select("doc_id", "n_shingles", "component_id")


def keep_one_of_each(docs: DataFrame, k: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` without those of a component but its first; all columns as they were."""
    rows, row = numbered(docs, "jaccard-rows")
    with scratch(docs.sparkSession) as keep:
        gone = row_components(rows, k, percent, F.col(row)).where("row <> first_row").select("row")
        gone, path = written(gone, "jaccard-gone")
        keep(path)
    return rows.join(gone, rows[row] == gone["row"], "left_anti").select(*docs.columns)
