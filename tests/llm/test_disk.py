"""Disk that near duplicates take: no shuffle outlives its write, signatures are shuffled in parts."""

from __future__ import annotations

import time

import numpy as np
from pyspark.sql import functions as F

from ledgerloom.llm import jaccard, store


def _shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    names = {files.apply(i).getName() for i in range(files.length())}
    return {n for n in names if n.startswith("shuffle_")}


def test_a_written_table_leaves_no_shuffle_behind(spark):
    before = _shuffle_files(spark)
    rows = spark.range(1000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count()
    with store.scratch(spark):
        table, _ = store.written(rows, "freed")
        for _ in range(100):
            left = _shuffle_files(spark) - before
            if not left:
                break
            time.sleep(0.1)
        assert not left
        assert table.count() == 7 and rows.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "false") == "false"


def test_passes_deal_the_signatures_out():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in (1, 5, 9, 14, 23, 60, 200, 900, 901, 4000)]
    table = jaccard.bands()
    pairs = lambda *turn: [tuple(p) for p in np.stack([x.astype(np.uint64) for x in jaccard.signatures(sets, table, jaccard.PERCENT, *turn)], 1).tolist()]
    whole = pairs()
    parts = [pairs(turn, jaccard.PASSES) for turn in range(jaccard.PASSES)]
    assert sorted(whole) == sorted(p for part in parts for p in part)
    assert max(map(len, parts)) < 0.5 * len(whole)
    sigs = [{s for _, s in part} for part in parts]
    assert all(not a & b for i, a in enumerate(sigs) for b in sigs[:i])
