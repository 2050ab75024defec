"""The corpus pipeline: its run against its stages one by one, and what it leaves behind."""

from __future__ import annotations

import os

import corpus_pipeline
from ledgerloom.llm.store import shared_folder

from .conftest import SMALL


def folders(spark):
    folder = shared_folder(spark).removeprefix("file:")
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def test_run_is_its_stages_and_leaves_one_table(spark, tmp_path):
    before = folders(spark)
    got = corpus_pipeline.run(spark, SMALL)
    after = folders(spark) - before
    assert [x.rsplit("-", 1)[0] for x in after] == ["stage-mix"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    given = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        made = stage(spark, docs, SMALL)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert made.columns == given, name
        made.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert got.columns == docs.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, docs.collect()), key=repr)


def test_odd_rows_go_through_every_stage(spark, tmp_path):
    rows = [(1, None, None, "de", 0), (2, "", "a", None, 0), (3, "word " * 30_000, "b", "en", 150_000), (4, "same text here", "a", "en", 14), (4, "same text here", "a", "en", 14), (None, "no id at all", "b", "en", 12)]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, source string, lang string, n_chars long, __row int, size int")
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SMALL).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept.append(docs.count())
    assert kept[:4] == [6, 5, 5, 5]  # the second of the equal texts goes
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).collect() == []
