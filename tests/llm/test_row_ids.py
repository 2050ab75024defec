"""Rows keep their ids when the file splits of the input move between two jobs of an operator."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import decontaminate, jaccard, licences, mixing
from ledgerloom.llm.store import dropped, numbered, scratch, shared_folder, written

SPLITS = "spark.sql.files.maxPartitionBytes"


@pytest.fixture()
def moving(spark, monkeypatch):
    """After one intermediate table of an operator, inputs are cut into other splits than before."""
    old = spark.conf.get(SPLITS)

    def watch(module, after):
        def moved(df, what, f=module.written):
            out = f(df, what)
            if what == after:
                spark.conf.set(SPLITS, "2k")
            return out

        monkeypatch.setattr(module, "written", moved)
        spark.conf.set(SPLITS, "128m")

    yield watch
    spark.conf.set(SPLITS, old)


@pytest.fixture()
def stored(documents, spark, tmp_path):
    def make(rows):
        # files of different sizes: each is read alone or with others
        documents(rows).select("doc_id", "text", "source").repartition(7, "doc_id").write.option("compression", "none").parquet(str(tmp_path / "d"))
        return spark.read.parquet(str(tmp_path / "d"))

    return make


def _words(i, n):
    return " ".join(f"w{i}x{j}" for j in range(n))


def test_the_contaminated_rows_go(spark, stored, moving):
    item = _words("item", 20)
    docs = stored([(i, item if i % 3 == 0 else _words(i, 30)) for i in range(90)])
    benchmark = spark.createDataFrame([("b", item)], "item_id string, text string")
    moving(decontaminate, "decontaminate-gone")
    kept = decontaminate.keep_clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i in range(90) if i % 3]


def test_the_copies_go(stored, moving):
    docs = stored([(i, _words(i % 30, 40)) for i in range(90)])
    moving(jaccard, "jaccard-documents")
    assert sorted(r["doc_id"] for r in jaccard.keep_one_of_each(docs).collect()) == list(range(30))


def test_the_mix_names_its_rows(stored, moving):
    docs = stored([(i, _words(i, 1 + i), "a" if i % 3 else "b") for i in range(90)])
    moving(mixing, "mix-sizes")
    taken = mixing.take_mix(docs).collect()
    assert taken and all(len(r["text"].split()) == r["size"] == r["doc_id"] + 1 and r["taken"] % r["size"] == 0 for r in taken)


def test_ids_hold_in_other_splits(spark, stored, documents):
    docs = stored([(i, _words(i, 30)) for i in range(90)])
    old, seen = spark.conf.get(SPLITS), []
    for splits in ("128m", "2k"):
        spark.conf.set(SPLITS, splits)
        rows, row = numbered(docs.where("doc_id >= 0").select("doc_id", "text"), "test")
        seen.append({(r["doc_id"], r[row]["file"], r[row]["place"]) for r in rows.collect()})
    spark.conf.set(SPLITS, old)
    assert seen[0] == seen[1] and len({x[1:] for x in seen[0]}) == 90
    # rows that don't come straight from files: written once
    for other in (documents([(1, "a", "x"), (2, "b", "x")]), docs.join(docs.select("source").distinct(), "source"), docs.unionByName(docs), docs.withColumn("__ROW", F.lit(1))):
        rows, row = numbered(other, "test")
        assert row not in other.columns and rows.columns == [*other.columns, row]
        assert rows.select(row).distinct().count() == rows.count() == other.count()


def test_the_licence_scan_reads_stable_ids(spark, stored):
    docs = stored([(i, _words(i, 5) + (" released under the mit license" if i % 3 == 0 else "")) for i in range(90)])
    got = licences.scan(docs)
    assert "monotonically_increasing_id" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert {r["doc_id"] for r in got.collect() if r["labels"] == "mit"} == set(range(0, 90, 3))


def left(spark):
    import os

    folder = shared_folder(spark).removeprefix("file:")
    return {x.rsplit("-", 1)[0] for x in os.listdir(folder)} if os.path.isdir(folder) else set()


def test_scratch_deletes_what_is_not_kept(spark):
    rows = spark.range(3)
    with scratch(spark) as keep:
        one, one_at = written(rows, "scratchone")
        with scratch(spark) as keep_inside:
            _, two_at = written(rows, "scratchtwo")
            _, _ = written(rows, "scratchthree")
            keep_inside(two_at)
        assert {"scratchone", "scratchtwo"} <= left(spark) and "scratchthree" not in left(spark)
        keep(one_at)
    assert "scratchone" in left(spark) and "scratchtwo" not in left(spark)
    with pytest.raises(ValueError), scratch(spark) as keep:
        _, path = written(rows, "scratchfour")
        keep(path)
        raise ValueError
    assert "scratchfour" not in left(spark)
    dropped(spark, one_at)
