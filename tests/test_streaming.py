from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.streaming import arrivals as A

col = F.col


def test_files_are_landed_once_over_several_runs(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    src.mkdir()
    parse = lambda b: b.select("file_name", F.split("value", ",")[0].cast("long").alias("id"))

    def run():
        A.ingest_arrivals(A.arriving_lines(spark, str(src)), parse, out, state)
        return sorted((r.file_name, r.id) for r in spark.read.parquet(out).collect())

    (src / "a.csv").write_text("1,x\n2,y\n")
    assert run() == [("a.csv", 1), ("a.csv", 2)]
    (src / "b.csv").write_text("3,z\n")
    assert run() == [("a.csv", 1), ("a.csv", 2), ("b.csv", 3)]
    assert run() == [("a.csv", 1), ("a.csv", 2), ("b.csv", 3)]


def test_equal_names_in_two_folders_are_two_files(spark, tmp_path):
    src, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    for folder, line in (("x", "1\n"), ("y y", "2\n")):
        (src / folder).mkdir(parents=True)
        (src / folder / "a+1.csv").write_text(line)
        A.ingest_arrivals(A.arriving_lines(spark, str(src)), lambda b: b.select("file_name", col("value").cast("long").alias("id")), out, state)
    got = sorted((r.file_name, r.id) for r in spark.read.parquet(out).collect())
    assert got == [("x/a+1.csv", 1), ("y y/a+1.csv", 2)]


def test_file_already_loaded_by_batch_is_skipped(spark, tmp_path):
    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    (src / "a.csv").write_text("1\n")
    spark.createDataFrame([("a.csv", 7, -1)], "file_name string, id long, batch_id long").write.partitionBy("batch_id").parquet(out)
    A.record_files(spark.read.parquet(out), out, -1)
    A.ingest_arrivals(A.arriving_lines(spark, str(src)), lambda b: b.select("file_name", col("value").cast("long").alias("id")), out, str(tmp_path / "s"))
    assert [r.id for r in spark.read.parquet(out).collect()] == [7]


def test_tail_per_store(rows):
    t = lambda d, h=0: dt.datetime(2024, 1, d, h)
    batch = rows("s string, ts timestamp_ntz, v int", [("a", t(5), 1), ("a", t(3), 2)])
    live = rows("s string, ts timestamp_ntz, v int", [("a", t(5), 3), ("a", t(5, 1), 4), ("b", t(1), 5), ("b", t(9), 6)])
    got = {(r.v, r.src_type) for r in A.nrt_tail(batch, live, "s", "ts", t(8)).collect()}
    assert got == {(1, "BATCH"), (2, "BATCH"), (4, "NRT"), (5, "NRT")}
    got = {r.v for r in A.nrt_tail(batch, live, "s", "ts", t(8), floor_days=4).collect()}
    assert got == {1, 2, 4}
