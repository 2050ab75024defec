from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import recon as Q
from ledgerloom.sinks import files as S
from ledgerloom.sources import ingest as I
from ledgerloom.sources import tables as TB
from ledgerloom.sources import text_files as R

col = F.col
PARTS = {"01": [R.Field("a", 9, 12)], "02": [R.Field("b", 9, 12)], "10": [R.Field("c", 9, 10)]}


def write(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(text.encode(encoding))


def assemble(spark, folder, mode):
    lines = R.read_lines(spark, str(folder))
    return R.assemble_multipart(lines, PARTS, R.Field("n", 2, 9), R.Field("part", 0, 2), mode)


@pytest.mark.parametrize("mode", ["fail", "join"])
def test_multipart_needs_all_parts_of_one_file(spark, tmp_path, mode):
    write(tmp_path / "in" / "one.txt", "010000001aaa\n020000001bbb\n100000001c\n010000002xxx\n020000002yyy\n990000001zzz\n")
    write(tmp_path / "in" / "two.txt", "010000001AAA\n020000001BBB\n100000001C\n100000002q\n")
    got = sorted((r.file_name, r.n, r.a, r.b, r.c) for r in assemble(spark, tmp_path / "in", mode).collect())
    assert got == [("one.txt", "0000001", "aaa", "bbb", "c"), ("two.txt", "0000001", "AAA", "BBB", "C")]


def test_multipart_repeats(spark, tmp_path):
    write(tmp_path / "in" / "one.txt", "010000001aaa\n010000001bbb\n020000001ccc\n100000001d\n")
    assert sorted(r.a for r in assemble(spark, tmp_path / "in", "join").collect()) == ["aaa", "bbb"]
    with pytest.raises(Exception, match="repeated part"):
        assemble(spark, tmp_path / "in", "fail").collect()


def test_edges_are_dropped_per_file_even_when_it_spans_splits(spark, tmp_path):
    body = "\n".join(f"{i}, v{i} " for i in range(4000))
    write(tmp_path / "in" / "big.csv", f"banner\nid,v\n{body}\nfooter\n")
    write(tmp_path / "in" / "empty.csv", "banner\nid,v\nfooter\n")
    write(tmp_path / "in" / "short.csv", "banner\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        got = R.read_delimited_skip(spark, str(tmp_path / "in"), ["id", "v"]).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert {r.file_name for r in got} == {"big.csv"}
    assert sorted(int(r.id) for r in got) == list(range(4000)) and all(r.v == f"v{r.id}" for r in got)


def test_pipe_file_in_latin_1(spark, tmp_path):
    write(tmp_path / "in" / "p.txt", "H|x\nD|café|1\nT|1\n", "iso-8859-1")
    lines = R.read_lines(spark, str(tmp_path / "in"), "ISO-8859-1")
    out = R.curate_csv(lines, T.StructType.fromDDL("k string, name string, n int"), col("value").startswith("D|"), "|")
    assert [(r.name, r.n, r.file_name) for r in out.collect()] == [("café", 1, "p.txt")]


def test_csv_sheet_and_empty_files(spark, tmp_path):
    write(tmp_path / "in" / "a.csv", "Store ID,Site Name\n1,x\n")
    write(tmp_path / "in" / "b.csv", "")
    assert R.read_sheet(spark, str(tmp_path / "in" / "a.csv")).columns == ["store_id", "site_name"]
    schema = T.StructType.fromDDL("store_id int, site_name string")
    rows = R.read_csv(spark, str(tmp_path / "in"), schema, header=True)
    audit = I.empty_file_audit(I.list_files(spark, str(tmp_path / "in")), rows)
    assert {(r.file_name, r.rows, r.is_empty) for r in audit.collect()} == {("a.csv", 1, False), ("b.csv", 0, True)}


def test_typed_projection_nulls_what_does_not_parse(rows):
    df = rows("file_name string, n string, d string, ts string, t string", [("f", " 1.25 ", "20240229", "20240229010203", "23:59:59"), ("f", "x", "20230229", "", "25:00:00")])
    fields = T.StructType.fromDDL("n decimal(38,9), d date, ts timestamp_ntz")
    target = fields.add(T.StructField("t", T.StringType(), True, {"time": True}))
    out = I.curate(I.with_audit(df, F.lit("2024-03-01"), dt.datetime(2024, 3, 1, 2), "p"), "switch", target)
    assert out.columns[:4] == I.AUDIT
    got = [(str(r.n) if r.n is not None else None, r.d, r.ts, r.t) for r in out.collect()]
    assert got == [("1.250000000", dt.date(2024, 2, 29), dt.datetime(2024, 2, 29, 1, 2, 3), "23:59:59"), (None, None, None, None)]


@pytest.mark.parametrize("feed", sorted(I.FEEDS))
def test_every_feed_format_parses_its_own_text(spark, feed):
    fmt = I.FEEDS[feed]
    at = F.lit("2024-02-03 14:05:06").cast("timestamp_ntz")
    plain = lambda f: f.split("[")[0].replace("XXX", "'+00:00'")
    df = spark.range(1).select(F.date_format(at, plain(fmt.date)).alias("d"), F.date_format(at, plain(fmt.timestamp)).alias("ts"))
    row = I.curate(df, feed, T.StructType.fromDDL("d date, ts timestamp_ntz")).first()
    assert row.d == dt.date(2024, 2, 3)
    assert row.ts.replace(second=0) == dt.datetime(2024, 2, 3, 14, 5)


@pytest.mark.parametrize(
    "family,name,want",
    [
        ("default", "landing/x/feed_20240203.csv", dt.date(2024, 2, 3)),
        ("gift", "g_2024_02_03_01020304.csv", dt.date(2024, 2, 3)),
        ("acquirer", "acq_2024020301.csv", dt.date(2024, 2, 3)),
        ("wallet", "wal_20240203010203.csv", dt.date(2024, 2, 3)),
        ("store_feed", "x.y.D240203.csv", dt.date(2024, 2, 3)),
        ("scheme", "MC.AR.T1.M.E1.D240203", dt.date(2024, 2, 3)),
        ("default", "nodate.csv", None),
    ],
)
def test_file_dates(rows, family, name, want):
    assert rows("n string", [(name,)]).select(I.file_date_from_name(col("n"), family)).first()[0] == want


def test_incremental_reads(rows):
    files = rows("file_name string, file_date date", [("a", dt.date(2024, 1, 1)), ("b", dt.date(2024, 1, 2)), ("c", dt.date(2024, 1, 4))])
    loaded = files.where(col("file_name") == "a")
    assert [r.file_name for r in I.next_date_files(files, loaded).collect()] == ["b"]
    assert [r.file_name for r in I.next_date_files(files, files.limit(0)).collect()] == ["a"]
    assert {r.file_name for r in I.not_loaded(files, loaded).collect()} == {"b", "c"}
    both = rows("g string, file_date date", [("x", dt.date(2024, 1, 1)), ("x", dt.date(2024, 1, 3)), ("new", dt.date(2020, 1, 1))])
    high = I.above_group_high_water(both, rows("g string, file_date date", [("x", dt.date(2024, 1, 2))]), "g")
    assert {(r.g, r.file_date) for r in high.collect()} == {("x", dt.date(2024, 1, 3)), ("new", dt.date(2020, 1, 1))}
    stamps = rows("t timestamp_ntz", [(dt.datetime(2024, 1, d),) for d in (1, 5, 7, 9)])
    seen = rows("t timestamp_ntz", [(dt.datetime(2024, 1, 7),)])
    assert [r.t.day for r in I.overlap_unseen(stamps, seen, "t").orderBy("t").collect()] == [5, 9]
    assert I.overlap_unseen(stamps, seen.limit(0), "t").count() == 4


def test_catalog_and_schema_drift(spark, rows):
    rows("a int, b string", [(1, "x")]).createOrReplaceTempView("catalog_probe")
    assert "catalog_probe" in {r.table_name for r in TB.catalog_tables(spark).collect()}
    cols = TB.catalog_columns(spark, ["catalog_probe"]).orderBy("ordinal_position").collect()
    assert [(c.column_name, c.data_type) for c in cols] == [("a", "int"), ("b", "string")]
    want = T.StructType.fromDDL("a int, c string, d date")
    drift = Q.schema_drift(spark, spark.table("catalog_probe").schema, want).orderBy("ordinal_position").collect()
    assert [(d.ordinal_position, d.actual_name, d.expected_name) for d in drift] == [(2, "b", "c"), (3, None, "d")]
    assert Q.schema_drift(spark, want, want).isEmpty()


def test_ordered_text_files_concatenate_to_the_file(spark, rows, tmp_path):
    lines = rows("f string, line_rank int, k int, line string", [("x", 0, 0, "H")] + [("x", 1, i, f"D{i:03d}") for i in range(50)] + [("x", 2, 0, "T50")])
    S.write_lines(lines, str(tmp_path / "out"), "f", ["line_rank", "k"])
    parts = sorted((tmp_path / "out" / "f=x").glob("part-*"))
    text = b"".join(p.read_bytes() for p in parts).decode()
    assert text.split("\r\n")[:-1] == ["H"] + [f"D{i:03d}" for i in range(50)] + ["T50"]


def test_export_and_marker(spark, rows, tmp_path):
    S.export_delimited(rows("a int, b string", [(1, "x|y")]), str(tmp_path / "e"), sep="|", header=True, single_file=True)
    S.write_marker(spark, str(tmp_path / "e"), "done.lck")
    assert (tmp_path / "e" / "done.lck").exists()
    part = next((tmp_path / "e").glob("part-*"))
    assert part.read_text().splitlines()[0] == "a|b"
