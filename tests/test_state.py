from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import control as O
from ledgerloom.operators import recon as Q
from ledgerloom.sinks import tables as T

col = F.col
RUN = dt.datetime(2024, 5, 6, 7, 8, 9)


@pytest.fixture()
def table(spark):
    names = []

    def make(name):
        names.append(name)
        return name

    yield make
    for n in names:
        for suffix in ("", "__next", "__old"):
            spark.sql(f"DROP TABLE IF EXISTS {n}{suffix}")


def test_reload_may_read_the_table_it_replaces(spark, rows, table):
    name = table("t_reload")
    T.replace_table(rows("a int", [(1,), (2,)]), name)
    T.replace_table(spark.table(name).where("a > 1"), name)
    assert [r.a for r in spark.table(name).collect()] == [2]


def test_append_by_name_and_history(spark, rows, table):
    name = table("t_append")
    T.append(rows("a int, b string", [(1, "x")]), name)
    T.append(rows("b string, z int", [("y", 9)]), name)
    assert sorted((r.a or 0, r.b) for r in spark.table(name).collect()) == [(0, "y"), (1, "x")]
    T.history_append(spark.table(name), table("t_history"), RUN)
    assert {r.run_ts for r in spark.table("t_history").collect()} == {RUN}


def test_replaced_dates_only(spark, rows, tmp_path):
    path = str(tmp_path / "p")
    rows("d date, v int", [(dt.date(2024, 1, 1), 1), (dt.date(2024, 1, 2), 2)]).write.partitionBy("d").parquet(path)
    T.replace_partitions(rows("d date, v int", [(dt.date(2024, 1, 2), 5)]), path, "d")
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 5]


def test_updates(rows):
    target = rows("k long, v string", [(1, "a"), (2, "b"), (None, "n")])
    out = T.updated_from(target, rows("k long, v string", [(1, None), (3, "c")]), ["k"], ["v"])
    assert {(r.k, r.v) for r in out.collect()} == {(1, None), (2, "b"), (None, "n")}
    out = T.updated_where(target, col("k") == 2, {"v": F.concat("v", F.lit("!"))})
    assert {(r.k, r.v) for r in out.collect()} == {(1, "a"), (2, "b!"), (None, "n")}
    assert {r.k for r in T.without(target, col("k") == 1).collect()} == {2, None}
    assert {r.k for r in T.only_new(rows("k long", [(1,), (9,), (None,)]), target, ["k"]).collect()} == {9, None}


def test_batch_numbers_keep_prefix_and_width(rows):
    batches = rows("lookup string, last_batch string", [("A", "FTLF000000041"), ("B", "X9"), ("C", "Q099")])
    got = {k: O.next_batch(batches, k).first().batch_number for k in "ABC"}
    assert got == {"A": "FTLF000000042", "B": "X10", "C": "Q100"}
    assert O.usable_batch("X") and not O.usable_batch("") and not O.usable_batch("NOContRec") and not O.usable_batch(None)


def test_claim_export_close_is_a_no_op_the_second_time(rows):
    detail = rows("m string, t timestamp_ntz", [("a", dt.datetime(2024, 1, 2)), ("a", dt.datetime(2024, 1, 3))])
    names = rows("m string", [("a",), ("b",)])
    control = O.control_rows(detail, names, "m", "t", "B1", RUN)
    by = {r.merchant_name: r for r in control.collect()}
    assert (by["a"].extract_start, by["a"].extract_end) == (dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 3))
    assert by["b"].extract_start == RUN
    todo = O.pending(control)
    assert todo.count() == 2
    done = O.closed(control, todo.where(col("merchant_name") == "a"))
    assert [r.merchant_name for r in O.pending(done).collect()] == ["b"]
    again = O.closed(done, O.pending(done).where(F.lit(False)))
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, done.collect()), key=str)


def test_watermark_is_the_slowest_source(rows):
    windows = rows("store_id string, last_execution_time timestamp_ntz", [("s", None), ("t", dt.datetime(2020, 1, 1))])
    facts = rows(
        "tran_uid string, store_id string, ts timestamp_ntz",
        [("TC_1", "s", dt.datetime(2024, 1, 5)), ("TC_2", "s", dt.datetime(2024, 1, 9)), ("ED_1", "s", dt.datetime(2024, 1, 7))],
    )
    got = {r.store_id: r.last_execution_time for r in O.advance_watermark(windows, facts, "store_id", "ts").collect()}
    assert got == {"s": dt.datetime(2024, 1, 7), "t": dt.datetime(2020, 1, 1)}


def test_file_sequence_restarts_on_a_new_day(rows):
    history = rows("file_transmission_date date, file_sequence_number int", [(dt.date(2024, 1, 1), 3)])
    assert O.file_sequence(history, dt.date(2024, 1, 1)).first().file_sequence_number == 4
    assert O.file_sequence(history, dt.date(2024, 1, 2)).first().file_sequence_number == 1


def test_dimension_is_swapped_only_when_clean(spark, rows, table):
    name = table("t_dim")
    T.replace_table(rows("store string", [("old",)]), name)
    bad = rows("store string", [("a",), ("a",)])
    none = Q.schema_drift(spark, bad.schema, bad.schema)
    assert not O.validated_swap(bad, name, Q.duplicate_keys(bad, ["store"]), none)
    assert [r.store for r in spark.table(name).collect()] == ["old"]
    good = rows("store string", [("a",), ("b",)])
    assert O.validated_swap(good, name, Q.duplicate_keys(good, ["store"]), none)
    assert {r.store for r in spark.table(name).collect()} == {"a", "b"}


def test_guards_and_audit_event(spark, rows):
    files = rows("file_date date", [(dt.date(2024, 1, 1),)])
    assert O.file_landed(files, dt.date(2024, 1, 1)) and not O.file_landed(files, dt.date(2024, 1, 2))
    windows = rows("is_active string, settlement_cycle int, division_type string", [("Y", 6, "INTERNAL"), ("N", 7, "INTERNAL"), ("Y", 8, "PARTNER")])
    assert O.window_due(windows, 6) and not O.window_due(windows, 7) and not O.window_due(windows, 8) and O.window_due(windows, 8, partner=True)
    event = T.audit_event(spark, "j", "OK", RUN, RUN + dt.timedelta(milliseconds=1500), "f.csv", 10).first()
    assert (event.duration_ms, event.started, event.file_bytes) == (1500, RUN, 10)


def test_reference_and_weekly_exports_get_a_control_row(spark, rows):
    row = O.export_control(spark, "store_map", "B9", RUN).first()
    assert (row.merchant_name, row.extract_start, row.extract_wf_complete, row.etl_complete) == ("store_map", RUN, None, True)
    detail = rows("m string, t timestamp_ntz", [("a", RUN)])
    both = O.control_rows(detail, detail.select("m"), "m", "t", "B1", RUN).unionByName(O.export_control(spark, "x", "B2", RUN))
    assert O.pending(both).count() == 2
    assert O.weekly_due(dt.date(2024, 5, 6)) and not O.weekly_due(dt.date(2024, 5, 7))
