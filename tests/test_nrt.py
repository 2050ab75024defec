"""Near-real-time pricing, late rows and late rates; stream periods of a calendar."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.sinks.versions import VersionedTables
from ledgerloom.sources.tables import fiscal_calendar
from ledgerloom.streaming import arrivals as A
from ledgerloom.streaming import nrt as N
from ledgerloom.workload.q_versions import Stopped, stop_after

at = lambda day, hour=1: dt.datetime(2024, 3, day, hour)
SHAPE = "source string, tran_uid string, store_id string, tstamp_trans timestamp_ntz, card_type string, kind string, approval string, amount_cents long"


def sale(uid, store, day, cents=10_000, card="DEBIT", hour=1):
    return ("TC", uid, store, at(day, hour), card, "PURCHASE", "A", cents)


@pytest.fixture()
def store(rows):
    return rows("store_id string, ratecard_group string", [("S1", "M1"), ("S2", "M2")])


RATES = "merchant string, card_type string, from_date date, to_date date, proc_fee_code string, proc_fee_percent double, proc_fee_fixed double"


@pytest.fixture()
def rates(rows):
    d = lambda n: dt.date(2024, 3, n)
    return rows(RATES, [("M1", "DEBIT", d(1), d(10), "PERCENT", 1.0, 0.0), ("M1", "DEBIT", d(11), None, "ALL", 2.0, 0.5), ("M2", "DEBIT", d(1), None, "FIXED", 9.0, 0.25)])


def test_fees_as_of_the_sale(rows, store, rates):
    live = rows(SHAPE, [sale("a", "S1", 10), sale("b", "S1", 11), sale("c", "S2", 11), sale("d", "S3", 11), sale("e", "S1", 11, card="CREDIT"), sale("f", "S1", 10, None)])
    got = {r["tran_uid"]: r["processing_fee"] for r in N.priced(live, store, rates).collect()}
    assert got == {"a": 1.0, "b": 2.5, "c": 0.25, "d": 0.0, "e": 0.0, "f": 0.0}


def test_no_live_row_is_lost(rows):
    batch = rows(SHAPE, [sale("a", "S1", 5), sale("b", "S1", 9), sale("c", "S2", 3)])
    live = rows(SHAPE, [sale("b", "S1", 9), sale("late", "S1", 4), sale("new", "S1", 10), sale("tie", "S1", 9), sale("first", "S9", 1), sale("future", "S1", 20), sale("x", None, 2)])
    got = {(r["tran_uid"], r["src_type"]) for r in N.fact(batch, live, at(15)).collect()}
    assert got == {("a", "BATCH"), ("b", "BATCH"), ("c", "BATCH"), ("late", "LATE"), ("tie", "LATE"), ("new", "NRT"), ("first", "NRT"), ("x", "NRT")}


def test_landing_twice_and_a_late_rate(spark, rows, store, rates, tmp_path):
    tables = VersionedTables(spark, str(tmp_path / "live"))
    live = rows(SHAPE, [sale("a", "S1", 10), sale("b", "S1", 12), sale("c", "S2", 12)])
    live.write.parquet(str(tmp_path / "in"))
    posted = rows("tran_uid string, posting_date date", [("b", dt.date(2024, 3, 14)), ("b", dt.date(2024, 3, 13))])
    land = lambda state: N.land(A.arriving_rows(spark, str(tmp_path / "in"), live.schema, max_files=1), tables, store, rates, posted, "live", str(tmp_path / state))
    land("state")
    assert tables.read("live").count() == 3
    n = len(tables.versions())
    land("state")
    land("lost checkpoint")  # replayed batches have committed keys
    assert tables.read("live").count() == 3 and len(tables.versions()) == n
    assert {r["tran_uid"]: r["settlement_date"] for r in tables.read("live").collect()} == {"a": None, "b": dt.date(2024, 3, 14), "c": None}

    right = rates.withColumn("proc_fee_percent", F.when(F.col("to_date").isNull() & (F.col("merchant") == "M1"), 3.0).otherwise(F.col("proc_fee_percent")))
    changed = right.where("merchant = 'M1' and to_date is null")
    with pytest.raises(Stopped):
        N.reprice(tables, store, right, changed, "late rate", after_write=stop_after("live"))
    fees = lambda: {r["tran_uid"]: r["processing_fee"] for r in tables.read("live").collect()}
    assert fees() == {"a": 1.0, "b": 2.5, "c": 0.25}
    assert N.reprice(tables, store, right, changed, "late rate") == ["2024-03-12"]
    assert fees() == {"a": 1.0, "b": 3.5, "c": 0.25}
    assert N.reprice(tables, store, right, changed, "late rate") == []


def test_state_of_a_week_is_closed_by_the_watermark(spark, rows, tmp_path):
    """A row one week late counts; one that comes after its week is closed doesn't open it anew."""
    calendar = fiscal_calendar(spark.sql("SELECT explode(sequence(DATE '2024-03-01', DATE '2024-04-30')) AS day"))
    schema = "ts timestamp, v long"
    files = [[("2024-03-04 10:00:00", 1), ("2024-03-10 23:59:59", 2)], [("2024-03-12 10:00:00", 4)], [("2024-03-05 10:00:00", 8)], [("2024-04-10 10:00:00", 16)], [("2024-03-06 10:00:00", 32), ("2024-04-11 10:00:00", 64)]]
    out, state, home = str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "in")
    for part in files:
        spark.createDataFrame(part, "ts string, v long").select(F.col("ts").cast("timestamp"), "v").coalesce(1).write.mode("append").parquet(home)
        stream = A.arriving_rows(spark, home, spark.createDataFrame([], schema).schema, max_files=1)
        totals = A.calendar_totals(stream, "ts", calendar, ["fw_start_date"], "fw_end_date", [], F.col("v"), "8 days")
        totals.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).outputMode("append").trigger(availableNow=True).start().awaitTermination()
    got = {r["fw_start_date"]: (r["rows"], r["total"]) for r in spark.read.parquet(out).collect()}
    assert got == {dt.date(2024, 3, 4): (3, 11), dt.date(2024, 3, 11): (1, 4)}
