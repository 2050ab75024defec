"""Versioned tables: one commit for several tables, repeats, stops, roll back; the settlement run on them."""

from __future__ import annotations

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.plans import settlement as P
from ledgerloom.plans import settlement_run as R
from ledgerloom.sinks.versions import CommitConflict, VersionedTables, Write, replace_days
from ledgerloom.workload.feeds import RUN_TS, Tables
from ledgerloom.workload.q_versions import _SHOWN, Stopped, _shown, stop_after


@pytest.fixture()
def tables(spark, tmp_path):
    return VersionedTables(spark, str(tmp_path / "tables"))


def all_of(tables, name, version=None):
    return sorted(map(tuple, tables.read(name, version).collect()), key=repr)


def test_parts_appends_and_old_versions(tables, rows):
    first = rows("x int, d string", [(1, "2001-01-01"), (2, "2001-01-02"), (3, None)])
    assert tables.commit("one", {"t": Write(first, by="d"), "u": Write(first)})
    assert not tables.commit("one", {"t": Write(first.limit(0), by="d")})
    second = rows("x int, d string", [(20, "2001-01-02"), (9, "a: b/c %41")])
    assert tables.commit("two", {"t": Write(second, "parts", "d", ("2001-01-01",)), "u": Write(second, "append")})
    assert all_of(tables, "t") == [(20, "2001-01-02"), (3, None), (9, "a: b/c %41")]
    assert all_of(tables, "t", 1) == [(1, "2001-01-01"), (2, "2001-01-02"), (3, None)]
    assert len(all_of(tables, "u")) == 5 and tables.tables() == ["t", "u"]
    assert [r[0] for r in tables.read("t", parts=["a: b/c %41", "2001-01-02"]).sort("x").collect()] == [9, 20]
    assert tables.commit("none", {"t": Write(first.limit(0))}) and all_of(tables, "t") == []
    assert tables.read("t").columns == ["x", "d"]
    assert tables.restore(2) == 4 and all_of(tables, "t") == all_of(tables, "t", 2)
    assert tables.holds("two") and not tables.holds("none")
    tables.vacuum()
    assert tables.versions() == [4] and len(all_of(tables, "u")) == 5 and len(all_of(tables, "t")) == 3
    with pytest.raises(ValueError):
        tables.read("t", 1)
    with pytest.raises(ValueError):
        tables.read("nothing")


def test_a_table_may_be_read_by_the_batch_that_replaces_it(tables, rows):
    tables.commit("one", {"t": Write(rows("x int", [(1,), (2,)]))})
    doubled = tables.read("t").select((F.col("x") * 2).alias("x"))
    tables.commit("two", {"t": Write(doubled), "copy": Write(lambda written: written("t").withColumn("run", F.lit("two")), "append", "run")})
    assert all_of(tables, "t") == [(2,), (4,)] and all_of(tables, "copy") == [(2, "two"), (4, "two")]


def test_of_two_runs_one_fails(tables, rows, spark):
    tables.commit("one", {"t": Write(rows("x int", [(1,)]))})
    other = VersionedTables(spark, tables.root)

    def meanwhile(step):
        if step == "commit":
            other.commit("other", {"t": Write(rows("x int", [(2,)]), "append")})

    with pytest.raises(CommitConflict):
        tables.commit("two", {"t": Write(rows("x int", [(3,)]), "append")}, meanwhile)
    assert all_of(tables, "t") == [(1,), (2,)]
    assert tables.commit("two", {"t": Write(rows("x int", [(3,)]), "append")})
    assert all_of(tables, "t") == [(1,), (2,), (3,)]
    tables.vacuum()
    assert [x for x in os.listdir(f"{tables.root}/_manifests") if not x.startswith(".")] == ["v=3"]


def test_replaced_days_go_back_when_their_check_fails(tables, rows):
    replace_days(tables, "t", rows("x int, d string", [(1, "a"), (2, "b")]), "d", "one", check=lambda now: False)  # nothing to go back to
    assert replace_days(tables, "t", rows("x int, d string", [(5, "b")]), "d", "two", check=lambda now: now.count() == 2) == 2
    assert replace_days(tables, "t", rows("x int, d string", [(6, "b"), (7, "b")]), "d", "three", check=lambda now: now.count() == 2) == 4
    assert all_of(tables, "t") == [(1, "a"), (5, "b")] and len(all_of(tables, "t", 3)) == 3


@pytest.fixture(scope="module")
def feeds(spark, tmp_path_factory):
    """The settlement feeds of the smallest tables, stored, so that plans stay short."""
    home = tmp_path_factory.mktemp("feeds")
    t = Tables(spark, "/root/testdata/sf0.001")
    out = {}
    for name in ("settlement_std", "settlement_window", "window_by_store", "store", "sap_map"):
        getattr(t, name).coalesce(1).write.parquet(f"{home}/{name}")
        out[name] = spark.read.parquet(f"{home}/{name}")
    return out


def state(tables):
    return sorted(map(tuple, _shown(tables).collect()))


def test_a_settlement_run_stopped_anywhere_changes_nothing(tables, feeds):
    R.start(tables, feeds["settlement_std"], feeds["settlement_window"], feeds["window_by_store"], "LOAD", "yyyy")
    before = {n: all_of(tables, n) for n in tables.tables()}
    run = lambda stop=None, ts=RUN_TS, batch="B1": R.run(tables, feeds["store"], feeds["sap_map"], batch, ts, after_write=stop)
    for step in ("result", "history", "audit", "windows_by_store", "windows", "control", "settlement", "commit"):
        with pytest.raises(Stopped):
            run(stop_after(step))
        assert tables.versions() == [1] and tables.tables() == sorted(before)
    assert all(all_of(tables, n) == r for n, r in before.items())
    assert not run(batch="NOContRec")
    assert run()
    after = state(tables)
    assert not run() and not run(ts=RUN_TS + dt.timedelta(days=1)) and state(tables) == after
    # every open row of a mapped store is in the file's batch, and only once
    settled = tables.read("settlement")
    assert settled.count() == len(before["settlement"])
    marked = settled.where(F.col("posting_date") == F.lit(RUN_TS.date())).count()
    posted = tables.read("audit").agg(F.sum("no_trans_posted")).first()[0]
    assert marked >= posted > 0
    lines = tables.read("result")
    details = lines.where("record_type = 'D'")
    trailer = lines.where("record_type = 'T'").agg(F.sum("line_count"), F.sum("amount_cents")).first()
    assert tuple(trailer) == tuple(details.agg(F.count("*"), F.sum("amount_cents")).first())
    # nothing is open any more: the next run posts no line and no audit or control row
    assert run(ts=RUN_TS + dt.timedelta(days=1), batch="B2")
    assert tables.read("result").where("record_type = 'D'").isEmpty()
    assert {r["batch_number"] for r in tables.read("control").collect()} == {"B1"}
    assert tables.read("history").where("run = 'B1'").count() == lines.count()
    assert set(_SHOWN) == set(tables.tables())


def test_a_run_leaves_settled_rows_where_they_are(tables, feeds):
    """Settled rows are not written anew; open rows of one id share the greatest file; rows without an id or a mapping stay."""
    file_of = {r["company_code"]: r["file_name"] for r in P.company_files(feeds["sap_map"], "LEDGER", RUN_TS).collect()}
    store_of = {r["company_code"]: r["store_number"] for r in feeds["sap_map"].where("active_flag = 'Y'").collect()}
    low, high = sorted(store_of, key=file_of.get)[:2]
    odd = feeds["settlement_std"].where("setlmnt_result_file IS NULL AND tran_uid NOT LIKE 'QP%'").limit(1)
    twins = [odd.withColumns({"tran_uid": F.lit("TC_twin"), "store_id": F.lit(store_of[c])}) for c in (low, high)]
    std = feeds["settlement_std"].unionByName(twins[0]).unionByName(twins[1]).unionByName(odd.withColumn("tran_uid", F.lit(None).cast("string")))
    std = std.unionByName(odd.withColumns({"tran_uid": F.lit("TC_unmapped"), "store_id": F.lit("S999999999")}))
    R.start(tables, std, feeds["settlement_window"], feeds["window_by_store"], "LOAD", "yyyy")
    folders = lambda version: {r["folder"] for r in tables.manifest(version).where("entry = 'folder' AND table_name = 'settlement'").collect()}
    settled = {f for f in folders(1) if "open" not in f}
    assert R.run(tables, feeds["store"], feeds["sap_map"], "B1", RUN_TS)
    assert settled and settled <= folders(2) and not (folders(1) - settled) & folders(2)
    now = tables.read("settlement")
    assert now.count() == std.count() and now.where("tran_uid IS NULL").count() == 1
    assert [r["setlmnt_result_file"] for r in now.where("tran_uid = 'TC_twin'").collect()] == [file_of[high]] * 2
    still_open = tables.read("settlement", parts=[p for p in tables.parts("settlement") if p.endswith(" open")])
    assert still_open.where("tran_uid = 'TC_unmapped'").count() == 1 and still_open.where("setlmnt_result_file IS NOT NULL").isEmpty()
