"""Catalog scan and reconciliation, and the fee-listing run's days, gaps and views."""

from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import control as O
from ledgerloom.operators import recon as Q
from ledgerloom.plans import fee_run as R
from ledgerloom.sources.tables import local_table


@pytest.fixture()
def database(spark, tmp_path):
    name = "scratch_" + uuid.uuid4().hex
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


DAY = dt.date(2024, 3, 10)


def test_the_plan_comes_from_the_catalog(spark, rows, database, tmp_path):
    put = lambda df, name: df.write.option("path", f"{tmp_path}/t/{name}").saveAsTable(f"{database}.{name}")
    put(rows("file_date date, file_name string, load_time timestamp_ntz, x int", [(dt.date(2024, 3, 9), "a", dt.datetime(2024, 3, 9, 1), 1), (dt.date(2024, 3, 9), "a", dt.datetime(2024, 3, 9, 1), 2), (dt.date(2024, 3, 9), "b", None, 3), (dt.date(2024, 3, 2), "old", None, 4), (DAY, "today", None, 5), (None, "none", None, 6)]), "named")
    put(rows("load_dttm timestamp_ntz", [(dt.datetime(2024, 3, 3, 0, 0),), (dt.datetime(2024, 3, 9, 23, 59),), (dt.datetime(2024, 3, 10, 0, 0),)]), "timed")
    put(rows("file_date string", [("2024-03-05",), ("not a date",)]).select(F.expr("try_cast(file_date AS date)").alias("file_date")), "bare")
    put(rows("x int", [(1,)]), "undated")
    spark.sql(f"CREATE VIEW {database}.a_view AS SELECT * FROM {database}.named")
    names = {(r["table_name"], r["column_name"]) for r in Q.catalog_scan(spark, [database]).collect()}
    assert ("undated", "x") in names and not any(t == "a_view" for t, _ in names)
    out = Q.catalog_reconciliation(spark, [database], DAY)
    got = out.collect()
    assert len(got) == 3 * 7 + 1  # one day of one table has two files
    found = {(r["table_name"], r["file_date"].day, r["file_name"], r["rows"]) for r in got if r["rows"]}
    assert found == {("named", 9, "a", 2), ("named", 9, "b", 1), ("timed", 3, " ", 1), ("timed", 9, " ", 1), ("bare", 5, " ", 1)}
    assert {r["file_name"] for r in got if not r["rows"]} == {None}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoop" not in plan


def test_a_catalog_without_dated_tables(spark, rows, database, tmp_path):
    rows("x int", [(1,)]).write.option("path", f"{tmp_path}/t/x").saveAsTable(f"{database}.x")
    assert Q.catalog_reconciliation(spark, [database], DAY).collect() == []


def control(spark, *batches):
    made = [(f"FTLF{n:09d}", day, f"P{k}_feelist_V1", True, None, dt.datetime.combine(day, dt.time()), dt.datetime.combine(day, dt.time()), at, None) for n, (at, days) in enumerate(batches, 1) for day in days for k in range(2)]
    return local_table(spark, O.CONTROL_SCHEMA, made + [("ZZ9", DAY, "another export", True, None, None, None, dt.datetime(2030, 1, 1), None)])


def test_days_to_catch_up(spark):
    d = lambda n: dt.date(2024, 3, n)
    assert R.catch_up_days(control(spark), DAY) == [d(6)]
    assert R.catch_up_days(control(spark, (dt.datetime(2024, 3, 9, 5), [d(5)])), DAY) == [d(6)]
    assert R.catch_up_days(control(spark, (dt.datetime(2024, 3, 9, 5), [d(5)]), (dt.datetime(2024, 3, 6, 5), [d(2)])), DAY) == [d(3), d(4), d(5), d(6)]
    assert R.next_batch(control(spark)) == "FTLF000000001"
    assert R.next_batch(control(spark, (dt.datetime(2024, 3, 9, 5), [d(5)]))) == "FTLF000000002"


CONFIG = "file_prefix string, version string, file_prefix_old string, version_old string"


def test_gaps_and_control_rows(spark, rows):
    config = rows(CONFIG, [("P0", "V1", None, None), ("P1", "V1", "OLD", "V1"), (None, "V1", "X", None), ("P0", "V1", "", "V1")])
    names = {r["name"]: r["seq"] for r in R.listing_names(config).collect()}
    assert names == {"OLD_feelist_V1": 0, "P0_feelist_V1": 1, "P1_feelist_V1": 2}
    known = control(spark, (dt.datetime(2024, 3, 9, 5), [dt.date(2024, 3, 5)]))
    gaps = {(r["name"], r["day"].day) for r in R.control_gaps(known, config, dt.date(2024, 3, 4), dt.date(2024, 3, 5)).collect()}
    assert gaps == {("OLD_feelist_V1", 4), ("OLD_feelist_V1", 5), ("P0_feelist_V1", 4), ("P1_feelist_V1", 4)}
    made = R.listing_control(config, [dt.date(2024, 3, 4), dt.date(2024, 3, 5)], "B", dt.datetime(2024, 3, 9, 5))
    assert made.count() == 6 and O.pending(made).count() == 6
    assert R.control_gaps(made, config, dt.date(2024, 3, 4), dt.date(2024, 3, 5)).isEmpty()


def test_one_view_a_prefix(spark, rows):
    listing = rows("file_prefix string, a int, b int", [("P0", 1, 2), ("P1", 3, 4), ("it's", 5, 6)])
    config = rows(CONFIG, [("P0", "W1", None, None), ("P1", "W2", None, None)])
    layouts = {"W1": ["a"], "W2": ["b", "a"]}
    assert R.create_listing_views(listing, config, layouts) == ["vw_p0_fee_listing_w1", "vw_p1_fee_listing_w2"]
    assert [tuple(r) for r in spark.table("vw_p0_fee_listing_w1").collect()] == [(1,)]
    assert spark.table("vw_p1_fee_listing_w2").columns == ["b", "a"]
    more = rows(CONFIG, [("P0", "W1", "it's", "W2")])
    assert R.create_listing_views(listing, more, layouts) == ["vw_it_s_fee_listing_w2"]
    assert [tuple(r) for r in spark.table("vw_it_s_fee_listing_w2").collect()] == [(6, 5)]
    with pytest.raises(ValueError, match="one view"):
        R.create_listing_views(listing, rows(CONFIG, [("a b", "W1", "a-b", "W1")]), layouts)
    with pytest.raises(ValueError, match="no layout W3"):
        R.create_listing_views(listing, rows(CONFIG, [("P0", "W3", None, None)]), layouts)


def test_queries_leave_no_views_in_the_session(spark):
    from ledgerloom.workload import q_files, q_runs
    from ledgerloom.workload.feeds import Tables

    t = Tables(spark, "/root/testdata/sf0.001")
    for made in (q_files._b11(t), q_runs._fee_run(t)):
        left = {v.name for v in spark.catalog.listTables() if v.isTemporary}
        assert not [v for v in left if v == "ledgerloom_customers" or "_fee_listing_v" in v]
        assert made.count()
