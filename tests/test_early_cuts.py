"""Rows that can't pass go before the joins, and marks of a few groups go to the rows."""

from __future__ import annotations

import datetime as dt

from ledgerloom.plans import settlement as P
from ledgerloom.sources import ingest as I
from ledgerloom.workload import q_settlement as Q
from ledgerloom.workload.feeds import RUN_DATE, Tables


def test_high_water_moves_no_rows_by_group(spark, rows):
    src = rows("org string, file_date date, n int", [("a", dt.date(2001, 1, d), d) for d in range(1, 6)] + [("b", dt.date(2001, 1, 1), 9)])
    out = I.above_group_high_water(src, src.where("org = 'a' AND n < 4").repartition(3), "org")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.n for r in out.collect()) == [4, 5, 9]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(64 * 1024 * 1024))


def test_pre_settlement_cuts_old_rows_before_the_joins(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    plan = P.pre_settlement(P.combined(Q._sources(t)), t.store, t.settlement_window, t.window_by_store, t.sap_map, t.factor, t.settlement_std, RUN_DATE)._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" in plan
