"""Timeframes, lenses and windows of a store stay in the partition its days were sent to, and partitions follow the rows."""

from __future__ import annotations

import re

from ledgerloom.plans import analytics as P
from ledgerloom.workload import q_analytics as Q
from ledgerloom.workload.feeds import Tables
from ledgerloom.workload.scratch import kept


def _exchanges(df) -> list[str]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.findall(r"Exchange hashpartitioning\((.*?), (\d+)\), (\w+)", plan)


def test_auth_rates_move_their_rows_twice(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    plan = P.auth_rates(t.billing, t.store, calendar=t.calendar, parts=7)
    assert "Expand" not in plan._jdf.queryExecution().executedPlan().toString()
    asked = [e for e in _exchanges(plan) if e[1] == "7"]
    assert asked and all(how == "REPARTITION_BY_NUM" for _, _, how in asked)
    # what else moves are the sums over all stores
    assert not [keys for keys, _, how in _exchanges(plan) if how != "REPARTITION_BY_NUM" and "timeframe" in keys and "store_id" in keys and "All" not in keys]


def test_payments_move_their_rows_twice(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    plan = P.payments_and_refunds(t.billing, t.store, calendar=t.calendar, parts=7)
    moved = [e for e in _exchanges(plan) if "timeframe" in e[0]]
    assert not moved and [e[1] for e in _exchanges(plan)].count("7") == 2


def test_payments_move_no_rows_for_their_stores(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    links = t.chargebacks.where("id % 2 = 0").selectExpr("id", "'VISA' AS scheme", "'CREDIT' AS card_type")
    for plan in (Q._payments(t), Q._snapshot(t), P.payments_snapshot(t.billing, t.chargebacks, t.store, links, calendar=t.calendar, parts=7, once=kept)):
        moved = _exchanges(plan)
        assert moved and not [keys for keys, _, _ in moved if keys.startswith("__k")]
    # stores too large to send to every task meet the day rows in these rows' partitions, chargebacks those of their id
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "300")
    try:
        plan = P.payments_snapshot(t.billing, t.chargebacks, t.store, links, calendar=t.calendar, parts=7, once=kept)
        assert "SortMergeJoin [__k0" in plan._jdf.queryExecution().executedPlan().toString()
        moved = _exchanges(plan)
        assert {n for keys, n, _ in moved if keys.startswith("id#")} == {"7"}
        assert "7" in {n for keys, n, _ in moved if keys.startswith("__k0")}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_snapshot_flags_its_oldest_periods_in_place(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    links = t.chargebacks.where("id % 2 = 0").selectExpr("id", "'VISA' AS scheme", "'CREDIT' AS card_type")
    for limit in ("10m", "300"):  # stores that are sent to every task, and stores too large for it
        before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            plan = P.payments_snapshot(t.billing, t.chargebacks, t.store, links, calendar=t.calendar, parts=7, once=kept)
            moved = _exchanges(plan)
        finally:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        # four timeframes would be four partitions with all rows; the subquery's exchange holds a row for each
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert "[timeframe#" not in "".join(re.findall(r"Join (\[.*?\])", text))
        # disputes' days are dealt by the key that finds their store, so the join and the timeframes move them no more
        assert {n for keys, n, _ in moved if keys.startswith("__k0")} <= {"7"}
        assert not [keys for keys, _, _ in moved if keys.startswith("timeframe") and "store_id" in keys]


def test_snapshot_flags_the_oldest_period_of_payments(spark):
    billing = spark.sql(
        """SELECT store_id, cast(d AS date) AS tran_date, 'PURCHASE' AS kind, a AS approval, 100L AS amount_cents, 'VISA' AS scheme, 'CREDIT' AS card_type
        FROM VALUES ('S1', '2020-01-30', 'A'), ('S1', '2020-02-02', 'A'), ('S2', '2020-02-04', 'A'), ('S2', '2019-12-01', 'D'), ('S2', null, 'A') v(store_id, d, a)"""
    )
    cases = spark.sql(
        """SELECT id, store_id, date'2020-03-01' AS file_date, 5L AS amount_cents, cast(d AS timestamp_ntz) AS received_dt
        FROM VALUES (1, 's1', '2020-01-31 10:00:00'), (2, 'S1', '2020-01-30 09:00:00'), (3, 's2', '2019-12-01 08:00:00') v(id, store_id, d)"""
    )
    links = spark.sql("SELECT 1 AS id, 'VISA' AS scheme, 'CREDIT' AS card_type")
    store = spark.sql("SELECT store_id, 'C' AS company, 'B' AS brand, 'Online' AS is_online FROM VALUES ('S1'), ('S2') v(store_id)")
    for once in (None, kept):
        rows = P.payments_snapshot(billing, cases, store, links, parts=3, once=once).collect()
        found = sorted((r.timeframe, str(r.period_start), r.store_id, r.company, r.min_flag or "", r.purchase_count or 0, r.dispute_count or 0) for r in rows)
        assert [f for f in found if f[0] == "Day"] == [
            ("Day", "2019-12-01", "s2", "C", "", 0, 1),
            ("Day", "2020-01-30", "S1", "C", "min_day", 0, 1),
            ("Day", "2020-01-30", "S1", "C", "min_day", 1, 0),
            ("Day", "2020-01-31", "s1", "C", "", 0, 1),
            ("Day", "2020-02-02", "S1", "C", "", 1, 0),
            ("Day", "2020-02-04", "S2", "C", "", 1, 0),
            ("Day", "None", "S2", "C", "", 1, 0),
        ]
        assert {f[1] for f in found if f[4] == "min_week"} == {"2020-01-27"} and {f[1] for f in found if f[4] == "min_month"} == {"2020-01-01"}
        assert P.payments_snapshot(billing.where("false"), cases, store, links, parts=3, once=once).where("min_flag IS NOT NULL").count() == 0
