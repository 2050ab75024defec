"""Fees without a trace don't meet in one task, and a trace's newest fee is found without a join."""

from __future__ import annotations

import datetime as dt

from ledgerloom.plans import benchmark as B
from ledgerloom.plans import fees as P
from ledgerloom.workload import q_fees as Q
from ledgerloom.workload.feeds import Tables

SMALL = "/root/testdata/sf0.001"


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_fees_without_a_trace_take_no_part_in_the_join(spark):
    t = Tables(spark, SMALL)
    plan = _optimized(Q._fees(t))
    assert plan.index("Union") < plan.index("Join LeftOuter")
    assert Q._fees(t).count() == t.scheme_fee.count()


def test_newest_fee_takes_no_join(spark):
    t = Tables(spark, SMALL)
    assert "LeftSemi" not in _optimized(P.scheme_fee_report(t.acquirer_txn, t.scheme_fee, t.store, t.rate_card, "VISA", 10))


def test_newest_fee_with_ties_and_gaps(spark, rows):
    t = Tables(spark, SMALL)
    day = dt.datetime(2001, 1, 1)
    own = t.acquirer_txn.where("scheme = 'VISA' AND coalesce(transaction_approval_status, 0) = 0").limit(1)
    r = own.first()
    loads = [(day, 5), (day + dt.timedelta(1), 7), (day + dt.timedelta(1), 9), (day + dt.timedelta(1), None), (None, 99)]
    fees = rows("trace_id long, load_time timestamp_ntz, term_id string, transaction_amt long, interchange_fee long", [(r.tran_uid, at, "none", r.transaction_amount, fee) for at, fee in loads])
    got = P.scheme_fee_report(t.acquirer_txn.where(f"tran_uid = {r.tran_uid}"), fees, t.store, t.rate_card, "VISA", 10).first()
    assert got.match_step == 1 and abs(abs(got.interchange_fee) - 9 / 1000000 / 1.1) < 1e-12


def test_store_levels_stay_with_their_store(spark):
    t = Tables(spark, SMALL)
    out = B.performance_levels(t.billing, t.store, 7)
    plan = out._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "month" in line and "store_id" in line]
    assert not moved and "REPARTITION_BY_NUM" in plan
