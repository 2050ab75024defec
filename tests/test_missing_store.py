"""The missing-store report works its sources out once, for days that a window reaches."""

from __future__ import annotations

from ledgerloom.plans import missing_store as N
from ledgerloom.plans import settlement as S
from ledgerloom.workload import q_settlement as Q
from ledgerloom.workload.feeds import RUN_TS, Tables
from ledgerloom.workload.scratch import kept

SMALL = "/root/testdata/sf0.001"


def test_missing_store_report_reads_its_sources_once_and_only_days_a_window_reaches(spark):
    t = Tables(spark, SMALL)
    seen = []

    def keep(rows):
        seen.append(rows)
        return kept(rows)

    tables = [t.store, t.settlement_window, t.window_by_store, t.sap_map, t.factor, t.log_flags, t.settlement_std]
    found = N.report(S.combined(Q._sources(t)), *tables, "B9", RUN_TS, keep)
    assert len(seen) == 1 and "lineitem" not in found._jdf.queryExecution().optimizedPlan().toString()
    plan = seen[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("scalar-subquery") > 0
    assert sorted(found.collect()) == sorted(N.report(S.combined(Q._sources(t)), *tables, "B9", RUN_TS).collect())
