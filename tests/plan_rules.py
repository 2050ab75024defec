"""What no plan may contain at scale."""

from __future__ import annotations

import re

# the top level of a running total and the rank of calendar periods see bounded tables only
BOUNDED_WINDOWS = ("f11_running_sum_global", "f13_period_rank", "m_customer_profile_running_across", "m_gift_commission", "m_gift_commissions", "m_gift_detail", "m_gift_sales_summary")
PYTHON_OR_PRODUCT = ("PythonUDF", "ArrowEvalPython", "BatchEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "CartesianProduct")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def assert_scales(name: str, df) -> None:
    plan = plan_of(df)
    for node in PYTHON_OR_PRODUCT:
        assert node not in plan, node
    if name != "e04_theta_join":
        assert "BroadcastNestedLoopJoin" not in plan
    if name not in BOUNDED_WINDOWS:
        without_totals = re.sub(r"Aggregate\(keys=\[\][^\n]*\n[^\n]*Exchange SinglePartition", "", plan)
        assert "SinglePartition" not in without_totals or "Window" not in plan
