"""Plan shape of single operators (the rules for all queries are in plan_rules)."""

from __future__ import annotations

import re

from plan_rules import plan_of

import __spark_entry__ as entry

PATH = "/root/testdata/sf0.001"
QUERIES = entry.queries()
def test_rule8_prunes_and_pushes_down(spark):
    plan = plan_of(QUERIES["i13_rule8_cashout_baseline"](spark, PATH))
    scan = next(line for line in plan.splitlines() if "lineitem.parquet" in line or "l_shipdate" in line and "FileScan" in line)
    assert "l_discount" not in scan and "l_extendedprice" not in scan


def test_rank_filters_cut_groups_before_the_shuffle(spark):
    for name in ("f01_keep_first", "f04_qualify_first"):
        plan = plan_of(QUERIES[name](spark, PATH))
        assert re.search(r"WindowGroupLimit.*Partial", plan)


def test_one_aggregate_feeds_all_levels(spark):
    plan = plan_of(QUERIES["d19_levels_with_all"](spark, PATH))
    assert plan.count("FileScan") == 4 and "Expand" in plan
    below = plan[plan.index("Expand") :]
    assert "HashAggregate" in below  # facts are summed before they are expanded
