"""Every registered query against its oracle on the smallest tables, and the shape of its plan."""

from __future__ import annotations

import pytest
from compare import check, duck
from plan_rules import assert_scales

import __spark_entry__ as entry
from ledgerloom.workload import load

PATH = "/root/testdata/sf0.001"
QUERIES, ORACLE = dict(load().QUERIES), dict(load().ORACLE)


@pytest.fixture(scope="module")
def con():
    return duck(PATH)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    problem, _, _ = check(spark, con, PATH, name, QUERIES[name], ORACLE.get(name), lambda df: assert_scales(name, df))
    assert problem is None


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


def test_entry_registers_them_all():
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    assert entry.entry(spark).columns
