"""A table whose swap stopped between its renames."""

from __future__ import annotations

import uuid

import pytest

from ledgerloom.sinks import tables as S


@pytest.fixture()
def database(spark, tmp_path):
    name = "scratch_" + uuid.uuid4().hex
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def values(spark, table):
    return sorted(r[0] for r in spark.table(table).collect())


def test_a_stopped_swap_is_put_back(spark, rows, database):
    table = f"{database}.t"
    assert not S.recover_table(spark, table)
    S.replace_table(rows("x int", [(1,)]), table)
    assert not S.recover_table(spark, table)
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}__old_abc")  # where a run may stop
    assert S.recover_table(spark, table)
    assert values(spark, table) == [1]
    spark.sql(f"ALTER TABLE {table} RENAME TO {table}__old_def")
    S.replace_table(rows("x int", [(2,)]), table)  # the next run puts it back by itself
    assert values(spark, table) == [2]
    assert {t.name for t in spark.catalog.listTables(database)} == {"t"}
    spark.sql(f"CREATE TABLE {table}__old_ghi AS SELECT 9 AS x")  # another run's, still at work
    assert not S.recover_table(spark, table) and values(spark, table) == [2]


def test_two_lost_versions_are_not_guessed(spark, rows, database):
    table = f"{database}.t"
    for own in ("a", "b"):
        rows("x int", [(1,)]).write.saveAsTable(f"{table}__old_{own}")
    with pytest.raises(ValueError, match="one of them"):
        S.recover_table(spark, table)
