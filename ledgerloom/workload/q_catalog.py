"""Checked operators that write tables of a catalog (B-01..B-06, I-06, I-08, J-04, J-11), each in a scratch database."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators import control as O
from ledgerloom.operators import recon as Q
from ledgerloom.sinks import tables as W
from ledgerloom.workload.feeds import RUN_TS, Tables
from ledgerloom.workload.registry import query
from ledgerloom.workload.scratch import kept, scratch_database

col = F.col


@query("b01_truncate_insert", "SELECT o_orderkey, -CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders")
def _b01(t: Tables):
    """The second load reads the table that it replaces."""
    with scratch_database(t.spark) as db:
        W.replace_table(t.orders.select("o_orderkey", F.round(col("o_totalprice") * 100).cast("long").alias("cents")), f"{db}.t")
        W.replace_table(t.spark.table(f"{db}.t").withColumn("cents", -col("cents")), f"{db}.t")
        return kept(t.spark.table(f"{db}.t"))


@query("b02_create_or_replace_as", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def _b02(t: Tables):
    with scratch_database(t.spark) as db:
        W.replace_table(t.customer.select("c_custkey"), f"{db}.t")
        W.replace_table(t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n")), f"{db}.t")
        return kept(t.spark.table(f"{db}.t"))


@query("b05_write_warehouse", "SELECT s_suppkey AS id, s_name AS name, 'S' AS kind FROM supplier UNION ALL SELECT c_custkey, NULL, 'C' FROM customer")
def _b05(t: Tables):
    """Columns are matched by name; one that is missing is null."""
    with scratch_database(t.spark) as db:
        W.append(t.supplier.select(col("s_suppkey").alias("id"), col("s_name").alias("name"), F.lit("S").alias("kind")), f"{db}.t")
        W.append(t.customer.select(F.lit("C").alias("kind"), col("c_custkey").alias("id")), f"{db}.t")
        return kept(t.spark.table(f"{db}.t"))


@query(
    "b06_history",
    "SELECT CAST(run_ts AS VARCHAR) AS run_ts, n_name, n * k AS n FROM (SELECT n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1), (VALUES (TIMESTAMP '2001-07-15 06:30:00', 1), (TIMESTAMP '2001-07-16 06:30:00', 2)) v(run_ts, k)",
)
def _b06(t: Tables):
    """Two runs' outputs in one history."""
    per = t.customer.join(t.nation, col("c_nationkey") == col("n_nationkey")).groupBy("n_name").agg(F.count("*").alias("n"))
    with scratch_database(t.spark) as db:
        W.history_append(per, f"{db}.h", RUN_TS)
        W.history_append(per.withColumn("n", col("n") * 2), f"{db}.h", RUN_TS + dt.timedelta(days=1))
        return kept(t.spark.table(f"{db}.h"))


@query("j04_full_reload", "SELECT c_custkey, c_name FROM customer")
def _j04(t: Tables):
    with scratch_database(t.spark) as db:
        W.replace_table(t.customer.select("c_custkey", F.lit("old").alias("c_name")), f"{db}.t")
        W.replace_table(t.customer.select("c_custkey", "c_name"), f"{db}.t")
        return kept(t.spark.table(f"{db}.t"))


@query("j11_staged_inserts", "SELECT DISTINCT card, src FROM (SELECT 'TK' || CAST(l_partkey AS VARCHAR) AS card, 'switch' AS src FROM lineitem UNION ALL SELECT CAST(o_custkey AS VARCHAR), 'wallet' FROM orders UNION ALL SELECT c_name, 'gift' FROM customer)")
def _j11(t: Tables):
    """Three inserts into a stage, each of what the stage lacks, then one table from it."""
    sources = [
        t.lineitem.select(F.concat(F.lit("TK"), col("l_partkey").cast("string")).alias("card"), F.lit("switch").alias("src")),
        t.orders.select(col("o_custkey").cast("string").alias("card"), F.lit("wallet").alias("src")),
        t.customer.select(col("c_name").alias("card"), F.lit("gift").alias("src")),
    ]
    with scratch_database(t.spark) as db:
        W.append(sources[0].distinct(), f"{db}.stage")
        for source in [*sources[1:], sources[0]]:
            W.append(W.only_new(source.distinct(), t.spark.table(f"{db}.stage"), ["card", "src"]), f"{db}.stage")
        W.replace_table(t.spark.table(f"{db}.stage"), f"{db}.cards")
        return kept(t.spark.table(f"{db}.cards"))


@query(
    "i06_schema_drift",
    "SELECT d.*, r.rows FROM (VALUES (2, 'o_custkey', 'bigint', 'o_custkey', 'string'), (4, 'total', 'double', 'o_totalprice', 'double'), (6, 'o_orderpriority', 'string', NULL, NULL)) d(ordinal_position, actual_name, actual_type, expected_name, expected_type), (SELECT count(*) AS rows FROM orders) r",
)
def _i06(t: Tables):
    """Findings on a stored table whose columns were renamed, added and retyped, with the rows they concern."""
    expected = t.orders.select("o_orderkey", col("o_custkey").cast("string").alias("o_custkey"), "o_orderstatus", "o_totalprice", "o_orderdate").schema
    with scratch_database(t.spark) as db:
        W.replace_table(t.orders.withColumnRenamed("o_totalprice", "total"), f"{db}.t")
        actual = t.spark.table(f"{db}.t")
        rows = kept(actual.agg(F.count("*").alias("rows")))
        return Q.schema_drift(t.spark, actual.schema, expected).withColumn("rows", rows.scalar())


@query("i08_validated_swap", "SELECT s_suppkey, upper(s_name) AS s_name FROM supplier")
def _i08(t: Tables):
    """A dimension with repeated keys and one of another shape are turned away, a right one is swapped in."""
    with scratch_database(t.spark) as db:
        W.replace_table(t.supplier.select("s_suppkey", "s_name"), f"{db}.dim")
        now = t.spark.table(f"{db}.dim").schema
        right = t.supplier.select("s_suppkey", F.upper("s_name").alias("s_name"))
        swap = lambda new: O.validated_swap(new, f"{db}.dim", Q.duplicate_keys(new, ["s_suppkey"]), Q.schema_drift(t.spark, new.schema, now))
        taken = [swap(right.unionByName(right)), swap(right.withColumnRenamed("s_name", "name")), swap(right)]
        if taken != [False, False, True]:
            raise ValueError(f"swaps {taken}")
        return kept(t.spark.table(f"{db}.dim"))
