"""Checked window operators (F-01..F-16)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.functions import dates as D
from ledgerloom.operators import windows as W
from ledgerloom.workload.feeds import BASELINE_FROM, Tables
from ledgerloom.workload.registry import query
from ledgerloom.workload.scratch import new_folder

col = F.col
_FULL = "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"


def _order():
    return [col(c.strip()) for c in _FULL.split(",")]


@query("f01_keep_first", f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_FULL}) AS rn FROM lineitem) WHERE rn = 1")
def _f01(t: Tables):
    return W.keep_first(t.lineitem, ["l_orderkey", "l_linenumber"], _order()).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")


@query("f02_reject_all_copies", "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) = 1")
def _f02(t: Tables):
    return W.reject_all_copies(t.lineitem, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")


@query(
    "f03_flag_duplicates",
    f"SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, CASE WHEN row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_FULL}) > 1 THEN 'Duplicate transaction' END AS finding FROM lineitem",
)
def _f03(t: Tables):
    out = W.flag_duplicates(t.lineitem, ["l_orderkey", "l_linenumber"], _order(), col("l_shipdate").cast("date"), "Duplicate transaction", "finding")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "finding")


@query("f04_qualify_first", "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id) = 1")
def _f04(t: Tables):
    return W.keep_first(t.events, ["user_id", "event_type"], [col("ts").desc(), col("event_id")]).select("user_id", "event_type", "event_id", "value")


@query("f05_total_order_pick", "SELECT conv_id, max(turn) AS turn, max_by(role, turn) AS role FROM conversations GROUP BY conv_id")
def _f05(t: Tables):
    return W.keep_first(t.conversations, ["conv_id"], [col("turn").desc(), col("role")]).select("conv_id", "turn", "role")


@query("f06_rank_latest_load", "SELECT trace_id, transaction_amt, fee_code, interchange_fee FROM scheme_fee WHERE trace_id IS NOT NULL QUALIFY rank() OVER (PARTITION BY trace_id ORDER BY load_time DESC) = 1")
def _f06(t: Tables):
    return W.latest_with_ties(t.scheme_fee.where(col("trace_id").isNotNull()), ["trace_id"], "load_time").select("trace_id", "transaction_amt", "fee_code", "interchange_fee")


@query(
    "f07_lag_gap_days",
    """SELECT user_id, CAST(d AS VARCHAR) AS d, n, CAST(lag(d) OVER w AS VARCHAR) AS previous_day, date_diff('day', lag(d) OVER w, d) - 1 AS gap_days FROM (SELECT user_id, CAST(ts AS DATE) AS d, count(*) AS n FROM events GROUP BY ALL)
 WINDOW w AS (PARTITION BY user_id ORDER BY d)""",
)
def _f07(t: Tables):
    per = t.events.groupBy("user_id", col("ts").cast("date").alias("d")).agg(F.count("*").alias("n"))
    return W.lag_gap(per, ["user_id"], "d", "previous_day", "gap_days")


_M = "m AS (SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS mon, sum(CASE WHEN o_orderstatus = 'P' THEN 0 ELSE CAST(round(o_totalprice * 100) AS BIGINT) END) AS v, count(*) AS n, day(last_day(CAST(any_value(date_trunc('month', o_orderdate)) AS DATE))) AS days FROM orders GROUP BY 1, 2)"
_J = "FROM m " + " ".join(f"LEFT JOIN m p{i} ON p{i}.o_custkey = m.o_custkey AND p{i}.mon = m.mon - INTERVAL {i} MONTH" for i in (1, 2, 3))
_SUM = "CAST(coalesce(p1.v, 0) + coalesce(p2.v, 0) + coalesce(p3.v, 0) AS DOUBLE)"


def _w(weight: str) -> str:
    return " + ".join(f"CASE WHEN coalesce(p{i}.v, 0) = 0 THEN 0 ELSE {weight.format(i=i)} END" for i in (1, 2, 3))


def _months(t: Tables):
    cents = F.when(col("o_orderstatus") == "P", 0).otherwise(F.round(col("o_totalprice") * 100).cast("long"))
    per = t.orders.groupBy("o_custkey", D.month_start(col("o_orderdate").cast("date")).alias("mon")).agg(F.sum(cents).alias("v"), F.count("*").alias("n"))
    return per.withColumn("days", D.days_in_month(col("mon")))


def _rolled(sql: str) -> str:
    return f"WITH {_M} SELECT m.o_custkey, CAST(m.mon AS VARCHAR) AS mon, {sql} AS baseline {_J}"


@query("f08_rolling_nonzero_average", _rolled(f"CASE WHEN m.mon < DATE '{BASELINE_FROM}' OR ({_w('1')}) = 0 THEN NULL ELSE {_SUM} / ({_w('1')}) END"))
def _f08(t: Tables):
    out = W.rolling_previous(_months(t), ["o_custkey"], "mon", {"baseline": W.rolling_nonzero(col("v"))}, BASELINE_FROM)
    return out.select("o_custkey", "mon", "baseline")


@query("f09_rolling_day_weighted", _rolled(f"CASE WHEN ({_w('p{i}.days')}) = 0 THEN 0 ELSE {_SUM} / ({_w('p{i}.days')}) END"))
def _f09(t: Tables):
    out = W.rolling_previous(_months(t), ["o_custkey"], "mon", {"baseline": W.rolling_nonzero(col("v"), col("days"))}, empty=0)
    return out.select("o_custkey", "mon", "baseline")


@query("f10_rolling_value_per_transaction", _rolled(f"{_SUM} / nullif(coalesce(p1.n, 0) + coalesce(p2.n, 0) + coalesce(p3.n, 0), 0)"))
def _f10(t: Tables):
    out = W.rolling_previous(_months(t), ["o_custkey"], "mon", {"baseline": (col("v"), col("n"))})
    return out.select("o_custkey", "mon", "baseline")


@query("f11_running_sum_global", "SELECT event_id, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (ORDER BY user_id, ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM events")
def _f11(t: Tables):
    hit = F.when(col("event_type") == "purchase", 1).otherwise(0).cast("long")
    # buckets follow the global order: user and day inside, a bounded range of users on top
    buckets = [F.struct(col("user_id"), col("ts").cast("date")), W.range_bucket(t.events, "user_id")]
    return W.running_sum(t.events, [], [col("user_id"), col("ts"), col("event_id")], hit, buckets, "running").select("event_id", "running")


@query("f11_running_sum_per_user", "SELECT event_id, CAST(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS running FROM events")
def _f11p(t: Tables):
    hit = F.when(col("event_type") == "purchase", 1).otherwise(0).cast("long")
    return W.running_sum(t.events, ["user_id"], [col("ts"), col("event_id")], hit, col("ts").cast("date"), "running").select("event_id", "running")


@query(
    "f12_nth_occurrence",
    """SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth_of_user, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS nth_of_type FROM events""",
)
def _f12(t: Tables):
    order, day = [col("ts"), col("event_id")], col("ts").cast("date")
    one = W.sequence_in_group(t.events, ["user_id"], order, day, "nth_of_user", t.events)
    return W.sequence_in_group(one, ["user_id", "event_type"], order, day, "nth_of_type", t.events).select("event_id", "nth_of_user", "nth_of_type")


@query("f13_period_rank", "SELECT o_orderkey, dense_rank() OVER (ORDER BY date_trunc('month', o_orderdate) DESC) AS month_rank FROM orders")
def _f13(t: Tables):
    rows = t.orders.select("o_orderkey", D.month_start(col("o_orderdate").cast("date")).alias("mon"))
    return W.period_rank(rows, "mon", "month_rank").select("o_orderkey", "month_rank")


@query("f14_suffix_ids", f"SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, CAST(l_orderkey AS VARCHAR) || 'RF' || CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, {_FULL}) AS VARCHAR) AS refund_id FROM lineitem WHERE l_returnflag = 'R'")
def _f14(t: Tables):
    rows = t.lineitem.where(col("l_returnflag") == "R")
    out = W.suffix_ids(rows, "l_orderkey", [col("l_linenumber"), *_order()], col("l_linenumber"), "RF", "refund_id")
    return out.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "refund_id")


@query(
    "f15_month_presence",
    f"""WITH {_M} SELECT m.o_custkey, CAST(m.mon AS VARCHAR) AS mon, CASE WHEN p1.n IS NULL AND p2.n IS NULL THEN 'new' ELSE 'returning' END AS cohort, CASE WHEN m.n = 1 THEN 'once' ELSE 'repeat' END AS visits {_J}""",
)
def _f15(t: Tables):
    out = W.month_presence(_months(t), ["o_custkey"], "mon", "seen")
    return out.select("o_custkey", "mon", F.when(col("seen"), "returning").otherwise("new").alias("cohort"), F.when(col("n") == 1, "once").otherwise("repeat").alias("visits"))


@query(
    "f16_stable_stores",
    """WITH a AS (SELECT DISTINCT l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE) AS am FROM lineitem), c AS (SELECT DISTINCT am AS mon FROM a)
SELECT * FROM (SELECT CAST(c.mon AS VARCHAR) AS mon, a.l_suppkey, count(DISTINCT a.am) AS active_months FROM c JOIN a ON c.mon > a.am GROUP BY c.mon, a.l_suppkey) WHERE active_months >= 13""",
)
def _f16(t: Tables):
    return W.active_periods_before(t.lineitem.select("l_suppkey", col("l_shipdate").cast("date").alias("mon")), "l_suppkey", "mon", "active_months", 13)


@query(
    "f11_running_sum_by_range",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, cents, CAST(sum(cents) OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, cents ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)",
)
def _f11_range(t: Tables):
    """One total over the whole table, in ranges that follow the data."""
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", F.round(col("l_extendedprice") * 100).cast("long").alias("cents"))
    order = [col(c) for c in ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "cents")]
    return W.running_sum_by_range(rows, [], order, col("cents"), "upto", new_folder(t.spark, "running")).drop("l_shipdate")


@query(
    "f12_occurrence_in_a_hot_day",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(row_number() OVER (PARTITION BY card, day ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS BIGINT) AS nth FROM (SELECT *, CASE WHEN l_partkey % 10 = 0 THEN l_suppkey ELSE -1 END AS card, CASE WHEN l_partkey % 10 = 0 THEN CAST(l_shipdate AS DATE) ELSE DATE '2001-07-14' END AS day FROM lineitem)",
)
def _f12_hot(t: Tables):
    """Nine tenths of the rows are one card on one day."""
    usual = col("l_partkey") % 10 == 0
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(usual, col("l_suppkey")).otherwise(-1).alias("card"), F.when(usual, col("l_shipdate").cast("date")).otherwise(F.lit(dt.date(2001, 7, 14))).alias("day"),
    )
    order = [col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    return W.running_sum_by_range(rows, ["card", "day"], order, F.lit(1).cast("long"), "nth", new_folder(t.spark, "running")).drop("card", "day")
