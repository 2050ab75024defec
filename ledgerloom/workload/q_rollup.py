"""Checked aggregations (D-01..D-21), sorts, unions and unpivots (G-01..G-09)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import cards as K
from ledgerloom.functions import dates as D
from ledgerloom.functions import money as M
from ledgerloom.operators import recon as Q
from ledgerloom.operators import rollup as R
from ledgerloom.sinks import files as S
from ledgerloom.workload.feeds import CALENDAR_SQL, Tables
from ledgerloom.workload.registry import query

col = F.col


def cents():
    return F.round(col("l_extendedprice") * 100).cast("long")


_C = "CAST(round(l_extendedprice * 100) AS BIGINT)"


@query("d01_d02_group_sum", f"SELECT l_returnflag, l_linestatus, CAST(sum({_C}) AS BIGINT) AS cents FROM lineitem GROUP BY 1, 2")
def _d01(t: Tables):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.sum(cents()).alias("cents"))


@query("d03_d04_counts", "SELECT l_suppkey, count(*) AS n, count(nullif(l_returnflag, 'N')) AS n_flag, count(DISTINCT l_partkey) AS parts, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY 1")
def _d03(t: Tables):
    flag = F.nullif(col("l_returnflag"), F.lit("N"))
    return t.lineitem.groupBy("l_suppkey").agg(F.count("*").alias("n"), F.count(flag).alias("n_flag"), F.countDistinct("l_partkey").alias("parts"), F.countDistinct("l_orderkey").alias("orders"))


@query("d05_min_max", "SELECT o_custkey, CAST(min(o_orderdate) AS VARCHAR) AS first_order, CAST(max(o_orderdate) AS VARCHAR) AS last_order, min(o_orderpriority) AS lowest FROM orders GROUP BY 1")
def _d05(t: Tables):
    return t.orders.groupBy("o_custkey").agg(F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order"), F.min("o_orderpriority").alias("lowest"))


@query("d06_conditional_sum", f"SELECT l_suppkey, CAST(sum(CASE WHEN l_returnflag = 'R' THEN {_C} ELSE 0 END) AS BIGINT) AS returned, CAST(sum(CASE WHEN l_tax > 0.05 THEN 1 ELSE 0 END) AS BIGINT) AS taxed FROM lineitem GROUP BY 1")
def _d06(t: Tables):
    return t.lineitem.groupBy("l_suppkey").agg(R.sum_if(col("l_returnflag") == "R", cents()).alias("returned"), R.sum_if(col("l_tax") > 0.05).alias("taxed"))


@query(
    "d07_net_of_reversals",
    f"""SELECT l_suppkey, CAST(date_trunc('month', l_shipdate) AS DATE)::VARCHAR AS mon, CAST(sum(CASE WHEN l_returnflag IN ('A', 'N') THEN {_C} ELSE 0 END) - sum(CASE WHEN l_returnflag IN ('R') THEN {_C} ELSE 0 END) AS BIGINT) AS net_cents,
 CAST(sum(CASE WHEN l_returnflag IN ('A', 'N') THEN 1 ELSE 0 END) - sum(CASE WHEN l_returnflag IN ('R') THEN 1 ELSE 0 END) AS BIGINT) AS net_count FROM lineitem GROUP BY ALL""",
)
def _d07(t: Tables):
    k = col("l_returnflag")
    return t.lineitem.groupBy("l_suppkey", D.month_start(col("l_shipdate").cast("date")).alias("mon")).agg(R.net(k, ["A", "N"], ["R"], cents()).alias("net_cents"), R.net(k, ["A", "N"], ["R"]).alias("net_count"))


@query(
    "d08_distinct_then_sum",
    """SELECT o_orderpriority, CAST(sum(CASE WHEN o_orderstatus = 'F' THEN n ELSE 0 END) AS BIGINT) AS accepted, CAST(sum(CASE WHEN o_orderstatus = 'P' THEN n ELSE 0 END) AS BIGINT) AS rejected, CAST(sum(r) AS BIGINT) AS rows
 FROM (SELECT o_orderpriority, date_trunc('month', o_orderdate) AS mon, o_orderstatus, count(DISTINCT o_custkey) AS n, count(*) AS r FROM orders GROUP BY ALL) GROUP BY 1""",
)
def _d08(t: Tables):
    rows = t.orders.withColumn("mon", D.month_start(col("o_orderdate").cast("date")))
    return R.distinct_then_sum(rows, ["o_orderpriority", "mon"], ["o_orderpriority"], "o_orderstatus", "o_custkey", {"F": "accepted", "P": "rejected"})


@query(
    "d09_ratio_with_guard",
    """SELECT l_suppkey, l_linenumber, coalesce(CAST(count(*) FILTER (l_returnflag = 'R' AND l_quantity > 45) AS DOUBLE) / nullif(count(*) FILTER (l_quantity > 45), 0), 0) AS share FROM lineitem GROUP BY 1, 2""",
)
def _d09(t: Tables):
    big = col("l_quantity") > 45
    return t.lineitem.groupBy("l_suppkey", "l_linenumber").agg(M.ratio(F.count_if(big & (col("l_returnflag") == "R")), F.count_if(big)).alias("share"))


@query("d10_having", "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def _d10(t: Tables):
    return Q.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("d11_distinct", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def _d11(t: Tables):
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query("d12_distinct_after_group", f"SELECT DISTINCT l_suppkey, CAST(sum({_C}) // 100000 AS BIGINT) AS size FROM lineitem GROUP BY l_suppkey, l_returnflag")
def _d12(t: Tables):
    per = t.lineitem.groupBy("l_suppkey", "l_returnflag").agg(F.sum(cents()).alias("c"))
    return per.select("l_suppkey", F.floor(col("c") / 100000).alias("size")).distinct()


@query("d13_d14_joined_set", "SELECT user_id, string_agg(event_type, ',' ORDER BY event_type) AS kinds, count(*) AS kinds_size FROM (SELECT DISTINCT user_id, event_type FROM events) GROUP BY 1")
def _d13(t: Tables):
    return R.joined_set(t.events, ["user_id"], "event_type", "kinds")


@query("d15_global_aggregate", f"SELECT count(*) AS n, CAST(max(l_shipdate) AS VARCHAR) AS newest, CAST(sum({_C}) AS BIGINT) AS cents FROM lineitem")
def _d15(t: Tables):
    return t.lineitem.agg(F.count("*").alias("n"), F.max("l_shipdate").alias("newest"), F.sum(cents()).alias("cents"))


@query("d16_trailer_totals", f"SELECT l_suppkey, count(*) AS detail_count, CAST(sum({_C}) AS BIGINT) AS detail_total FROM lineitem GROUP BY 1")
def _d16(t: Tables):
    return S.trailer(t.lineitem, ["l_suppkey"], cents())


@query(
    "d17_two_level_high_water",
    "SELECT l_suppkey, CAST(min(m) AS VARCHAR) AS safe_until FROM (SELECT l_suppkey, l_returnflag, max(l_shipdate) AS m FROM lineitem GROUP BY ALL) GROUP BY 1",
)
def _d17(t: Tables):
    return R.two_level_high_water(t.lineitem, "l_returnflag", "l_suppkey", "l_shipdate", "safe_until")


@query("d18_days_in_month", "SELECT CAST(date_trunc('month', o_orderdate) AS DATE)::VARCHAR AS mon, max(day(last_day(CAST(o_orderdate AS DATE)))) AS days FROM orders GROUP BY 1")
def _d18(t: Tables):
    d = col("o_orderdate").cast("date")
    return t.orders.groupBy(D.month_start(d).alias("mon")).agg(F.max(D.days_in_month(d)).alias("days"))


@query(
    "d19_levels_with_all",
    """WITH f AS (SELECT r_name, n_name, o_orderpriority, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT r_name, n_name, o_orderpriority, CAST(sum(c) AS BIGINT) AS cents, count(*) AS n FROM f GROUP BY ALL UNION ALL SELECT r_name, 'All', o_orderpriority, CAST(sum(c) AS BIGINT), count(*) FROM f GROUP BY ALL
UNION ALL SELECT r_name, 'All', 'All', CAST(sum(c) AS BIGINT), count(*) FROM f GROUP BY ALL UNION ALL SELECT 'All', 'All', 'All', CAST(sum(c) AS BIGINT), count(*) FROM f""",
)
def _d19(t: Tables):
    f = t.orders.join(t.customer, col("o_custkey") == col("c_custkey")).join(t.nation, col("c_nationkey") == col("n_nationkey")).join(t.region, col("n_regionkey") == col("r_regionkey"))
    keys = ["r_name", "n_name", "o_orderpriority"]
    sets = [keys, ["r_name", "o_orderpriority"], ["r_name"], []]
    return R.levels(f, keys, sets, {"cents": F.sum(F.round(col("o_totalprice") * 100).cast("long")), "n": F.count("*")})


@query(
    "d20_timeframes",
    "\nUNION ALL ".join(
        f"SELECT '{name}' AS timeframe, CAST({start} AS VARCHAR) AS period_start, o_orderpriority, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents, count(*) AS n FROM orders GROUP BY ALL"
        for name, start in [("Day", "CAST(o_orderdate AS DATE)"), ("Week", "CAST(date_trunc('week', o_orderdate) AS DATE)"), ("Month", "CAST(date_trunc('month', o_orderdate) AS DATE)"), ("Year", "CAST(date_trunc('year', o_orderdate) AS DATE)")]
    ),
)
def _d20(t: Tables):
    rows = t.orders.withColumn("d", col("o_orderdate").cast("date"))
    return R.timeframes(rows, "d", ["o_orderpriority"], {"cents": F.sum(F.round(col("o_totalprice") * 100).cast("long")), "n": F.count("*")})


@query(
    "d20_timeframes_fiscal",
    f"WITH {CALENDAR_SQL}, o AS (SELECT o.*, c.* FROM orders o LEFT JOIN calendar c ON c.calendar_date = CAST(o_orderdate AS DATE))\n"
    + "\nUNION ALL ".join(
        f"SELECT '{name}' AS timeframe, CAST({start} AS VARCHAR) AS period_start, o_orderpriority, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS cents, count(*) AS n FROM o GROUP BY ALL"
        for name, start in [("Day", "calendar_date"), ("Week", "fw_start_date"), ("Period", "fp_start_date"), ("Year", "fy_start_date")]
    ),
)
def _d20_fiscal(t: Tables):
    rows = t.orders.withColumn("d", col("o_orderdate").cast("date"))
    sums = {"cents": F.sum(F.round(col("o_totalprice") * 100).cast("long")), "n": F.count("*")}
    return R.timeframes(rows, "d", ["o_orderpriority"], sums, ("Day", "Week", "Period", "Year"), t.calendar)


@query("h58_fiscal_calendar", f"WITH {CALENDAR_SQL} SELECT o_orderkey, wofy, pofy, CAST(fp_end_date AS VARCHAR) AS period_end, CAST(fp_end_date + 5 AS VARCHAR) AS due FROM orders LEFT JOIN calendar ON calendar_date = CAST(o_orderdate AS DATE)")
def _fiscal_calendar(t: Tables):
    rows = t.orders.join(t.calendar, col("o_orderdate").cast("date") == col("calendar_date"), "left")
    return rows.select("o_orderkey", "wofy", "pofy", col("fp_end_date").alias("period_end"), K.due_pay_date(col("fp_end_date")).alias("due"))


@query(
    "d21_edge_period",
    """SELECT CASE WHEN mon = (SELECT max(date_trunc('month', o_orderdate)) FROM orders) THEN 'Month to date' ELSE strftime(mon, '%Y-%m') END AS period, n FROM (SELECT date_trunc('month', o_orderdate) AS mon, count(*) AS n FROM orders GROUP BY 1)""",
)
def _d21(t: Tables):
    per = t.orders.groupBy(D.month_start(col("o_orderdate").cast("date")).alias("mon")).agg(F.count("*").alias("n"))
    return R.edge_period(per, "mon", "Month to date", "period", D.month_text(col("mon"))).select("period", "n")


@query("g01_order_on_write", "SELECT o_orderkey, o_orderpriority FROM orders ORDER BY o_orderpriority, o_orderkey")
def _g01(t: Tables):
    return S.for_export(t.orders.select("o_orderkey", "o_orderpriority", col("o_orderkey").alias("rank")), ["rank"], ["o_orderpriority", "rank"])


@query("g03_existence", "SELECT CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_orderstatus = 'P') THEN 'yes' ELSE 'no' END AS any_pending FROM (SELECT count(*) FROM orders)")
def _g03(t: Tables):
    one = t.orders.where(col("o_orderstatus") == "P").select("o_orderstatus").limit(1)
    return one.agg(F.when(F.count("*") > 0, "yes").otherwise("no").alias("any_pending"))


@query("g04_top_one_per_group", "SELECT o_custkey, max(o_totalprice) AS best FROM orders GROUP BY 1")
def _g04(t: Tables):
    return t.orders.groupBy("o_custkey").agg(F.max_by("o_totalprice", "o_totalprice").alias("best"))


@query(
    "g05_union_all",
    "SELECT 'order' AS src, o_orderkey AS id, CAST(NULL AS VARCHAR) AS flag, o_totalprice AS amount FROM orders UNION ALL SELECT 'line', l_orderkey, l_returnflag, l_extendedprice FROM lineitem",
)
def _g05(t: Tables):
    a = t.orders.select(F.lit("order").alias("src"), col("o_orderkey").alias("id"), col("o_totalprice").alias("amount"))
    b = t.lineitem.select(F.lit("line").alias("src"), col("l_orderkey").alias("id"), col("l_returnflag").alias("flag"), col("l_extendedprice").alias("amount"))
    return a.unionByName(b, allowMissingColumns=True)


@query("g06_union_distinct", "SELECT o_orderkey AS id FROM orders UNION SELECT l_orderkey FROM lineitem")
def _g06(t: Tables):
    return t.orders.select(col("o_orderkey").alias("id")).union(t.lineitem.select("l_orderkey")).distinct()


@query(
    "g08_lenses",
    f"""SELECT l_returnflag, lens, CAST(sum(value) AS BIGINT) AS value FROM (SELECT l_returnflag, 'Quantity' AS lens, CAST(l_quantity AS BIGINT) AS value FROM lineitem UNION ALL SELECT l_returnflag, 'Sales', {_C} FROM lineitem UNION ALL
 SELECT l_returnflag, 'Discount', CAST(round(l_discount * 100) AS BIGINT) FROM lineitem) GROUP BY ALL""",
)
def _g08(t: Tables):
    sums = t.lineitem.groupBy("l_returnflag").agg(F.sum(col("l_quantity").cast("long")).alias("q"), F.sum(cents()).alias("s"), F.sum(F.round(col("l_discount") * 100).cast("long")).alias("d"))
    return R.lenses(sums, ["l_returnflag"], "lens", "value", {"Quantity": col("q"), "Sales": col("s"), "Discount": col("d")})


@query(
    "g09_ledger_lines",
    """WITH a AS (SELECT merchant, transaction_date AS d, sum(amount_cents) AS c FROM gift_txn WHERE transaction_date IS NOT NULL GROUP BY ALL)
SELECT merchant, CAST(d AS VARCHAR) AS d, 'ACT' AS line, '204742' AS account, CAST(c AS DOUBLE) / 100 AS amount FROM a UNION ALL SELECT merchant, CAST(d AS VARCHAR), 'DIS', '699200', -(CAST(c * 3 AS DOUBLE) / 10000) FROM a""",
)
def _g09(t: Tables):
    days = t.gift_txn.where(col("transaction_date").isNotNull()).groupBy("merchant", col("transaction_date").alias("d")).agg(F.sum("amount_cents").alias("c"))
    amount = M.minor_to_major(col("c"))
    lines = [
        {"line": F.lit("ACT"), "account": F.lit("204742"), "amount": amount.cast("decimal(28,4)")},
        {"line": F.lit("DIS"), "account": F.lit("699200"), "amount": (-amount * F.lit("0.03").cast("decimal(3,2)")).cast("decimal(28,4)")},
    ]
    return R.ledger_lines(days, ["merchant", "d"], lines)
