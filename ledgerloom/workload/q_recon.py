"""Checked reconciliation operators (I-01..I-10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import control as O
from ledgerloom.operators import joins as J
from ledgerloom.operators import recon as Q
from ledgerloom.workload.feeds import Tables
from ledgerloom.workload.registry import query

col = F.col
_ORD = "o AS (SELECT o_orderkey AS k, CAST(round(o_totalprice * 100) AS BIGINT) AS order_cents FROM orders WHERE o_orderstatus <> 'P')"
_LIN = "l AS (SELECT l_orderkey AS k, CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS line_cents FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1)"


def _sides(t: Tables):
    o = t.orders.where(col("o_orderstatus") != "P").select(col("o_orderkey").alias("k"), F.round(col("o_totalprice") * 100).cast("long").alias("order_cents"))
    lines = t.lineitem.where(col("l_returnflag") != "N").withColumn("k", col("l_orderkey"))
    return o, Q.totals(lines, ["k"], {"line_cents": F.sum(F.round(col("l_extendedprice") * 100).cast("long"))})


@query(
    "i01_reconcile_missing",
    f"WITH {_ORD}, {_LIN} SELECT coalesce(o.k, l.k) AS k, order_cents, line_cents, CASE WHEN o.k IS NULL THEN 'Missing in orders' WHEN l.k IS NULL THEN 'Missing in lines' ELSE 'Not Missing' END AS flag FROM o FULL JOIN l ON o.k = l.k",
)
def _i01(t: Tables):
    o, lines = _sides(t)
    return Q.reconcile(o, lines, ["k"], "orders", "lines")


@query(
    "i02_match_amount",
    f"WITH {_ORD}, {_LIN} SELECT o.k, order_cents, line_cents, CASE WHEN abs(coalesce(order_cents, 0) - coalesce(line_cents, 0)) <= 10000000 THEN 'Matched' ELSE 'Mismatched' END AS close, CASE WHEN coalesce(order_cents, 0) = coalesce(line_cents, 0) THEN 'Matched' ELSE 'Mismatched' END AS exact FROM o LEFT JOIN l ON o.k = l.k",
)
def _i02(t: Tables):
    o, lines = _sides(t)
    both = o.join(lines, "k", "left")
    a, b = col("order_cents"), col("line_cents")
    return both.select("k", a, b, Q.match_flag(a, b, 10000000).alias("close"), Q.match_flag(a, b).alias("exact"))


@query(
    "i03_three_way_chain",
    """WITH a AS (SELECT o_orderkey AS k, count(*) AS n_orders FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT l_orderkey AS k, count(*) AS n_lines FROM lineitem WHERE l_returnflag = 'A' GROUP BY 1),
c AS (SELECT l_orderkey AS k, count(*) AS n_returns FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1), ab AS (SELECT coalesce(a.k, b.k) AS k, n_orders, n_lines FROM a FULL JOIN b ON a.k = b.k)
SELECT coalesce(ab.k, c.k) AS k, n_orders, n_lines, n_returns, CASE WHEN c.k IS NULL THEN 'Missing in returns' WHEN ab.k IS NULL THEN 'Missing in orders/lines' ELSE 'Not Missing' END AS flag FROM ab FULL JOIN c ON ab.k = c.k""",
)
def _i03(t: Tables):
    a = t.orders.where(col("o_orderstatus") == "F").groupBy(col("o_orderkey").alias("k")).agg(F.count("*").alias("n_orders"))
    b = t.lineitem.where(col("l_returnflag") == "A").groupBy(col("l_orderkey").alias("k")).agg(F.count("*").alias("n_lines"))
    c = t.lineitem.where(col("l_returnflag") == "R").groupBy(col("l_orderkey").alias("k")).agg(F.count("*").alias("n_returns"))
    return Q.three_way(a, b, c, "k", "returns", "orders/lines")


@query(
    "i04_store_totals_of_three",
    """WITH g AS (SELECT outlet_code AS s, sum(amount_cents) AS gift FROM gift_txn GROUP BY 1), p AS (SELECT site_number AS s, sum(tender_cents) AS pos FROM pos_tender WHERE tender_type = 'REDEEM' GROUP BY 1), q AS (SELECT site_number AS s, sum(tender_cents) AS act FROM pos_tender WHERE tender_type = 'ACTIVATE' GROUP BY 1)
SELECT g.s, CAST(gift AS BIGINT) AS gift, CAST(pos AS BIGINT) AS pos, CAST(act AS BIGINT) AS act, CAST(coalesce(pos, 0) + coalesce(act, 0) AS BIGINT) AS net FROM g LEFT JOIN p ON p.s = g.s LEFT JOIN q ON q.s = g.s""",
)
def _i04(t: Tables):
    g = Q.totals(t.gift_txn.withColumn("s", col("outlet_code")), ["s"], {"gift": F.sum("amount_cents")})
    site = t.pos_tender.withColumn("s", col("site_number"))
    # one pass for both tender kinds
    p = Q.totals(site, ["s"], {"pos": F.sum(F.when(col("tender_type") == "REDEEM", col("tender_cents"))), "act": F.sum(F.when(col("tender_type") == "ACTIVATE", col("tender_cents")))})
    return g.join(p, "s", "left").withColumn("net", F.coalesce("pos", F.lit(0)) + F.coalesce("act", F.lit(0)))


@query("i05_duplicate_key_report", "SELECT bank_ref_no, count(*) AS copies FROM chargebacks GROUP BY 1 HAVING count(*) > 1")
def _i05(t: Tables):
    return Q.duplicate_keys(t.chargebacks, ["bank_ref_no"])


@query(
    "i07_missing_reference",
    """WITH n AS (SELECT tran_uid, count(*) AS copies FROM settlement_std GROUP BY 1)
SELECT * FROM (SELECT s.tran_uid, s.settlement_cents, CASE WHEN d.site_name IS NULL THEN 'Store not found in store details' WHEN m.active_flag IS NULL THEN 'Store has no customer mapping' WHEN m.active_flag = 'N' THEN 'Customer mapping is inactive'
 WHEN coalesce(trim(m.company_code), '') = '' THEN 'Company code is blank' WHEN n.copies > 1 THEN 'Duplicate transaction' END AS message
 FROM settlement_std s LEFT JOIN store d ON d.store_id = s.store_id LEFT JOIN sap_map m ON m.store_number = s.store_id JOIN n ON n.tran_uid = s.tran_uid) WHERE message IS NOT NULL""",
)
def _i07(t: Tables):
    rows = J.lookup(t.settlement_std, t.store, {"store_id": "store_id"}, ["site_name"])
    rows = J.lookup(rows, t.sap_map, {"store_number": "store_id"}, {"active_flag": "map_active", "company_code": "company_code"})
    copies = t.settlement_std.groupBy("tran_uid").agg(F.count("*").alias("copies"))
    return Q.missing_reference(rows.join(copies, "tran_uid"), O.missing_store_checks()).select("tran_uid", "settlement_cents", "message")


@query(
    "i09_completeness",
    """WITH d AS (SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY ALL)
SELECT event_type, CAST(day AS VARCHAR) AS day, n, users, CAST(lag(day) OVER w AS VARCHAR) AS previous_day, date_diff('day', lag(day) OVER w, day) - 1 AS gap_days FROM d WINDOW w AS (PARTITION BY event_type ORDER BY day)""",
)
def _i09(t: Tables):
    rows = t.events.withColumn("day", col("ts").cast("date"))
    return Q.completeness(rows, ["event_type"], "day", {"n": F.count("*"), "users": F.countDistinct("user_id")})


@query(
    "i10_load_reconciliation",
    """WITH spine AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS file_date FROM (SELECT min(CAST(l_shipdate AS DATE)) AS a, max(CAST(l_shipdate AS DATE)) AS b FROM lineitem)),
l AS (SELECT 'lines' AS table_name, CAST(l_shipdate AS DATE) AS file_date, l_returnflag AS file_name, count(*) AS r FROM lineitem GROUP BY ALL UNION ALL SELECT 'orders', CAST(o_orderdate AS DATE), o_orderstatus, count(*) FROM orders GROUP BY ALL)
SELECT n.table_name, CAST(s.file_date AS VARCHAR) AS file_date, count(l.file_name) AS files, CAST(coalesce(sum(l.r), 0) AS BIGINT) AS rows FROM spine s CROSS JOIN (SELECT 'lines' AS table_name UNION ALL SELECT 'orders') n
 LEFT JOIN l ON l.table_name = n.table_name AND l.file_date = s.file_date GROUP BY n.table_name, s.file_date""",
)
def _i10(t: Tables):
    lines = t.lineitem.select(col("l_shipdate").cast("date").alias("file_date"), col("l_returnflag").alias("file_name"))
    orders = t.orders.select(col("o_orderdate").cast("date").alias("file_date"), col("o_orderstatus").alias("file_name"))
    span = lines.agg(F.min("file_date").alias("a"), F.max("file_date").alias("b"))
    spine = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 day"))).alias("file_date"))
    return Q.load_reconciliation({"lines": lines, "orders": orders}, spine)
