"""Checked chargeback and e-commerce pipelines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.plans import chargebacks as B
from ledgerloom.plans import ecom as P
from ledgerloom.workload.feeds import Tables
from ledgerloom.workload.registry import query

col = F.col

_FINAL = """CASE lower(c.status_open) WHEN 't' THEN CASE WHEN c.rr_sent_dttm_utc IS NULL AND c.response_dttm_utc IS NULL THEN 'Received into slipper not sent to store' WHEN c.rr_sent_dttm_utc IS NOT NULL AND c.response_dttm_utc IS NULL THEN 'Sent to store waiting on response'
 WHEN c.rr_sent_dttm_utc IS NULL THEN 'Waiting on Scheme' WHEN c.charged_dt IS NULL THEN 'Waiting on Scheme' ELSE 'Charged and Open' END WHEN 'f' THEN CASE WHEN c.charged_dt IS NULL THEN 'Closed and Successful' ELSE 'Closed and Unsuccessful' END END"""
_LEFT = "date_diff('day', c.file_date, CAST(c.received_dt AS DATE) + CASE WHEN upper(c.bank) IN ('VISA', 'MASTERCARD') THEN 45 ELSE {other} END)"
_LIAB = f"""CASE lower(c.status_open) WHEN 'f' THEN CASE WHEN c.charged_dt IS NOT NULL AND c.chgbk_rev_dt IS NULL THEN 'Charged Liability and Closed' ELSE 'Successfully Contested' END WHEN 't' THEN CASE WHEN c.charged_dt IS NOT NULL AND c.chgbk_rev_dt IS NULL THEN 'Charged Liability and Open'
 WHEN {_LEFT.format(other=12)} > 0 THEN 'Potential Liability - Open' WHEN (c.charged_dt IS NULL) = (c.chgbk_rev_dt IS NULL) THEN 'Potential Liability - Open' ELSE '' END ELSE ' ' END"""
_CP = "CASE WHEN upper(m.is_online) = 'ONLINE' OR upper(c.signature) = 'CNP' THEN 'CNP' ELSE 'CP' END"


@query(
    "m_chargeback_report",
    f"""SELECT c.id, c.bank_ref_no, c.store_id, CAST(c.file_date AS VARCHAR) AS processing_date, {_FINAL} AS final_status, date_diff('day', CAST(c.received_dt AS DATE), c.file_date) AS days_since_raised, {_LEFT.format(other=14)} AS days_to_close, {_LIAB} AS chargeback_status, {_CP} AS cp_indicator, m.site_name, m.division, m.company
FROM chargebacks c JOIN store m ON m.store_id = c.store_id""",
)
def _report(t: Tables):
    return B.report(t.chargebacks, t.store)


@query("m_chargeback_portal_copy", f"SELECT c.id, c.bank_ref_no, c.store_id, m.division, {_FINAL} AS final_status FROM chargebacks c JOIN store m ON m.store_id = c.store_id")
def _portal(t: Tables):
    return B.report(t.chargebacks, t.store).select("id", "bank_ref_no", "store_id", "division", "final_status")


@query(
    "m_chargeback_detail",
    f"""WITH cur AS (SELECT * FROM chargebacks WHERE id % 3 <> 0 QUALIFY row_number() OVER (PARTITION BY bank_ref_no ORDER BY file_date DESC, id DESC) = 1),
old AS (SELECT * REPLACE (nullif(bank_ref_no, 'NULL') AS bank_ref_no) FROM chargebacks WHERE id % 3 = 0), old1 AS (SELECT * FROM old WHERE bank_ref_no NOT IN (SELECT bank_ref_no FROM cur) QUALIFY row_number() OVER (PARTITION BY bank_ref_no ORDER BY file_date DESC, id DESC) = 1),
c AS (SELECT * FROM (SELECT * FROM cur UNION ALL SELECT * FROM old1) WHERE received_dt >= TIMESTAMP '1996-01-01' AND received_dt < TIMESTAMP '2001-07-01'),
f AS (SELECT c.*, CAST(c.received_dt AS DATE) - CAST(dayofweek(c.received_dt) AS INT) AS ws, c.rr_sent_dttm_utc IS NOT NULL AS rq, c.response_dttm_utc IS NOT NULL AS rs, c.chgbk_challenge_dt IS NOT NULL AS ch, c.chgbk_rev_dt IS NOT NULL AS rv, c.status_open = 't' AS op FROM c)
SELECT c.id, c.bank_ref_no, strftime(c.received_dt, '%Y-%m') AS chargeback_month, CAST(ws AS VARCHAR) AS chargeback_week_start, CAST(ws + 6 AS VARCHAR) AS chargeback_week_end, CAST(strftime(ws + 6, '%U') AS BIGINT) AS week_no, if(rq, 'Y', 'N') AS request_send_flag, if(rs, 'Y', 'N') AS response_received_flag, if(ch, 'Y', 'N') AS challenged_flag, if(rv, 'Y', 'N') AS reversal_flag, if(op, 'open', 'closed') AS status_flag,
CASE WHEN NOT ch AND op AND rs THEN 'Unworked' WHEN NOT ch AND op AND rq THEN 'Merchant Response Awaited' WHEN NOT ch AND op THEN 'Request to be send to merchant' WHEN NOT ch AND rv THEN 'Withdrawn by Issuer' WHEN NOT ch THEN 'Accepted Liability (Unchallenged)'
 WHEN rs AND op AND rv THEN 'Pending-Credit Received' WHEN rs AND op THEN 'Pending-Credit Not Received' WHEN rs AND rv THEN 'Won' WHEN rs THEN 'Loss' END AS activity_stage,
CASE WHEN NOT ch AND op THEN 'Needs action' WHEN NOT ch AND NOT rv THEN 'Accepted' WHEN ch AND op THEN 'Contested - in review' WHEN ch AND rv THEN 'Contested - won' WHEN ch THEN 'Contested - lost' END AS outcome, {_FINAL} AS final_status, {_LIAB} AS chargeback_status, {_CP} AS cp_indicator, c.store_id || ' | ' || m.site_name AS store_label
FROM f c LEFT JOIN store m ON m.store_id = c.store_id""",
)
def _detail(t: Tables):
    current, history = t.chargebacks.where(col("id") % 3 != 0), t.chargebacks.where(col("id") % 3 == 0)
    return B.detail(current, history, t.store, dt.date(1996, 1, 1), dt.date(2001, 7, 1))


_LABELS = {"%000001%": "Site One", "%0000_2%": "Site Two", "%5": "Site Five"}
_FACT = """x AS (SELECT c.*, s.s_name AS store_name, CASE WHEN s.s_name LIKE '%000001%' THEN 'Site One' WHEN s.s_name LIKE '%0000_2%' THEN 'Site Two' WHEN s.s_name LIKE '%5' THEN 'Site Five' END AS merchant_id, coalesce(CAST(charged_dt AS DATE), CAST(txn_dttm_local AS DATE)) AS order_date FROM chargebacks c JOIN supplier s ON c.store_id = 'S' || lpad(CAST(s.s_suppkey AS VARCHAR), 9, '0')),
f AS (SELECT *, abs(date_diff('day', order_date, CAST(txn_dttm_local AS DATE))) AS days FROM x WHERE merchant_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY merchant_id, store_id, bank_ref_no, order_date ORDER BY txn_dttm_local, id) = 1)"""


def _fact(t: Tables):
    names = t.supplier.select(F.concat(F.lit("S"), F.lpad(col("s_suppkey").cast("string"), 9, "0")).alias("store_id"), col("s_name").alias("store_name"))
    source = t.chargebacks.join(names, "store_id")
    keys = ["merchant_id", "store_id", "bank_ref_no", "order_date"]
    existing = t.chargebacks.where(col("id") % 10 == 0).select(F.lit("Site Five").alias("merchant_id"), "store_id", "bank_ref_no", F.coalesce(col("charged_dt").cast("date"), col("txn_dttm_local").cast("date")).alias("order_date"))
    return B.fact(source, existing, _LABELS, keys, dt.date(2001, 7, 15))


_NEW = "(SELECT * FROM f WHERE NOT EXISTS (SELECT 1 FROM x e WHERE e.id % 10 = 0 AND f.merchant_id = 'Site Five' AND e.store_id = f.store_id AND e.bank_ref_no = f.bank_ref_no AND e.order_date = f.order_date))"


@query("m_ecom_chargeback_fact", f"WITH {_FACT} SELECT id, merchant_id, store_id, bank_ref_no, CAST(order_date AS VARCHAR) AS order_date, days AS days_for_chargeback, '2001-07-15' AS effective_date, CAST(NULL AS VARCHAR) AS expiry_date, 1 AS is_current FROM {_NEW}")
def _ecom_fact(t: Tables):
    return _fact(t).select("id", "merchant_id", "store_id", "bank_ref_no", "order_date", "days_for_chargeback", "effective_date", "expiry_date", "is_current")


@query("m_chargeback_by_day", f"WITH {_FACT} SELECT merchant_id, CAST(order_date AS VARCHAR) AS day, count(*) AS chargebacks, CAST(sum(amount_cents) AS BIGINT) AS amount_cents, strftime(any_value(order_date), '%Y-%m') AS month FROM {_NEW} GROUP BY merchant_id, order_date")
def _by_day(t: Tables):
    return B.by_day(_fact(t))


def _orders(t: Tables):
    """Orders with two line items each, except where the feed has none or an empty list."""
    sku = lambda n: F.concat(F.lit("SKU"), (col("order_id") + n).cast("string"))
    item = lambda n, q: F.struct(sku(n).alias("ProductSKU"), F.floor(col("amount_cents") / (n + 2)).alias("Price"), F.lit(q).cast("long").alias("Quantity"))
    both = F.array(item(0, 1), item(1, 2))
    none = F.expr("cast(array() as array<struct<ProductSKU: string, Price: bigint, Quantity: bigint>>)")
    return t.ecom_order.withColumn("line_items", F.when(col("customer_id") % 17 == 0, None).when(col("customer_id") % 13 == 0, none).otherwise(both))


_ITEMS = """ord AS (SELECT * FROM ecom_order WHERE customer_id % 17 <> 0 AND customer_id % 13 <> 0), it AS (SELECT *, 'SKU' || CAST(order_id AS VARCHAR) AS sku, amount_cents // 2 AS price, 1 AS qty FROM ord UNION ALL SELECT *, 'SKU' || CAST(order_id + 1 AS VARCHAR), amount_cents // 3, 2 FROM ord),
lab AS (SELECT *, CASE WHEN merchant_id LIKE '%_1_online%' THEN 'One' WHEN merchant_id LIKE '%_2_online%' THEN 'Two' WHEN merchant_id LIKE '%_online%' THEN 'Rest' END AS merchant, CAST(order_time AS DATE) AS day FROM it)"""
_MERCHANTS = {"_1_online": "One", "_2_online": "Two", "_online": "Rest"}


def _reports(t: Tables):
    pair = lambda n, v: F.struct(F.lit(n).alias("Name"), v.cast("string").alias("Value"))
    fields = F.array(pair("Shipping Method", col("card_bin")), pair("EDR Card number", col("phone")), pair("Shipping Method", F.lit("again")))
    provider = F.array(F.struct(F.lit("Other").alias("name"), F.array(pair("Device", F.lit("x"))).alias("Field")), F.struct(F.lit("DeviceFingerprint").alias("name"), F.array(pair("Device Smart ID", col("email"))).alias("Field")))
    empty = F.expr("cast(null as array<struct<name: string, Field: array<struct<Name: string, Value: string>>>>)")
    order = F.struct(col("request_id").alias("RequestID"), col("merchant_id").alias("MerchantID"), col("line_items").alias("LineItem"))
    conversion = F.when(
        col("review_decision").isNotNull(),
        F.array(F.struct(col("request_id").alias("RequestID"), col("review_decision").alias("NewDecision"), F.concat(F.lit("'rev"), (col("customer_id") % 20).cast("string"), F.lit("'")).alias("Reviewer"), col("order_time").alias("ConversionDate"))),
    )
    report = F.struct(
        F.concat(F.lit("ORG"), (col("order_id") % 3).cast("string")).alias("OrganizationID"),
        col("merchant_id").alias("MerchantID"),
        F.struct(order.alias("Order"), F.struct(fields.alias("Field")).alias("MerchantDefinedData"), F.struct(F.when(col("order_id") % 4 == 0, empty).otherwise(provider).alias("Provider")).alias("Providers")).alias("Transaction"),
        conversion.alias("Conversion"),
    )
    return _orders(t).select(col("order_time").cast("date").alias("file_date"), report.alias("Report"))


@query(
    "m_flatten_decision_report",
    """WITH r AS (SELECT *, 'ORG' || CAST(order_id % 3 AS VARCHAR) AS org, CAST(order_time AS DATE) AS d FROM ecom_order), h AS (SELECT org, max(d) AS m FROM r WHERE d < DATE '1998-01-01' AND org <> 'ORG2' GROUP BY 1)
SELECT CAST(r.d AS VARCHAR) AS file_date, r.org AS organization_id, r.request_id, r.merchant_id, CASE WHEN r.customer_id % 17 = 0 THEN NULL WHEN r.customer_id % 13 = 0 THEN 0 ELSE 2 END AS items, r.card_bin AS shipping_method, CAST(NULL AS VARCHAR) AS gift_bag, r.phone AS edr_card, CASE WHEN r.order_id % 4 <> 0 THEN r.email END AS smart_id
FROM r LEFT JOIN h ON h.org = r.org WHERE h.m IS NULL OR r.d > h.m""",
)
def _flatten(t: Tables):
    reports = _reports(t)
    target = reports.select("file_date", col("Report.OrganizationID").alias("organization_id")).where((col("file_date") < "1998-01-01") & (col("organization_id") != "ORG2"))
    new = P.new_reports(reports, target, "Report.OrganizationID")
    flat = P.flatten_decisions(new, {"shipping_method": "Shipping Method", "gift_bag": "Gift bag order"}, {"edr_card": "EDR Card%"}, "DeviceFingerprint", {"smart_id": "Device Smart ID"})
    return flat.withColumn("items", F.when(col("line_items").isNotNull(), F.size("line_items"))).drop("line_items")


@query(
    "m_flatten_conversion_report",
    """SELECT CAST(CAST(order_time AS DATE) AS VARCHAR) AS file_date, merchant_id, CASE WHEN review_decision IS NOT NULL THEN request_id END AS RequestID, review_decision AS NewDecision, CASE WHEN review_decision IS NOT NULL THEN '''rev' || CAST(customer_id % 20 AS VARCHAR) || '''' END AS Reviewer,
 CASE WHEN review_decision IS NOT NULL THEN CAST(order_time AS VARCHAR) END AS ConversionDate FROM ecom_order""",
)
def _conversions(t: Tables):
    return P.flatten_conversions(_reports(t))


@query(
    "m_ecom_completeness",
    f"""WITH {_ITEMS}, c AS (SELECT merchant, day, count(*) AS total_orders, count(customer_id) AS total_customers, count(DISTINCT customer_id) AS unique_customers, count(DISTINCT sku) AS unique_products, count(sku) AS total_products, CAST(sum(price * qty) AS BIGINT) AS total_price FROM lab GROUP BY ALL)
SELECT * REPLACE (CAST(day AS VARCHAR) AS day), CAST(lag(day) OVER w AS VARCHAR) AS previous_day, date_diff('day', lag(day) OVER w, day) - 1 AS gap_days FROM c WINDOW w AS (PARTITION BY merchant ORDER BY day)""",
)
def _completeness(t: Tables):
    return P.completeness(_orders(t), _MERCHANTS)


_ART = "art AS (SELECT DISTINCT 'SKU' || CAST(p_partkey AS VARCHAR) AS sku, nullif(p_type, 'SMALL') AS category FROM part)"


def _articles(t: Tables):
    return t.part.select(F.concat(F.lit("SKU"), col("p_partkey").cast("string")).alias("sku"), F.nullif("p_type", F.lit("SMALL")).alias("category"))


_LINES = """SELECT l.request_id, l.merchant, CAST(l.day AS VARCHAR) AS order_date, coalesce(a.category, 'No Product Category') AS category, l.sku, CAST(sum(l.price) AS BIGINT) AS price, CAST(sum(l.qty) AS BIGINT) AS quantity, CAST(sum(l.price * l.qty) AS BIGINT) AS total_price FROM lab l LEFT JOIN art a ON a.sku = l.sku {where} GROUP BY ALL"""


@query("m_line_items_by_category", f"WITH {_ITEMS}, {_ART} {_LINES.format(where='WHERE l.order_time >= TIMESTAMP ' + chr(39) + '1999-06-15' + chr(39))}")
def _line_items(t: Tables):
    return P.line_items(_orders(t), _articles(t), _MERCHANTS, since=dt.date(1999, 6, 15))


def _order_cb(t: Tables):
    """Chargebacks keyed by order."""
    return t.chargebacks.withColumn("order_id", col("id"))


_CBS = "cb AS (SELECT id AS order_id, min(received_dt) AS received, any_value(amount_cents) AS cents FROM chargebacks GROUP BY 1)"


@query("m_chargeback_orders", f"WITH {_CBS} SELECT o.request_id, o.merchant_id, o.amount_cents, CAST(cb.received AS VARCHAR) AS chargeback_received, cb.cents AS chargeback_cents FROM ecom_order o JOIN cb ON cb.order_id = o.order_id")
def _cb_orders(t: Tables):
    return P.order_chargebacks(t.ecom_order, _order_cb(t)).select("request_id", "merchant_id", "amount_cents", "chargeback_received", "chargeback_cents")


@query("m_chargeback_line_items", f"WITH {_ITEMS}, {_ART}, {_CBS} {_LINES.format(where='WHERE l.order_id IN (SELECT order_id FROM cb)')}")
def _cb_lines(t: Tables):
    hits = P.order_chargebacks(t.ecom_order, _order_cb(t)).select("request_id")
    return P.line_items(_orders(t), _articles(t), _MERCHANTS, only=hits)


@query(
    "m_order_fact",
    """WITH rv AS (SELECT 'REV' || CAST(c_custkey % 20 AS VARCHAR) AS k, c_name AS name, CASE c_custkey % 4 WHEN 0 THEN '-' WHEN 1 THEN '' ELSE c_mktsegment END AS shift FROM customer), r1 AS (SELECT * FROM rv QUALIFY row_number() OVER (PARTITION BY k ORDER BY shift DESC, name) = 1),
cv AS (SELECT request_id, CASE WHEN order_id % 2 = 0 THEN 'ACCEPT' ELSE 'REJECT' END AS new_decision, 'rev' || CAST(customer_id % 25 AS VARCHAR) AS reviewer_id FROM ecom_order WHERE order_id % 3 = 0),
x AS (SELECT o.*, cv.new_decision, cv.reviewer_id, r1.name, r1.shift, timezone('Australia/Sydney', timezone('UTC', o.order_time)) AS lt, round(acos(greatest(-1, least(1, sin(radians(o.latitude)) * sin(radians(s.latitude)) + cos(radians(o.latitude)) * cos(radians(s.latitude)) * cos(radians(s.longitude) - radians(o.longitude))))) * 6371.0, 3) AS km
 FROM ecom_order o LEFT JOIN cv ON cv.request_id = o.request_id LEFT JOIN r1 ON r1.k = upper(cv.reviewer_id) LEFT JOIN store s ON s.store_id = o.store_id)
SELECT request_id, merchant_id, CAST(CAST(lt AS DATE) AS VARCHAR) AS order_date, CAST(CAST(date_trunc('month', lt) AS DATE) AS VARCHAR) AS order_month, hour(lt) AS order_hour, decision, coalesce(review_decision, new_decision) AS review_decision, coalesce(name, reviewer_id, 'NA') AS reviewer, coalesce(nullif(nullif(shift, '-'), ''), 'Unknown') AS shift,
 CASE WHEN hour(lt) > 19 OR hour(lt) < 9 THEN 1 ELSE 0 END AS after_hours, km AS distance_km, CASE WHEN km IS NULL THEN 'NA' WHEN km < 10 THEN '<10' WHEN km < 50 THEN '10-50' WHEN km < 100 THEN '50-100' ELSE '>=100' END AS distance_band, lower(split_part(email, '@', 2)) AS email_domain, card_bin, amount_cents FROM x""",
)
def _order_fact(t: Tables):
    conv = t.ecom_order.where(col("order_id") % 3 == 0).select(
        "request_id", F.when(col("order_id") % 2 == 0, "ACCEPT").otherwise("REJECT").alias("new_decision"), col("order_time").alias("conversion_time"), F.concat(F.lit("rev"), (col("customer_id") % 25).cast("string")).alias("reviewer_id")
    )
    shift = F.when(col("c_custkey") % 4 == 0, "-").when(col("c_custkey") % 4 == 1, "").otherwise(col("c_mktsegment"))
    people = t.customer.select(F.concat(F.lit("'rev"), (col("c_custkey") % 20).cast("string"), F.lit("'")).alias("reviewer_key"), col("c_name").alias("name"), shift.alias("shift"))
    return P.order_fact(t.ecom_order, conv, people, t.store)


def _profile_sql(partition: str) -> str:
    attrs = ["address", "email", "phone"]
    first = ", ".join(f"row_number() OVER (PARTITION BY customer_id, {a} ORDER BY order_time, request_id) AS {a}_no" for a in attrs)
    seen = ", ".join(f"sum(CASE WHEN {a}_no = 1 THEN 1 ELSE 0 END) OVER ({partition} ROWS UNBOUNDED PRECEDING) AS {a}_seen" for a in attrs)
    tot = ", ".join(f"count(DISTINCT {a}) AS total_{a}" for a in attrs)
    ok = {a: f"CASE WHEN NOT ({a}_seen > 1 AND {a}_no < 3) OR order_no = {a}_no THEN 1 ELSE 0 END" for a in attrs}
    outs = ", ".join(f"{a}_no, total_{a}, CASE WHEN {a}_no = 1 THEN 1 ELSE 0 END AS is_new_{a}, {ok[a]} AS is_{a}_consistent" for a in attrs)
    every = " AND ".join(f"({ok[a]}) = 1" for a in attrs)
    return f"""WITH a AS (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY order_time, request_id) AS order_no, {first} FROM ecom_order), b AS (SELECT *, {seen} FROM a), t AS (SELECT customer_id, count(*) AS total_orders, {tot} FROM ecom_order GROUP BY 1)
SELECT b.customer_id, b.request_id, order_no, total_orders, CASE WHEN total_orders >= 3 THEN 1 ELSE 0 END AS is_order_consistent, {outs}, CASE WHEN total_orders >= 3 AND {every} THEN 1 ELSE 0 END AS is_customer_consistent FROM b JOIN t ON t.customer_id = b.customer_id"""


@query("m_customer_profile", _profile_sql("PARTITION BY customer_id ORDER BY order_time, request_id"))
def _profile(t: Tables):
    return P.customer_profile(t.ecom_order)


@query("m_customer_profile_running_across", _profile_sql("ORDER BY customer_id, order_time, request_id"))
def _profile_across(t: Tables):
    return P.customer_profile(t.ecom_order, across_customers=True)


def _funnel_sql(keys: list[str], where: str = "") -> str:
    k = ", ".join(keys)
    return f"""fine AS (SELECT merchant_id, card_bin, CAST(date_trunc('month', order_time) AS DATE) AS order_month, decision, review_decision, count(DISTINCT request_id) AS n, sum(amount_cents) AS c FROM ecom_order {where} GROUP BY ALL),
fun AS (SELECT {k}, CAST(sum(n) AS BIGINT) AS total_transactions, CAST(sum(c) AS BIGINT) AS total_cents, CAST(sum(CASE WHEN decision = 'ACCEPT' THEN n ELSE 0 END) AS BIGINT) AS systems_accept, CAST(sum(CASE WHEN decision = 'ACCEPT' THEN c ELSE 0 END) AS BIGINT) AS systems_accept_cents,
 CAST(sum(CASE WHEN decision = 'REJECT' THEN n ELSE 0 END) AS BIGINT) AS systems_reject, CAST(sum(CASE WHEN decision = 'REJECT' THEN c ELSE 0 END) AS BIGINT) AS systems_reject_cents, CAST(sum(CASE WHEN decision = 'REVIEW' THEN n ELSE 0 END) AS BIGINT) AS review, CAST(sum(CASE WHEN review_decision = 'ACCEPT' THEN n ELSE 0 END) AS BIGINT) AS reviewer_accept,
 CAST(sum(CASE WHEN review_decision = 'REJECT' THEN n ELSE 0 END) AS BIGINT) AS reviewer_reject, CAST(sum(CASE WHEN review_decision = 'REJECT' THEN c ELSE 0 END) + sum(CASE WHEN decision = 'REJECT' THEN c ELSE 0 END) AS BIGINT) AS prevented_cents FROM fine GROUP BY {k})"""


@query(
    "m_fraud_insight",
    f"WITH {_funnel_sql(['merchant_id', 'order_month'], 'WHERE date_trunc(' + chr(39) + 'month' + chr(39) + ', order_time) >= (SELECT date_trunc(' + chr(39) + 'month' + chr(39) + ', max(order_time)) - INTERVAL 25 MONTH FROM ecom_order)')} SELECT * REPLACE (CAST(order_month AS VARCHAR) AS order_month) FROM fun",
)
def _insight(t: Tables):
    return P.insight(t.ecom_order, ["merchant_id", "order_month"], 25)


_COUNTS = ["total_transactions", "total_cents", "systems_accept", "systems_accept_cents", "systems_reject", "systems_reject_cents", "review", "reviewer_accept", "reviewer_reject", "prevented_cents"]


@query(
    "m_fraud_oversight",
    f"""WITH {_funnel_sql(['merchant_id', 'card_bin', 'order_month'], 'WHERE date_trunc(' + chr(39) + 'month' + chr(39) + ', order_time) >= (SELECT date_trunc(' + chr(39) + 'month' + chr(39) + ', max(order_time)) - INTERVAL 49 MONTH FROM ecom_order)')}, {_CBS},
b AS (SELECT o.merchant_id, o.card_bin, CAST(date_trunc('month', o.order_time) AS DATE) AS order_month, count(*) AS n, sum(cb.cents) AS c FROM ecom_order o JOIN cb ON cb.order_id = o.order_id GROUP BY ALL)
SELECT coalesce(fun.merchant_id, b.merchant_id) AS merchant_id, coalesce(fun.card_bin, b.card_bin) AS card_bin, CAST(coalesce(fun.order_month, b.order_month) AS VARCHAR) AS order_month, {", ".join(f"coalesce({c}, 0) AS {c}" for c in _COUNTS)}, CAST(coalesce(b.n, 0) AS BIGINT) AS chargebacks, CAST(coalesce(b.c, 0) AS BIGINT) AS chargeback_cents FROM fun FULL JOIN b ON b.merchant_id = fun.merchant_id AND b.card_bin = fun.card_bin AND b.order_month = fun.order_month""",
)
def _oversight(t: Tables):
    return P.oversight(t.ecom_order, _order_cb(t))
