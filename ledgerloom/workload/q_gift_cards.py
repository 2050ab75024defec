"""Checked gift-card tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.plans import gift_cards as G
from ledgerloom.sources.tables import local_table
from ledgerloom.workload.feeds import CALENDAR_SQL, Tables
from ledgerloom.workload.registry import query

col = F.col

_OUTLETS = {"MERCH0": "Markets", "MERCH1": "Cellars", "MERCH2": "Cellars", "MERCH3": "Fuel", "MERCH4": "Wide"}
_COMPANIES = {"C0": "Markets", "C1": "Cellars", "C2": "Fuel"}
_KNOWN = ["Markets", "Cellars", "Fuel", "House"]
_LEVELS = {"Markets": 0.01, "Cellars": 0.02, "Fuel": 0.015, "House": 0.005, "Any": 0.0025}

_OUTLET_SQL = "CASE {c} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _OUTLETS.items()) + " ELSE 'House' END"
_COMPANY_SQL = "CASE WHEN c.company IS NULL THEN 'House' ELSE CASE c.company " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _COMPANIES.items()) + " ELSE 'Any' END END"
_KNOWN_SQL = "CASE WHEN {c} IN (" + ", ".join(f"'{k}'" for k in _KNOWN) + ") THEN {c} ELSE 'Any' END"
_RATES_SQL = "rt(outlet, rate) AS (VALUES " + ", ".join(f"('{k}', {v}::DOUBLE)" for k, v in _LEVELS.items()) + ")"
_SALES_SQL = f"""cd AS MATERIALIZED (SELECT card_number, merchant, amount_cents, notes, invoice_number, activation_location, program_group, design_code, max(transaction_date) AS activation_date FROM gift_events WHERE transaction_type IN ('GIFT CARD ACTIVATE', 'GIFT CARD REISSUE') GROUP BY ALL),
ho AS (SELECT order_no, payment_method, order_date, b2b_unit, user_type, customer_id, sales_application, CAST(CAST(sum(discount_cents) * 20 + sum(cards) AS BIGINT) // CAST(sum(cards) * 2 AS BIGINT) AS DOUBLE) / 1000 AS card_discount FROM card_orders GROUP BY ALL),
pd AS (SELECT invoice_number, CAST(sum(discount_cents) AS DOUBLE) / 100 AS d FROM partner_txn GROUP BY 1),
sa AS MATERIALIZED (SELECT cd.card_number, {_OUTLET_SQL.format(c='cd.merchant')} AS sales_outlet, cd.activation_date, cd.amount_cents AS face_cents, coalesce(CASE WHEN cd.activation_location = 'SAP Hybris' THEN ho.b2b_unit ELSE cd.merchant END, 'D2C') AS sales_merchant, cd.activation_location, cd.program_group, cd.design_code,
 ho.order_no, ho.payment_method, ho.order_date, ho.user_type, ho.customer_id, ho.sales_application, coalesce(ho.card_discount, 0) - coalesce(pd.d, 0) AS card_discount FROM cd LEFT JOIN ho ON ho.order_no = substr(cd.notes, 9, 8) LEFT JOIN pd ON pd.invoice_number = cd.invoice_number)"""
_DETAIL_SQL = f"""{_SALES_SQL}, {CALENDAR_SQL.replace('cd AS', 'cday AS').replace('FROM cd)', 'FROM cday)')}, {_RATES_SQL},
ns AS (SELECT * FROM sa QUALIFY row_number() OVER (PARTITION BY card_number ORDER BY activation_date DESC NULLS LAST, sales_merchant NULLS FIRST, face_cents NULLS FIRST, order_no NULLS FIRST, activation_location NULLS FIRST, design_code NULLS FIRST, card_discount NULLS FIRST) = 1),
e1 AS MATERIALIZED (SELECT e.*, ns.sales_merchant, ns.activation_date, ns.face_cents, ns.card_discount, coalesce(ns.sales_outlet, {_COMPANY_SQL}) AS sales_outlet, {_OUTLET_SQL.format(c='e.merchant')} AS redemption_outlet, y.pofy AS retail_month, y.wofy AS retail_week, CAST(date_trunc('month', e.transaction_date) AS DATE) AS month,
 CASE e.transaction_type WHEN 'GIFT CARD ACTIVATE' THEN 1 WHEN 'GIFT CARD CANCEL ACTIVATE' THEN -1 END AS net_sales_count,
 CASE e.transaction_type WHEN 'GIFT CARD ACTIVATE' THEN coalesce(e.amount_cents, 100000) + coalesce(adjustment_cents, 0) WHEN 'GIFT CARD REISSUE' THEN coalesce(balance_cents, 0) WHEN 'GIFT CARD CANCEL ACTIVATE' THEN coalesce(e.amount_cents, -100000) + coalesce(adjustment_cents, 0) END AS net_sales_cents,
 CASE e.transaction_type WHEN 'GIFT CARD REDEEM' THEN 1 WHEN 'GIFT CARD RELOAD' THEN 1 WHEN 'GIFT CARD CANCEL REDEEM' THEN -1 END AS net_redemptions_count,
 -CASE e.transaction_type WHEN 'GIFT CARD REDEEM' THEN coalesce(e.amount_cents, -100000) WHEN 'GIFT CARD RELOAD' THEN coalesce(e.amount_cents, 100000) WHEN 'GIFT CARD CANCEL REDEEM' THEN coalesce(e.amount_cents, 100000) END AS net_redemptions_cents
 FROM gift_events e LEFT JOIN ns ON ns.card_number = e.card_number LEFT JOIN store c ON c.store_id = e.activation_store LEFT JOIN calendar y ON y.calendar_date = e.transaction_date),
rk AS (SELECT month, row_number() OVER (ORDER BY month DESC) AS r FROM (SELECT DISTINCT month FROM e1)),
dt AS MATERIALIZED (SELECT e1.*, (CAST(net_redemptions_cents AS DOUBLE) / 100) * a.rate AS sales_commission, (CAST(net_redemptions_cents AS DOUBLE) / 100) * b.rate AS redemption_commission, CASE WHEN rk.r <= 1 THEN 'Y' END AS latest_month_flag, CASE WHEN rk.r <= 12 THEN 'Y' END AS last_12_months_flag
 FROM e1 LEFT JOIN rk ON rk.month = e1.month LEFT JOIN rt a ON a.outlet = {_KNOWN_SQL.format(c='e1.sales_outlet')} LEFT JOIN rt b ON b.outlet = {_KNOWN_SQL.format(c='e1.redemption_outlet')})"""


def _sales(t: Tables):
    return G.sales_orders(t.gift_events, t.card_orders, t.partner_txn, _OUTLETS, "House")


def _detail(t: Tables):
    pairs = [(a, b, x, y) for a, x in _LEVELS.items() for b, y in _LEVELS.items()]
    rates = local_table(t.spark, "sales string, redemption string, sales_rate double, redemption_rate double", pairs)
    return G.detail(t.gift_events, _sales(t), t.store, rates, t.calendar, _OUTLETS, _COMPANIES, _KNOWN, "House")


@query(
    "m_gift_sales_orders",
    f"WITH {_SALES_SQL} SELECT * REPLACE (CAST(activation_date AS VARCHAR) AS activation_date, CAST(order_date AS VARCHAR) AS order_date, CAST(card_discount AS DOUBLE) AS card_discount) FROM sa",
)
def _gift_sales(t: Tables):
    return _sales(t)


@query(
    "m_gift_card_states",
    """WITH s AS (SELECT *, CASE transaction_type WHEN 'GIFT CARD ACTIVATE' THEN 1 WHEN 'GIFT CARD CANCEL ACTIVATE' THEN -1 ELSE 0 END AS nc,
 CASE transaction_type WHEN 'GIFT CARD ACTIVATE' THEN coalesce(amount_cents, 100000) + coalesce(adjustment_cents, 0) WHEN 'GIFT CARD REISSUE' THEN coalesce(balance_cents, 0) WHEN 'GIFT CARD CANCEL ACTIVATE' THEN coalesce(amount_cents, -100000) + coalesce(adjustment_cents, 0) ELSE 0 END AS sc,
 CASE transaction_type WHEN 'GIFT CARD REDEEM' THEN 1 WHEN 'GIFT CARD RELOAD' THEN 1 WHEN 'GIFT CARD CANCEL REDEEM' THEN -1 ELSE 0 END AS rc,
 CASE transaction_type WHEN 'GIFT CARD REDEEM' THEN -coalesce(amount_cents, -100000) WHEN 'GIFT CARD RELOAD' THEN -coalesce(amount_cents, 100000) WHEN 'GIFT CARD CANCEL REDEEM' THEN -coalesce(amount_cents, 100000) ELSE 0 END AS cc FROM gift_events),
l AS (SELECT card_number, transaction_type, transaction_date FROM gift_events WHERE transaction_type IN ('GIFT CARD ACTIVATE', 'GIFT CARD REISSUE', 'GIFT CARD CANCEL ACTIVATE') QUALIFY row_number() OVER (PARTITION BY card_number ORDER BY transaction_date DESC, event_no DESC, transaction_type DESC) = 1),
g AS (SELECT card_number, sum(nc) AS net_sales, sum(sc) AS sold_cents, sum(rc) AS net_redemptions, sum(cc) AS redeemed_cents, count(*) FILTER (transaction_type = 'GIFT CARD REISSUE') AS reissues FROM s GROUP BY 1)
SELECT g.card_number, CASE WHEN l.transaction_type IS NULL THEN 'UNSOLD' WHEN l.transaction_type = 'GIFT CARD CANCEL ACTIVATE' THEN 'CANCELLED' WHEN redeemed_cents >= sold_cents THEN 'SPENT' WHEN l.transaction_type = 'GIFT CARD REISSUE' THEN 'REISSUED' ELSE 'ACTIVE' END AS state,
 CAST(l.transaction_date AS VARCHAR) AS last_sale_date, CAST(net_sales AS BIGINT) AS net_sales, CAST(sold_cents AS BIGINT) AS sold_cents, CAST(net_redemptions AS BIGINT) AS net_redemptions, CAST(redeemed_cents AS BIGINT) AS redeemed_cents, reissues FROM g LEFT JOIN l ON l.card_number = g.card_number""",
)
def _gift_states(t: Tables):
    return G.card_states(t.gift_events)


_SHOWN = ["card_number", "transaction_type", "event_no", "sales_merchant", "sales_outlet", "redemption_outlet", "retail_month", "retail_week", "net_sales_count", "net_sales_cents", "net_redemptions_count", "net_redemptions_cents", "sales_commission", "redemption_commission", "latest_month_flag", "last_12_months_flag"]


@query("m_gift_detail", f"WITH {_DETAIL_SQL} SELECT {', '.join(_SHOWN)}, CAST(activation_date AS VARCHAR) AS activation_date, CAST(card_discount AS DOUBLE) AS card_discount FROM dt")
def _gift_detail(t: Tables):
    return _detail(t).select(*_SHOWN, "activation_date", "card_discount")


_BY = "month, sales_outlet, redemption_outlet, program_group, latest_month_flag, last_12_months_flag"
_USED = "transaction_type IN ('GIFT CARD REDEEM', 'GIFT CARD CANCEL REDEEM', 'GIFT CARD RELOAD')"


def _scenario(name: str, merchant: str, amount: str, where: str) -> str:
    return f"SELECT '{name}' AS scenario, {merchant} AS merchant, CAST(round(sum({amount}), 6) AS DOUBLE) AS net_commission, {_BY}, CAST(sum(net_redemptions_count) AS BIGINT) AS net_redemptions_count, CAST(sum(net_redemptions_cents) AS BIGINT) AS net_redemptions_cents FROM dt WHERE {_USED} AND {where} GROUP BY {_BY}"


@query(
    "m_gift_commissions",
    f"WITH {_DETAIL_SQL}, u AS ("
    + " UNION ALL ".join(
        [_scenario("Merchant activated and redeemed", "redemption_outlet", "sales_commission + redemption_commission", "sales_outlet = redemption_outlet"),
         _scenario("Merchant activated and partner redeemed", "sales_outlet", "sales_commission", "sales_outlet <> redemption_outlet"),
         _scenario("Partner activated and merchant redeemed", "redemption_outlet", "redemption_commission", "sales_outlet <> redemption_outlet")]
    )
    + ") SELECT * REPLACE (CAST(month AS VARCHAR) AS month) FROM u",
)
def _gift_commissions(t: Tables):
    return G.commissions(_detail(t)).withColumn("net_commission", F.round("net_commission", 6))


@query(
    "m_gift_sales_summary",
    f"WITH {_DETAIL_SQL} SELECT CAST(month AS VARCHAR) AS month, sales_merchant, sales_outlet, program_group, latest_month_flag, last_12_months_flag, CAST(sum(net_sales_count) AS BIGINT) AS net_sales_count, CAST(sum(net_sales_cents) AS BIGINT) AS net_sales_cents, CAST(round(sum(card_discount), 6) AS DOUBLE) AS net_card_discount, CAST(sum(face_cents) AS BIGINT) AS net_face_cents FROM dt WHERE transaction_type IN ('GIFT CARD ACTIVATE', 'GIFT CARD REISSUE', 'GIFT CARD CANCEL ACTIVATE') GROUP BY ALL",
)
def _gift_sales_summary(t: Tables):
    return G.sales_summary(_detail(t)).withColumn("net_card_discount", F.round("net_card_discount", 6))
