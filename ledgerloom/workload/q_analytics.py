"""Checked analytics, identity and benchmark tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.functions import cards as K
from ledgerloom.plans import analytics as P
from ledgerloom.plans import benchmark as B
from ledgerloom.plans import identity as I
from ledgerloom.workload.feeds import CALENDAR_SQL, RUN_DATE, Tables
from ledgerloom.workload.registry import query
from ledgerloom.workload.scratch import kept

col = F.col


def _parts(t: Tables) -> int:
    """Partitions of billing rows: about 100,000 rows each, so that a task's groups stay as many when rows get more."""
    return max(int(t.spark.conf.get("spark.sql.shuffle.partitions")), 1 + t.lineitem.count() // 100_000)


def _in(kinds: list[str]) -> str:
    return "(" + ", ".join(f"'{k}'" for k in kinds) + ")"


def _net(plus: list[str], minus: list[str], value: str = "1", cond: str = "true") -> str:
    return f"CAST(sum(CASE WHEN {cond} AND kind IN {_in(plus)} THEN {value} ELSE 0 END) - sum(CASE WHEN {cond} AND kind IN {_in(minus)} THEN {value} ELSE 0 END) AS BIGINT)"


_PP, _PM, _AM, _OP, _OM = K.PURCHASE_PLUS, K.PURCHASE_MINUS, K.AMOUNT_MINUS, K.PAYOUT_PLUS, K.PAYOUT_MINUS
_BUY = P.BUY
_FRAMES = {"Day": "tran_date", "Week": "CAST(date_trunc('week', tran_date) AS DATE)", "Month": "CAST(date_trunc('month', tran_date) AS DATE)", "Year": "CAST(date_trunc('year', tran_date) AS DATE)"}
_FISCAL = _FRAMES | {"Week": "fw_start_date", "Period": "fp_start_date", "Year": "fy_start_date"}
# fiscal periods and years, each with the start of the one before it
_STARTS = "sp AS (SELECT 'Period' AS frame, fp_start_date AS s, lag(fp_start_date) OVER (ORDER BY fp_start_date) AS before FROM (SELECT DISTINCT fp_start_date FROM calendar) UNION ALL SELECT 'Year', fy_start_date, lag(fy_start_date) OVER (ORDER BY fy_start_date) FROM (SELECT DISTINCT fy_start_date FROM calendar))"
_BACK = {"Day": "INTERVAL 1 DAY", "Week": "INTERVAL 7 DAY", "Month": "INTERVAL 1 MONTH", "Year": "INTERVAL 1 YEAR"}


def _framed(frames: list[str], dims: str, sums: str, src: str, starts: dict[str, str] = _FRAMES) -> str:
    return "\nUNION ALL ".join(f"SELECT '{f}' AS timeframe, {starts[f]} AS period_start, {dims}, {sums} FROM {src} GROUP BY ALL" for f in frames)


_AUTH_SUMS = ", ".join(
    [f"{_net(_PP, _PM)} AS n", f"{_net(_PP, _PM, cond=chr(39) + 'A' + chr(39) + ' = approval')} AS na", f"{_net(_PP, _PM, cond=chr(39) + 'D' + chr(39) + ' = approval')} AS nd",
     f"{_net(_PP, _AM, 'amount_cents', chr(39) + 'A' + chr(39) + ' = approval')} AS ca", f"{_net(_PP, _AM, 'amount_cents', chr(39) + 'D' + chr(39) + ' = approval')} AS cd"]
)
_AUTH_SETS = ", ".join("(" + ", ".join(["timeframe", "period_start", *place, *lens]) + ")" for place in (["store_id"], []) for lens in P.AUTH_LENSES)
_AGAIN = ", ".join(f"CAST(sum({n}) AS BIGINT) AS {n}" for n in ("n", "na", "nd", "ca", "cd"))
# the previous period: a fiscal one by the calendar, another by the day
_FISCAL_PREV = "CASE WHEN c.timeframe IN ('Period', 'Year') THEN sp.before " + " ".join(f"WHEN c.timeframe = '{f}' THEN CAST(c.period_start - {_BACK[f]} AS DATE)" for f in ("Day", "Week", "Month")) + " END"
_WITH_PREV = "LEFT JOIN sp ON sp.frame = c.timeframe AND sp.s = c.period_start"


@query(
    "m_auth_rates",
    f"""WITH {CALENDAR_SQL}, {_STARTS},
dd AS MATERIALIZED (SELECT tran_date, store_id, scheme, declined_reason, {_AUTH_SUMS} FROM billing GROUP BY ALL), dc AS MATERIALIZED (SELECT dd.*, fw_start_date, fp_start_date, fy_start_date FROM dd LEFT JOIN calendar ON calendar_date = tran_date),
fr AS MATERIALIZED ({_framed(['Month', 'Week', 'Period', 'Year'], 'store_id, scheme, declined_reason', _AGAIN, 'dc', _FISCAL)}),
lv AS MATERIALIZED (SELECT timeframe, period_start, CASE WHEN grouping(store_id) = 1 THEN 'All' ELSE store_id END AS store_id, CASE WHEN grouping(scheme) = 1 THEN 'All' ELSE scheme END AS scheme, CASE WHEN grouping(declined_reason) = 1 THEN 'All' ELSE declined_reason END AS declined_reason, {_AGAIN} FROM fr GROUP BY GROUPING SETS ({_AUTH_SETS})),
rt AS MATERIALIZED (SELECT *, coalesce(CAST(na AS DOUBLE) / nullif(n, 0), 0) AS auth_rate FROM lv),
cprev AS MATERIALIZED (SELECT c.*, {_FISCAL_PREV} AS before FROM rt c {_WITH_PREV} WHERE c.auth_rate > 0)
SELECT c.timeframe, CAST(c.period_start AS VARCHAR) AS period_start, c.store_id, c.scheme, c.declined_reason, m.brand, m.merchant_group, c.na AS trans_count_approved, c.nd AS trans_count_declined, c.auth_rate, coalesce(CAST(c.nd AS DOUBLE) / nullif(c.n, 0), 0) AS declined_rate,
 coalesce((CAST(c.ca AS DOUBLE) / 100) / nullif(c.na, 0), 0) AS avg_value_approved, coalesce((CAST(c.cd AS DOUBLE) / 100) / nullif(c.nd, 0), 0) AS avg_value_declined, c.auth_rate - p.auth_rate AS benchmark
FROM cprev c LEFT JOIN rt p ON p.timeframe = c.timeframe AND p.period_start = c.before AND p.store_id IS NOT DISTINCT FROM c.store_id AND p.scheme IS NOT DISTINCT FROM c.scheme AND p.declined_reason IS NOT DISTINCT FROM c.declined_reason LEFT JOIN store m ON m.store_id = c.store_id""",
)
def _auth(t: Tables):
    return P.auth_rates(t.billing, t.store, ("Month", "Week", "Period", "Year"), t.calendar, parts=_parts(t))


_PAID = [k for k in _OP if k != "REDEMPTION"]
_GIVEN = [k for k in _OM if k not in ("ACTIVATION", "REDEMPTION REVERSAL")]


def _fees(ok: str) -> str:
    return f"""count(*) AS transaction_count, {_net(_OP, _OM, 'amount_cents', ok)} AS transaction_cents, {_net(_PAID, _GIVEN, 'interchange_fee', ok)} AS interchange_micros, {_net(_PAID, _GIVEN, '1', ok + ' AND interchange_fee <> 0')} AS interchange_count,
 CAST(sum(CASE WHEN kind NOT IN ('PRE-AUTH', 'PRE-AUTH REVERSAL') THEN processing_fees ELSE 0 END) AS BIGINT) AS processing_cents, count(*) FILTER (kind NOT IN ('PRE-AUTH', 'PRE-AUTH REVERSAL') AND processing_fees <> 0) AS processing_count"""


_SCT = "CASE b.scheme WHEN 'DINERS' THEN 'CREDIT' WHEN 'AMEX' THEN 'CREDIT' WHEN 'EFTPOS' THEN 'DEBIT' WHEN 'FUEL CARDS' THEN 'FUEL CARDS' WHEN 'GIFT CARDS' THEN 'GIFT CARDS' WHEN 'UPI' THEN 'CREDIT' WHEN 'MASTERCARD' THEN b.card_type WHEN 'VISA' THEN b.card_type END"
_RECENT = "SELECT b.*, m.company, m.merchant_group, m.invoice_group, m.is_online, {sct} AS scheme_card_type FROM billing b LEFT JOIN store m ON m.store_id = b.store_id WHERE b.tran_date >= (SELECT date_trunc('month', max(tran_date) - INTERVAL {n} MONTH) FROM billing)"


@query(
    "m_fee_statement",
    f"""WITH {CALENDAR_SQL}, r AS MATERIALIZED (SELECT x.* REPLACE (CASE approval WHEN 'A' THEN 'Approved' ELSE 'Declined' END AS approval), fw_start_date, fp_start_date FROM ({_RECENT.format(sct=_SCT, n=3)}) x LEFT JOIN calendar ON calendar_date = tran_date),
f AS ({_framed(['Day', 'Week', 'Month', 'Period'], 'company, merchant_group, invoice_group, kind, approval, scheme, scheme_card_type', _fees("approval = 'Approved'"), 'r', _FISCAL)}), e AS (SELECT timeframe, max(period_start) AS edge FROM f GROUP BY 1),
pe AS (SELECT DISTINCT fp_start_date AS s, fp_end_date AS last, pofy FROM calendar)
SELECT f.* REPLACE (CAST(f.period_start AS VARCHAR) AS period_start), CASE WHEN f.timeframe = 'Period' AND f.period_start = e.edge THEN 'Period to date' WHEN f.timeframe = 'Period' THEN 'P' || pe.pofy || ' ' || strftime(f.period_start, '%d %b') || ' to ' || strftime(pe.last, '%d %b') WHEN f.timeframe = 'Month' AND f.period_start = e.edge THEN 'Month to date' WHEN f.timeframe = 'Week' AND f.period_start = e.edge THEN 'Week to date' WHEN f.timeframe = 'Month' THEN strftime(f.period_start, '%Y-%m')
 WHEN f.timeframe = 'Week' THEN 'Wk- ' || strftime(f.period_start, '%d %b') || ' to ' || strftime(f.period_start + 6, '%d %b') ELSE CAST(f.period_start AS VARCHAR) END AS period FROM f JOIN e ON e.timeframe = f.timeframe LEFT JOIN pe ON f.timeframe = 'Period' AND pe.s = f.period_start""",
)
def _statement(t: Tables):
    return P.fee_statement(t.billing, t.store, calendar=t.calendar)


_FK = ["approval", "scheme", "card_type", "kind", "company", "invoice_group", "merchant_group", "is_online"]
_FV = ["transaction_count", "transaction_cents", "interchange_micros", "interchange_count", "processing_cents", "processing_count"]


@query(
    "m_fee_insights",
    f"""WITH r AS ({_RECENT.format(sct="''", n=13)}), f AS (SELECT {', '.join(_FK)}, CAST(date_trunc('month', tran_date) AS DATE) AS month, {_fees("approval = 'A'")} FROM r GROUP BY ALL)
SELECT c.* REPLACE (CAST(c.month AS VARCHAR) AS month), {', '.join(f'p.{v} AS {v}_lp' for v in _FV)}, CASE WHEN c.month = (SELECT max(month) FROM f) THEN 'max_month' END AS flag FROM f c LEFT JOIN f p ON {' AND '.join(f'p.{k} IS NOT DISTINCT FROM c.{k}' for k in _FK)} AND p.month = CAST(c.month - INTERVAL 1 MONTH AS DATE)""",
)
def _insights(t: Tables):
    return P.fee_insights(t.billing, t.store)


_PAY = f"{_net(_BUY, _PM)} AS purchase_count, {_net(['REFUND'], ['REFUND REVERSAL'])} AS refund_count, {_net(_BUY, _PM, 'amount_cents')} AS purchase_cents, {_net(['REFUND'], ['REFUND REVERSAL'], 'amount_cents')} AS refund_cents"
_SALES = f"s AS (SELECT b.*, m.company, m.brand, CASE m.is_online WHEN 'Online' THEN 'Online' WHEN 'Not Online' THEN 'In store' END AS channel FROM billing b LEFT JOIN store m ON m.store_id = b.store_id WHERE approval = 'A' AND kind IN {_in([*_BUY, *_PM, 'REFUND', 'REFUND REVERSAL'])})"
_PD = ["store_id", "company", "brand", "channel", "scheme", "card_type"]
_PV = ["purchase_count", "refund_count", "purchase_cents", "refund_cents"]


@query(
    "m_payments_and_refunds",
    f"""WITH {CALENDAR_SQL}, {_STARTS}, {_SALES}, s2 AS MATERIALIZED (SELECT s.*, fw_start_date, fp_start_date, fy_start_date FROM s LEFT JOIN calendar ON calendar_date = tran_date), f AS MATERIALIZED ({_framed(['Day', 'Week', 'Month', 'Period'], ', '.join(_PD), _PAY, 's2', _FISCAL)}),
cprev AS MATERIALIZED (SELECT c.*, {_FISCAL_PREV} AS before FROM f c {_WITH_PREV})
SELECT c.* EXCLUDE (before) REPLACE (CAST(c.period_start AS VARCHAR) AS period_start), {', '.join(f'p.{v} AS pre_{v}' for v in _PV)} FROM cprev c LEFT JOIN f p ON p.timeframe = c.timeframe AND p.period_start = c.before AND {' AND '.join(f'p.{k} IS NOT DISTINCT FROM c.{k}' for k in _PD)}""",
)
def _payments(t: Tables):
    return P.payments_and_refunds(t.billing, t.store, ("Day", "Week", "Month", "Period"), t.calendar, _parts(t), kept)


@query(
    "m_payments_snapshot",
    f"""WITH {CALENDAR_SQL}, {_SALES}, s2 AS MATERIALIZED (SELECT s.*, fw_start_date, fp_start_date FROM s LEFT JOIN calendar ON calendar_date = tran_date), f AS MATERIALIZED ({_framed(['Day', 'Week', 'Month', 'Period'], ', '.join(_PD), _PAY, 's2', _FISCAL)}), cb0 AS (SELECT c.*, m.company, m.brand, CASE m.is_online WHEN 'Online' THEN 'Online' WHEN 'Not Online' THEN 'In store' END AS channel, CASE WHEN c.id % 2 = 0 THEN 'VISA' END AS scheme, CASE WHEN c.id % 2 = 0 THEN 'CREDIT' END AS card_type, CAST(c.received_dt AS DATE) AS tran_date FROM chargebacks c LEFT JOIN store m ON m.store_id = c.store_id), cb AS (SELECT cb0.*, fw_start_date, fp_start_date FROM cb0 LEFT JOIN calendar ON calendar_date = tran_date),
d AS ({_framed(['Day', 'Week', 'Month', 'Period'], ', '.join(_PD), 'count(*) AS dispute_count, CAST(sum(amount_cents) AS BIGINT) AS dispute_cents', 'cb', _FISCAL)}), o AS (SELECT timeframe, min(period_start) AS oldest FROM f GROUP BY 1), u AS (SELECT * FROM f UNION ALL BY NAME SELECT * FROM d)
SELECT u.* REPLACE (CAST(u.period_start AS VARCHAR) AS period_start), CASE WHEN u.period_start = o.oldest THEN 'min_' || lower(u.timeframe) END AS min_flag FROM u LEFT JOIN o ON o.timeframe = u.timeframe""",
)
def _snapshot(t: Tables):
    links = t.chargebacks.where(col("id") % 2 == 0).select("id", F.lit("VISA").alias("scheme"), F.lit("CREDIT").alias("card_type"))
    return P.payments_snapshot(t.billing, t.chargebacks, t.store, links, ("Day", "Week", "Month", "Period"), t.calendar, _parts(t), kept)


_METHOD = "CASE c.scheme WHEN 'ALIPAY' THEN 'APM' WHEN 'EFTPOS' THEN 'DEBIT' WHEN 'FUEL CARDS' THEN 'APM' WHEN 'GIFT CARDS' THEN 'APM' WHEN 'PAYPAL' THEN 'APM' ELSE c.card_type END"


@query(
    "m_payment_preferences",
    f"""WITH {_SALES}, f AS (SELECT store_id, scheme, card_type, CAST(date_trunc('month', tran_date) AS DATE) AS month, {_PAY} FROM s GROUP BY ALL),
x AS (SELECT c.store_id, c.scheme, CAST(c.month AS VARCHAR) AS month, {', '.join('c.' + v for v in _PV)}, {', '.join(f'p.{v} AS pre_{v}' for v in _PV)}, {_METHOD} AS card_type FROM f c LEFT JOIN f p ON p.store_id = c.store_id AND p.scheme = c.scheme AND p.card_type = c.card_type AND p.month = CAST(c.month - INTERVAL 1 MONTH AS DATE))
SELECT *, 'Scheme' AS lens, scheme AS payment_method FROM x UNION ALL SELECT *, 'Card Type', card_type FROM x""",
)
def _preferences(t: Tables):
    return P.payment_preferences(t.billing, t.store)


_PLANS = "pl AS (SELECT n_name AS division, CASE WHEN n_nationkey % 3 = 0 THEN 'Daily' ELSE 'Weekdays' END AS payout_days, CAST(n_nationkey % 4 AS INT) AS sched, CASE WHEN n_nationkey % 2 = 0 THEN 'Monday' ELSE 'Tuesday' END AS weekend, CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE '06:00' END AS ptime FROM nation)"


@query(
    "m_payouts",
    f"""WITH {_PLANS}, ex AS (SELECT DISTINCT store_number, CASE trim(i) WHEN 'MC' THEN 'MASTERCARD' ELSE trim(i) END AS scheme FROM (SELECT store_number, unnest(string_split(exclude_issuers, ',')) AS i FROM sap_map WHERE exclude_issuers IS NOT NULL)),
r AS (SELECT b.*, m.division, m.company, pl.*EXCLUDE (division), CASE WHEN ex.scheme IS NOT NULL THEN 'Third Party' ELSE 'Own' END AS method, CAST(b.tstamp_trans + to_minutes(CASE WHEN w.settlement_cutoff = 0 THEN 0 ELSE 330 END) AS DATE) AS period FROM billing b JOIN store m ON m.store_id = b.store_id JOIN settlement_window w ON w.division = m.division JOIN pl ON pl.division = m.division
 LEFT JOIN ex ON ex.store_number = b.store_id AND ex.scheme = b.scheme WHERE b.approval = 'A'),
y AS (SELECT *, dayofweek(period) AS dow, CAST(CASE weekend WHEN 'Monday' THEN 1 ELSE 2 END AS INT) AS wk FROM r),
z AS (SELECT *, CASE WHEN payout_days <> 'Weekdays' THEN period + sched WHEN dow = 0 THEN period + wk WHEN dow = 6 THEN period + wk + 1 WHEN dayofweek(period + sched) = 0 THEN period + sched + 1 WHEN dayofweek(period + sched) = 6 THEN period + sched + 2 ELSE period + sched END AS due FROM y)
SELECT method, CAST(period AS VARCHAR) AS period, division, company, store_id, scheme, card_type, CAST(due AS VARCHAR) AS settle_date, coalesce(ptime, '03:00') AS payout_time, {_net(_OP, _OM, 'amount_cents')} AS trans_cents, {_net(_BUY, _PM, 'amount_cents')} AS gross_sales_cents,
 {_net(['REFUND REVERSAL'], ['REFUND'], 'amount_cents')} AS refund_cents, {_net(['CASHOUT'], ['ACTIVATION', 'CASHOUT REVERSAL'], 'amount_cents')} AS adjustment_cents FROM z GROUP BY method, z.period, division, company, store_id, scheme, card_type, due, coalesce(ptime, '03:00')""",
)
def _payouts(t: Tables):
    n = col("n_nationkey")
    plans = t.nation.select(
        col("n_name").alias("division"),
        F.when(n % 3 == 0, "Daily").otherwise("Weekdays").alias("payout_days"),
        (n % 4).alias("payout_schedule"),
        F.when(n % 2 == 0, "Monday").otherwise("Tuesday").alias("weekend_payout"),
        F.when(n % 5 != 0, "06:00").alias("payment_time"),
    )
    return P.payouts(t.billing, t.store, t.settlement_window, plans, t.sap_map)


@query(
    "m_nrt_fact",
    """WITH b AS (SELECT * REPLACE (CASE WHEN right(store_id, 1) = '7' THEN 'X' || store_id ELSE store_id END AS store_id) FROM billing WHERE tran_date < DATE '2001-06-20'), h AS (SELECT store_id, max(tstamp_trans) AS m FROM b GROUP BY 1)
SELECT x.tran_uid, x.amount_cents, x.src_type, m.brand, m.division FROM (SELECT tran_uid, amount_cents, store_id, 'BATCH' AS src_type FROM b UNION ALL SELECT l.tran_uid, l.amount_cents, l.store_id, 'NRT' FROM billing l LEFT JOIN h ON h.store_id = l.store_id WHERE (h.m IS NULL OR l.tstamp_trans > h.m) AND l.tstamp_trans <= TIMESTAMP '2001-07-15 06:30:00') x LEFT JOIN store m ON m.store_id = x.store_id""",
)
def _nrt(t: Tables):
    # some stores are known to the batch by another key, so the live side meets them for the first time
    batch = t.billing.where(col("tran_date") < "2001-06-20").withColumn("store_id", F.when(col("store_id").endswith("7"), F.concat(F.lit("X"), col("store_id"))).otherwise(col("store_id")))
    return P.nrt_fact(batch, t.billing, t.store, dt.datetime(2001, 7, 15, 6, 30)).select("tran_uid", "amount_cents", "src_type", "brand", "division")


def _summary_sql(where: str) -> str:
    return f"""WITH r AS (SELECT * FROM billing {where}), n AS (SELECT max(tran_date) AS d FROM r)
SELECT CAST(x.tran_date AS VARCHAR) AS tran_date, x.store_id, scheme, card_type, kind, approval, transaction_count, amount_cents, interchange_micros, processing_cents, m.company, m.merchant_group, if(x.tran_date = n.d, 'Y', 'N') AS max_date_flag, if(x.tran_date BETWEEN n.d - 14 AND n.d - 1, 'Y', 'N') AS fortnight_flag,
 if(date_trunc('week', x.tran_date) = date_trunc('week', n.d), 'Y', 'N') AS max_week_flag, if(date_trunc('month', x.tran_date) = date_trunc('month', n.d), 'Y', 'N') AS max_month_flag, CAST(CAST(date_trunc('week', x.tran_date) AS DATE) AS VARCHAR) AS week_start, CAST(CAST(date_trunc('week', x.tran_date) AS DATE) + 6 AS VARCHAR) AS week_end, CAST(last_day(x.tran_date) AS VARCHAR) AS month_end
FROM (SELECT tran_date, store_id, scheme, card_type, kind, approval, count(*) AS transaction_count, CAST(sum(amount_cents) AS BIGINT) AS amount_cents, CAST(sum(interchange_fee) AS BIGINT) AS interchange_micros, CAST(sum(processing_fees) AS BIGINT) AS processing_cents FROM r GROUP BY ALL) x JOIN store m ON m.store_id = x.store_id, n"""


@query("m_daily_fee_summary", _summary_sql("WHERE tran_date >= DATE '2001-07-09' - 84"))
def _daily(t: Tables):
    return P.daily_fee_summary([t.billing.where(col("approval") == a) for a in ("A", "D")], t.store, RUN_DATE)


@query("m_daily_fee_summary_history", _summary_sql(""))
def _daily_history(t: Tables):
    return P.daily_fee_summary([t.billing], t.store, RUN_DATE, weeks=None)


_RATES = "rt AS (SELECT s.o AS sales, r.o AS redemption, s.x AS sales_rate, r.x AS redemption_rate FROM (VALUES ('C0', 0.01::DOUBLE), ('C1', 0.02::DOUBLE), ('Any', 0.005::DOUBLE)) s(o, x), (VALUES ('C0', 0.01::DOUBLE), ('C1', 0.02::DOUBLE), ('Any', 0.005::DOUBLE)) r(o, x))"


@query(
    "m_gift_commission",
    f"""WITH {_RATES}, sold AS (SELECT card_number, 'C' || right(merchant, 1) AS outlet FROM gift_txn WHERE transaction_type = 'GIFT CARD ACTIVATE' QUALIFY row_number() OVER (PARTITION BY card_number ORDER BY transaction_date DESC NULLS LAST, 'C' || right(merchant, 1), reference_number) = 1),
p AS (SELECT coalesce(s.outlet, 'OWN') AS sales_outlet, m.company AS redemption_outlet, CAST(date_trunc('month', g.transaction_date) AS DATE) AS month, count(*) AS redemptions, sum(g.amount_cents) AS cents FROM gift_txn g LEFT JOIN sold s ON s.card_number = g.card_number LEFT JOIN store m ON m.store_id = g.outlet_code
 WHERE g.transaction_type IN ('GIFT CARD REDEEM', 'GIFT CARD RELOAD') AND g.transaction_date IS NOT NULL GROUP BY ALL), k AS (SELECT *, dense_rank() OVER (ORDER BY month DESC) AS rk FROM p)
SELECT CASE WHEN sales_outlet = redemption_outlet THEN 'Own activated and redeemed' ELSE 'Activated elsewhere' END AS scenario, sales_outlet, redemption_outlet, CAST(month AS VARCHAR) AS month, redemptions, CAST(cents AS BIGINT) AS cents, (CAST(cents AS DOUBLE) / 100) * sales_rate AS sales_commission, (CAST(cents AS DOUBLE) / 100) * redemption_rate AS redemption_commission,
 CASE WHEN rk <= 1 THEN 'Y' END AS latest_month_flag, CASE WHEN rk <= 12 THEN 'Y' END AS last_12_months_flag FROM k LEFT JOIN rt ON rt.sales = CASE WHEN sales_outlet IN ('C0', 'C1') THEN sales_outlet ELSE 'Any' END AND rt.redemption = CASE WHEN redemption_outlet IN ('C0', 'C1') THEN redemption_outlet ELSE 'Any' END""",
)
def _commission(t: Tables):
    from ledgerloom.sources.tables import local_table

    levels = {"C0": 0.01, "C1": 0.02, "Any": 0.005}
    rates = local_table(t.spark, "sales string, redemption string, sales_rate double, redemption_rate double", [(a, b, x, y) for a, x in levels.items() for b, y in levels.items()])
    sales = t.gift_txn.where(col("transaction_type") == "GIFT CARD ACTIVATE").withColumn("merchant", F.concat(F.lit("C"), F.right("merchant", F.lit(1))))
    return P.gift_commission(t.gift_txn, sales, t.store, rates, ["C0", "C1"])


@query(
    "m_enrich_billing",
    """WITH cb AS (SELECT store_id, txn_day, amount_cents, id FROM sale_chargebacks QUALIFY row_number() OVER (PARTITION BY store_id, txn_day, amount_cents ORDER BY file_date DESC, id) = 1),
s AS (SELECT tran_uid, max('rf' || order_number) AS seq FROM billing WHERE kind = 'REFUND' GROUP BY 1)
SELECT b.tran_uid, b.amount_cents, cb.id AS chargeback_id, 'tran_uid' || b.tran_uid AS payment_event_id, b.order_number AS order_id, CASE WHEN s.tran_uid IS NOT NULL THEN s.seq ELSE 'tran_uid' || b.tran_uid END AS payment_attempt_id FROM billing b LEFT JOIN cb ON cb.store_id = b.store_id AND cb.txn_day = b.tran_date AND cb.amount_cents = b.amount_cents LEFT JOIN s ON s.tran_uid = b.tran_uid""",
)
def _enrich(t: Tables):
    seq = t.billing.where(col("kind") == "REFUND").groupBy("tran_uid").agg(F.max(F.concat(F.lit("rf"), col("order_number"))).alias("payment_attempt_id"))
    out = P.enrich(t.billing, t.sale_chargebacks, seq)
    return out.select("tran_uid", "amount_cents", "chargeback_id", "payment_event_id", "order_id", "payment_attempt_id")


_MODEL = """sw AS (SELECT DISTINCT 'SCDR|' || scdr_token AS card_id, pymt_acct_ref AS par, scdr_token, masked_pan, card_type FROM switch_txn WHERE scdr_token IS NOT NULL QUALIFY rank() OVER (PARTITION BY scdr_token ORDER BY tstamp_trans DESC) = 1),
wa AS (SELECT DISTINCT 'customerRef|' || customer_ref AS customer_id, 'customerRef|' || customer_ref || '|containerId|' || container_id || '|itemId|' || item_id AS card_id, customer_ref, container_id, item_id FROM wallet_txn),
gi AS (SELECT DISTINCT 'CardNumber|' || card_number AS card_id, program_group FROM gift_txn),
mo AS (SELECT card_id AS customer_id, card_id, par, scdr_token, masked_pan, card_type, NULL::VARCHAR AS customer_ref, NULL::VARCHAR AS container_id, NULL::VARCHAR AS item_id, NULL::VARCHAR AS program_group FROM sw UNION ALL SELECT customer_id, card_id, NULL, NULL, NULL, NULL, customer_ref, container_id, item_id, NULL FROM wa UNION ALL SELECT card_id, card_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL, program_group FROM gi)"""


@query("m_card_identity_model", f"WITH {_MODEL} SELECT * FROM mo")
def _model(t: Tables):
    return I.model(t.switch_txn, t.wallet_txn, t.gift_txn)


@query(
    "m_card_identity_upkeep",
    f"""WITH {_MODEL}, k0 AS (SELECT * REPLACE (CASE WHEN md5(card_id) < '8' THEN par END AS par) FROM mo WHERE customer_ref IS NULL), rf AS (SELECT scdr_token, min(par) AS par FROM k0 WHERE par IS NOT NULL AND scdr_token IS NOT NULL GROUP BY 1),
k1 AS (SELECT k0.* REPLACE (CASE WHEN rf.scdr_token IS NOT NULL THEN rf.par ELSE k0.par END AS par) FROM k0 LEFT JOIN rf ON rf.scdr_token = k0.scdr_token), al AS (SELECT * FROM k1 UNION ALL SELECT DISTINCT * FROM mo WHERE card_id NOT IN (SELECT card_id FROM k1))
SELECT *, to_base64(unhex(sha256(card_id))) AS pan_alias FROM al""",
)
def _upkeep(t: Tables):
    full = I.model(t.switch_txn, t.wallet_txn, t.gift_txn)
    known = full.where(col("customer_ref").isNull()).withColumn("par", F.when(F.md5(col("card_id").cast("binary")) < "8", col("par")))
    return I.upkeep(known, full)


_LATEST = "la AS (SELECT * REPLACE (nullif(avg_ticket_cents, 99999) AS avg_ticket_cents) FROM area_benchmark QUALIFY rank() OVER (PARTITION BY area, industry_code, period ORDER BY file_date DESC) = 1)"


@query("m_area_latest", f"WITH {_LATEST} SELECT area, industry_code, CAST(period AS VARCHAR) AS period, CAST(file_date AS VARCHAR) AS file_date, avg_ticket_cents FROM la")
def _area(t: Tables):
    return B.latest_area(t.area_benchmark, "avg_ticket_cents")


@query(
    "m_area_growth",
    f"""WITH {_LATEST}, p AS (SELECT area, industry_code, period, max(avg_ticket_cents) AS v FROM la GROUP BY ALL)
SELECT c.area, c.industry_code, CAST(c.period AS VARCHAR) AS period, c.v AS avg_ticket_cents, m.v AS avg_ticket_cents_lm, y.v AS avg_ticket_cents_ly, coalesce(CAST(c.v - m.v AS DOUBLE) / nullif(m.v, 0), 0) AS growth_mom, coalesce(CAST(c.v - y.v AS DOUBLE) / nullif(y.v, 0), 0) AS growth_yoy
FROM p c LEFT JOIN p m ON m.area = c.area AND m.industry_code = c.industry_code AND m.period = c.period - INTERVAL 1 MONTH LEFT JOIN p y ON y.area = c.area AND y.industry_code = c.industry_code AND y.period = c.period - INTERVAL 12 MONTH""",
)
def _growth(t: Tables):
    return B.area_growth(B.latest_area(t.area_benchmark, "avg_ticket_cents"), "avg_ticket_cents")


@query(
    "m_stable_stores",
    """WITH a AS (SELECT DISTINCT store_id, CAST(date_trunc('month', tran_date) AS DATE) AS am FROM billing), c AS (SELECT DISTINCT am AS month FROM a) SELECT * FROM (SELECT CAST(c.month AS VARCHAR) AS month, a.store_id, count(DISTINCT a.am) AS active_months FROM c JOIN a ON c.month > a.am GROUP BY c.month, a.store_id) WHERE active_months >= 13""",
)
def _stable(t: Tables):
    return B.stable_stores(t.billing, "store_id", "tran_date")


_CM = f"cm AS (SELECT {{g}}, card_id, CAST(date_trunc('month', tran_date) AS DATE) AS month, {_net(_PP, _PM)} AS n, {_net(_PP, _AM, 'amount_cents')} AS c FROM bx WHERE approval = 'A' AND card_id IS NOT NULL AND kind IN {_in([*_PP, *_AM])} GROUP BY ALL)"
_BX = "bx AS (SELECT b.*, m.invoice_group, m.is_online FROM billing b JOIN store m ON m.store_id = b.store_id)"


def _coh(name: str, cond: str) -> str:
    return f"count(*) FILTER ({cond}) AS {name}_cust, CAST(coalesce(sum(n) FILTER ({cond}), 0) AS BIGINT) AS {name}_count, CAST(coalesce(sum(c) FILTER ({cond}), 0) AS BIGINT) AS {name}_cents"


_COHORT = f"""{_BX}, {_CM.format(g='invoice_group')}, v AS (SELECT a.*, p1.n IS NULL AND p2.n IS NULL AS isnew FROM cm a LEFT JOIN cm p1 ON p1.invoice_group = a.invoice_group AND p1.card_id = a.card_id AND p1.month = a.month - INTERVAL 1 MONTH LEFT JOIN cm p2 ON p2.invoice_group = a.invoice_group AND p2.card_id = a.card_id AND p2.month = a.month - INTERVAL 2 MONTH),
co AS (SELECT invoice_group, month, {_coh('once_off', 'n = 1')}, {_coh('repeat', 'n > 1')}, {_coh('new', 'n > 0 AND isnew')}, {_coh('returning', 'n > 0 AND NOT isnew')}, count(*) FILTER (n = 1) + count(*) FILTER (n > 1) AS cust_total FROM v GROUP BY ALL)"""
_CHANNEL = f"""{_CM.format(g='invoice_group, is_online').replace('cm AS', 'cn AS')}, pc AS (SELECT invoice_group, month, card_id, count(*) FILTER (is_online = 'Online') AS onl, count(*) FILTER (is_online <> 'Online') AS off, sum(n) AS n, sum(c) AS c FROM cn WHERE n > 0 GROUP BY ALL),
ch AS (SELECT invoice_group, month, {_coh('online', 'onl > 0 AND off = 0')}, {_coh('in_store', 'onl = 0 AND off > 0')}, {_coh('cross', 'onl > 0 AND off > 0')} FROM pc GROUP BY ALL)"""


def _grouped(t: Tables):
    return t.billing.join(t.store.select("store_id", "invoice_group", "is_online"), "store_id")


@query("m_customer_cohorts", f"WITH {_COHORT} SELECT * REPLACE (CAST(month AS VARCHAR) AS month) FROM co")
def _cohorts(t: Tables):
    return B.customer_cohorts(_grouped(t), "invoice_group")


@query("m_channel_cohorts", f"WITH {_BX}, {_CHANNEL} SELECT * REPLACE (CAST(month AS VARCHAR) AS month) FROM ch")
def _channels(t: Tables):
    return B.channel_cohorts(_grouped(t), "invoice_group", col("is_online") == "Online")


_KINDS = ["once_off", "repeat", "new", "returning", "online", "in_store", "cross"]


@query(
    "m_customer_behaviour",
    f"""WITH {_COHORT}, {_CHANNEL}, b AS (SELECT co.*, ch.* EXCLUDE (invoice_group, month) FROM co LEFT JOIN ch ON ch.invoice_group = co.invoice_group AND ch.month = co.month)
"""
    + "\nUNION ALL ".join(
        f"SELECT c.invoice_group, CAST(c.month AS VARCHAR) AS month, '{m}' AS metric, {', '.join(f'c.{k}_{s} AS {k}' for k in _KINDS)}, {', '.join(f'p.{k}_{s} AS {k}_lm' for k in _KINDS)} FROM b c LEFT JOIN b p ON p.invoice_group = c.invoice_group AND p.month = c.month - INTERVAL 1 MONTH"
        for m, s in (("Cardholders", "cust"), ("Sales", "cents"))
    ),
)
def _behaviour(t: Tables):
    g = _grouped(t)
    return P.customer_behaviour(B.customer_cohorts(g, "invoice_group"), B.channel_cohorts(g, "invoice_group", col("is_online") == "Online"), "invoice_group")


_LV = "\nUNION ALL ".join(
    f"SELECT 'AU' AS country, {st} AS state, {so} AS store_id, {sc} AS scheme, {ct} AS card_type, month, {_net(_PP, _PM)} AS sales_count, {_net(_PP, _AM, 'amount_cents')} AS sales_cents FROM bl GROUP BY ALL"
    for st, so in (("state", "store_id"), ("state", "'All'"), ("'All'", "'All'"))
    for sc, ct in (("scheme", "card_type"), ("scheme", "'All'"), ("'All'", "card_type"), ("'All'", "'All'"))
)
_BL = "bl AS (SELECT b.*, m.state, CAST(date_trunc('month', tran_date) AS DATE) AS month FROM billing b JOIN store m ON m.store_id = b.store_id WHERE approval = 'A')"


@query("m_performance_levels", f"WITH {_BL}, lv AS ({_LV}) SELECT * REPLACE (CAST(month AS VARCHAR) AS month) FROM lv")
def _levels(t: Tables):
    return B.performance_levels(t.billing, t.store, _parts(t))


@query(
    "m_benchmark_against_market",
    f"""WITH {_BL}, lv AS (SELECT state, store_id, month, {_net(_PP, _AM, 'amount_cents')} AS v FROM bl GROUP BY ALL), mk AS (SELECT state, month, sum(v) AS mv FROM lv GROUP BY ALL)
SELECT a.state, a.store_id, CAST(a.month AS VARCHAR) AS month, a.v AS sales_cents, p.v AS sales_cents_lm, CAST(mk.mv AS BIGINT) AS market_value, coalesce(CAST(a.v AS DOUBLE) / nullif(CAST(mk.mv AS DOUBLE), 0), 0) AS market_share FROM lv a LEFT JOIN lv p ON p.state = a.state AND p.store_id = a.store_id AND p.month = a.month - INTERVAL 1 MONTH LEFT JOIN mk ON mk.state = a.state AND mk.month = a.month""",
)
def _market(t: Tables):
    lv = B.performance_levels(t.billing, t.store).where((col("scheme") == "All") & (col("card_type") == "All") & (col("store_id") != "All"))
    return B.against_market(lv.select("state", "store_id", "month", "sales_cents"), ["state", "store_id"], ["state"], "sales_cents")
