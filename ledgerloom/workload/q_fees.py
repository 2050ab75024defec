"""Checked fee, file and reconciliation reports."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.plans import fees as P
from ledgerloom.plans import recon_reports as C
from ledgerloom.workload.feeds import RUN_DATE, STORE_WIDTH, Tables
from ledgerloom.workload.registry import query

col = F.col
_SCHEME = """CASE t.proc_id_iss_b WHEN 'AMEX' THEN 'AMEX' WHEN 'EHB' THEN 'EFTPOS' WHEN 'FDF' THEN 'FUEL CARDS' WHEN 'RED' THEN 'GIFT CARDS' WHEN 'VDCS' THEN 'VISA' WHEN 'MC' THEN 'MASTERCARD'
 WHEN 'FDI' THEN CASE WHEN t.inst_id_recon_iss = 'I0' THEN 'UPI' ELSE 'DINERS' END WHEN 'ANZ' THEN CASE WHEN t.inst_id_recon_iss = 'I0' THEN 'UPI' ELSE 'ACCOUNT' END END"""
_D4 = "CAST(CAST({c} AS DECIMAL(24,4)) AS VARCHAR)"


@query(
    "m_fee_listing",
    f"""WITH d AS (SELECT t.*, w.file_prefix, CAST(t.tstamp_local AS DATE) AS td FROM switch_txn t JOIN store m ON m.store_id = left(t.net_term_id, 10) JOIN settlement_window w ON w.division = m.division WHERE CAST(t.tstamp_local AS DATE) BETWEEN DATE '2000-07-05' AND DATE '2000-07-11' AND t.act_code <> '902')
SELECT 'D' AS record_type, t.net_term_id AS terminal_id, {_D4.format(c='t.transaction_total')} AS transaction_amt, strftime(t.tstamp_trans, '%Y%m%d%H%M%S') AS transaction_timestamp, CASE WHEN length(t.masked_pan) < 10 THEN t.masked_pan ELSE left(t.masked_pan, 6) || '******' || right(t.masked_pan, 4) END AS pan,
 printf('%06d', CAST(t.order_number AS BIGINT)) AS stan, t.mti, {_SCHEME} AS scheme, CASE t.card_type WHEN 'C' THEN 'Credit' ELSE 'Debit' END AS card_type, CASE WHEN t.proc_id_iss_b IN ('AMEX', 'FDI') THEN '0.0000' ELSE {_D4.format(c='t.interchange_fee')} END AS interchange_fee,
 {_D4.format(c='t.processing_fees')} AS processing_fee, t.file_prefix, CAST(t.td AS VARCHAR) AS tran_date FROM d t UNION ALL SELECT 'T', CAST(count(*) AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, file_prefix, CAST(td AS VARCHAR) FROM d GROUP BY file_prefix, td""",
)
def _fee_listing(t: Tables):
    days = P.listing_days(dt.date(2000, 7, 15), dt.date(2000, 7, 8))
    parts = [t.switch_txn.where(col("card_type") == k) for k in ("C", "D")]
    return P.fee_listing(parts, t.store, t.settlement_window, days, STORE_WIDTH)


@query(
    "m_group_fee_listing",
    "SELECT CAST(CAST(t.tstamp_local AS DATE) AS VARCHAR) AS tran_date, w.file_prefix, count(*) AS details, max(t.net_term_id) AS last_terminal FROM switch_txn t JOIN store m ON m.store_id = left(t.net_term_id, 10) JOIN settlement_window w ON w.division = m.division WHERE CAST(t.tstamp_local AS DATE) BETWEEN DATE '2000-04-28' AND DATE '2000-07-11' AND m.division = 'NATION_1' AND t.act_code <> '902' GROUP BY ALL",
)
def _group_listing(t: Tables):
    one = t.store.where(col("division") == "NATION_1")
    out = P.fee_listing([t.switch_txn], one, t.settlement_window, P.listing_days(dt.date(2000, 7, 15), dt.date(2000, 5, 1)), STORE_WIDTH)
    return out.where(col("record_type") == "D").groupBy("tran_date", "file_prefix").agg(F.count("*").alias("details"), F.max("terminal_id").alias("last_terminal"))


_ACC = "acc AS (SELECT store_id AS store_number, '062-' || right(store_id, 3) AS bsb, right(store_id, 9) AS account, coalesce(site_name, '') AS title FROM store)"


@query(
    "m_direct_entry_file",
    f"""WITH {_ACC}, p AS (SELECT left(terminal_id, 10) AS store_number, sum(amount_cents) AS cents FROM wallet_txn WHERE transaction_type = 'PURCHASE' AND CAST(txn_time AS DATE) = DATE '2001-07-14' GROUP BY 1), d AS (SELECT p.*, a.* EXCLUDE (store_number) FROM p JOIN acc a USING (store_number) WHERE cents > 0)
SELECT 'DE.0107141' AS file_name, 0 AS line_rank, '' AS sort_key, '0' || repeat(' ', 17) || '01' || 'BNK' || repeat(' ', 7) || rpad('LEDGERLOOM', 26, ' ') || '140701' AS line FROM (SELECT count(*) FROM d)
UNION ALL SELECT 'DE.0107141', 1, store_number, '1' || bsb || lpad(account, 9, ' ') || ' ' || '50' || lpad(CAST(CAST(cents AS BIGINT) AS VARCHAR), 10, '0') || rpad(title, 32, ' ') || rpad(store_number || '010714', 18, ' ') FROM d
UNION ALL SELECT 'DE.0107141', 2, '', '7' || '999-999' || repeat(' ', 12) || lpad(CAST(CAST(coalesce(sum(cents), 0) AS BIGINT) AS VARCHAR), 10, '0') || lpad(CAST(CAST(coalesce(sum(cents), 0) AS BIGINT) AS VARCHAR), 10, '0') || repeat('0', 10) || repeat(' ', 24) || lpad(CAST(count(*) AS VARCHAR), 6, '0') FROM d""",
)
def _direct_entry(t: Tables):
    accounts = t.store.select(
        col("store_id").alias("store_number"), F.concat(F.lit("062-"), F.right("store_id", F.lit(3))).alias("bsb"), F.right("store_id", F.lit(9)).alias("account"), F.coalesce("site_name", F.lit("")).alias("title")
    )
    day = RUN_DATE - dt.timedelta(days=1)
    cleared = t.wallet_txn.where((col("transaction_type") == "PURCHASE") & (col("txn_time").cast("date") == F.lit(day)))
    sums = cleared.groupBy(F.left("terminal_id", F.lit(10)).alias("store_number")).agg(F.sum("amount_cents").alias("cents"))
    return P.direct_entry(sums, accounts, day, 1)


@query(
    "m_reply_file_parse",
    """SELECT 'detail' AS kind, 'REF' || CAST(o_orderkey AS VARCHAR) AS ref FROM orders WHERE o_orderkey % 3 = 2 AND o_custkey % 10 <> 0 UNION ALL SELECT 'header_1', CAST(o_custkey AS VARCHAR) FROM orders WHERE o_orderkey % 3 = 0 UNION ALL SELECT 'header_2', lpad(CAST(o_custkey AS VARCHAR), 6, '0') FROM orders WHERE o_orderkey % 3 = 1""",
)
def _reply(t: Tables):
    key = col("o_orderkey") % 3
    text = (
        F.when(key == 0, F.concat(F.lit("0"), F.rpad(col("o_custkey").cast("string"), 14, " "), F.lit("x")))
        .when(key == 1, F.concat(F.lit("1"), F.lpad(col("o_custkey").cast("string"), 6, "0"), F.lit("000001")))
        .otherwise(F.concat(F.rpad(F.concat(F.lit("2000001"), F.lit("062-000")), 68, " "), F.rpad(F.concat(F.lit("REF"), col("o_orderkey").cast("string")), 18, " ")))
    )
    lines = t.orders.select(text.alias("value"), F.lit("r").alias("file_name"))
    seen = t.orders.where(col("o_custkey") % 10 == 0).select(F.concat(F.lit("REF"), col("o_orderkey").cast("string")).alias("lodgement_reference"))
    parts = P.reply_records(lines, seen)
    refs = {"header_1": "payment_reference", "header_2": "valid_items", "detail": "lodgement_reference"}
    out = None
    for kind, df in parts.items():
        one = df.select(F.lit(kind).alias("kind"), col(refs[kind]).alias("ref"))
        out = one if out is None else out.unionByName(one)
    return out


@query("m_weekly_wallet_extract", "SELECT order_id, CAST(txn_time AS VARCHAR) AS txn_time, '2001-07-05' AS week_start FROM wallet_txn WHERE CAST(txn_time AS DATE) BETWEEN DATE '2001-07-05' AND DATE '2001-07-11'")
def _weekly(t: Tables):
    return P.weekly_extract(t.wallet_txn, RUN_DATE).select("order_id", "txn_time", "week_start")


_FEE_SQL = """WITH one AS (SELECT trace_id, transaction_amt, max(interchange_fee) AS fee FROM (SELECT *, rank() OVER (PARTITION BY trace_id, transaction_amt ORDER BY load_time DESC) AS r FROM {fees} WHERE trace_id IS NOT NULL) WHERE r = 1 GROUP BY 1, 2),
two AS (SELECT term_id, transaction_amt, min(interchange_fee) AS fee FROM {fees} GROUP BY 1, 2),
x AS (SELECT a.*, CASE WHEN coalesce(a.transaction_approval_status, 0) = 0 THEN coalesce(one.fee, two.fee) END AS fee, CASE WHEN coalesce(a.transaction_approval_status, 0) <> 0 THEN NULL WHEN one.fee IS NOT NULL THEN 1 WHEN two.fee IS NOT NULL THEN 2 END AS step,
 CASE WHEN a.transaction_type = 'REFUND' THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS sgn, CAST(a.transaction_amount AS DOUBLE) / 100 AS amt FROM acquirer_txn a
 LEFT JOIN one ON one.trace_id = a.tran_uid AND one.transaction_amt = a.transaction_amount LEFT JOIN two ON two.term_id = a.terminal_id AND two.transaction_amt = a.transaction_amount WHERE a.scheme = '{scheme}')
SELECT x.tran_uid, CAST(x.file_date AS VARCHAR) AS transaction_date, m.store_id, m.division, m.company, m.merchant_group, m.invoice_group, x.card_type, x.transaction_type, x.amt * x.sgn AS tran_amt, CAST(x.fee AS DOUBLE) / 1000000 / 1.1::DOUBLE * x.sgn AS interchange_fee,
 CASE WHEN x.amt <> 0 THEN CAST(x.fee AS DOUBLE) / 1000000 / x.amt END AS calc_interchange, CASE r.proc_fee_code WHEN 'ALL' THEN x.amt * CAST(r.proc_fee_percent AS DOUBLE) / 100 + CAST(r.proc_fee_fixed AS DOUBLE) WHEN 'FIXED' THEN CAST(r.proc_fee_fixed AS DOUBLE)
 WHEN 'PERCENT' THEN x.amt * CAST(r.proc_fee_percent AS DOUBLE) / 100 ELSE 0.0::DOUBLE END AS processing_fees, x.step AS match_step
FROM x LEFT JOIN store m ON m.store_id = left(x.terminal_id, 10) LEFT JOIN rate_card r ON r.merchant = m.ratecard_group AND r.card_type = x.card_type AND x.file_date BETWEEN r.from_date AND coalesce(r.to_date, DATE '2999-12-31')"""
_MATCHED = "(SELECT trace_id, load_time, term_id, fee_code, CASE WHEN trace_id % 2 = 0 OR trace_id IS NULL THEN coalesce(o.transaction_amount, f.transaction_amt) ELSE f.transaction_amt END AS transaction_amt, interchange_fee FROM scheme_fee f LEFT JOIN acquirer_txn o ON o.tran_uid = f.trace_id)"


def _fees(t: Tables):
    """Scheme fees whose amounts agree with the acquirer's for the even traces."""
    own = t.acquirer_txn.select(col("tran_uid").alias("trace_id"), "transaction_amount")
    # fees without a trace find nothing; in the join they would all meet in one task
    traced = t.scheme_fee.where(col("trace_id").isNotNull()).join(own, "trace_id", "left")
    both = traced.unionByName(t.scheme_fee.where(col("trace_id").isNull()), allowMissingColumns=True)
    amount = F.when((col("trace_id") % 2 == 0) | col("trace_id").isNull(), F.coalesce("transaction_amount", "transaction_amt")).otherwise(col("transaction_amt"))
    return both.withColumn("transaction_amt", amount).drop("transaction_amount")


@query("m_visa_fee_match", _FEE_SQL.format(fees=_MATCHED, scheme="VISA"))
def _visa(t: Tables):
    return P.scheme_fee_report(t.acquirer_txn, _fees(t), t.store, t.rate_card, "VISA", STORE_WIDTH)


@query("m_mastercard_fee_match", _FEE_SQL.format(fees=_MATCHED, scheme="MASTERCARD"))
def _mastercard(t: Tables):
    return P.scheme_fee_report(t.acquirer_txn, _fees(t), t.store, t.rate_card, "MASTERCARD", STORE_WIDTH)


@query(
    "m_average_fee_report",
    """SELECT CAST(t.file_date AS VARCHAR) AS file_date, m.division, t.mti, t.card_type, CASE WHEN t.card_type = 'C' THEN coalesce((CAST(sum(t.interchange_fee) AS DOUBLE) / 1000000) / nullif(CAST(sum(t.transaction_total) AS DOUBLE) / 100, 0), 0) * 100 ELSE 0 END AS avg_fee_percent,
 CASE WHEN t.card_type = 'C' THEN 0 ELSE (CAST(sum(t.interchange_fee) AS DOUBLE) / 1000000) / count(*) END AS average_fee, CAST(sum(t.transaction_total) AS DOUBLE) / 100 AS total_amount, CAST(sum(t.interchange_fee) AS DOUBLE) / 1000000 AS total_fees, count(*) AS tran_count
 FROM switch_txn t LEFT JOIN store m ON m.store_id = left(t.net_term_id, 10) GROUP BY t.file_date, m.division, t.mti, t.card_type""",
)
def _average(t: Tables):
    return P.average_fee_report(t.switch_txn, t.store, ["file_date", "division", "mti"], STORE_WIDTH)


@query(
    "m_signed_fee_rows",
    """SELECT t.tran_uid, t.mti, m.store_id, m.division, m.brand, m.company, s.currency_code, CASE WHEN (t.tran_type_id = '00' AND t.mti = '1440') OR (t.tran_type_id = '20' AND t.mti <> '1440') THEN -1 ELSE 1 END * (CAST(t.transaction_total AS DOUBLE) / 100) AS tran_amt,
 CAST(t.interchange_fee AS DOUBLE) / 1000000 AS interchange_fee, CASE WHEN t.transaction_total <> 0 THEN (CAST(t.interchange_fee AS DOUBLE) / 1000000) / (CAST(t.transaction_total AS DOUBLE) / 100) END AS calc_interchange_fee,
 CASE t.tran_type_id WHEN '00' THEN 'Purchase' WHEN '01' THEN 'Cashout' WHEN '09' THEN 'Purchase with Cashout' WHEN '20' THEN 'Refund' END AS tran_type FROM switch_txn t LEFT JOIN store m ON m.store_id = left(t.net_term_id, 10) LEFT JOIN sap_map s ON s.store_number = left(t.net_term_id, 10)""",
)
def _signed(t: Tables):
    return P.signed_fee_rows(t.switch_txn, t.store, t.sap_map, STORE_WIDTH)


@query(
    "m_unit_rates",
    "SELECT t.tran_uid, t.mti, CAST(t.transaction_total AS DOUBLE) / 100 AS transaction_total, CAST(t.interchange_fee AS DOUBLE) / 100 AS interchange_fee, m.store_id, m.division, m.company, m.is_online FROM switch_txn t LEFT JOIN store m ON m.store_id = left(t.net_term_id, 10)",
)
def _units(t: Tables):
    return P.unit_converted(t.switch_txn, t.store, ["transaction_total", "interchange_fee"], ["tran_uid", "mti"], STORE_WIDTH)


@query(
    "m_combined_fees",
    """SELECT b.tran_uid, b.scheme, b.card_type, b.amount_cents, f.rate FROM billing b LEFT JOIN (SELECT scheme, card_type, CAST(sum(interchange_fee) AS DOUBLE) / sum(amount_cents) AS rate FROM billing GROUP BY ALL) f ON f.scheme = b.scheme AND f.card_type = b.card_type WHERE b.tstamp_trans >= TIMESTAMP '2001-03-17'""",
)
def _combined(t: Tables):
    rates = t.billing.groupBy("scheme", "card_type").agg((F.sum("interchange_fee").cast("double") / F.sum("amount_cents")).alias("rate"))
    parts = [t.billing.where(col("approval") == "A"), t.billing.where(col("approval") == "D")]
    return P.combined_fees(parts, rates, RUN_DATE - dt.timedelta(days=120), ["scheme", "card_type"]).select("tran_uid", "scheme", "card_type", "amount_cents", "rate")


@query("m_analytical_summary", "SELECT tran_uid, store_id, kind, card_id, amount_cents FROM billing WHERE coalesce(trim(store_id), '') <> '' AND card_id IS NOT NULL")
def _summary(t: Tables):
    parts = [t.billing.where(col("card_type") == k) for k in ("CREDIT", "DEBIT")]
    return P.quality_union(parts, ["store_id", "card_id"]).select("tran_uid", "store_id", "kind", "card_id", "amount_cents")


@query(
    "m_declined_transactions",
    """SELECT d.*, m.merchant_group, m.brand, r.approval_flag FROM (SELECT store_id, scheme, declined_reason, CAST(CAST(date_trunc('week', tran_date) AS DATE) AS VARCHAR) AS week_start, CAST(CAST(date_trunc('week', tran_date) AS DATE) + 6 AS VARCHAR) AS week_end, count(*) AS declined_count, CAST(sum(amount_cents) AS BIGINT) AS declined_cents
 FROM billing WHERE approval = 'D' AND tran_date >= DATE '1996-01-01' GROUP BY ALL) d LEFT JOIN store m ON m.store_id = d.store_id LEFT JOIN response_code r ON r.action_code = d.declined_reason""",
)
def _declined(t: Tables):
    return P.declined_summary(t.billing, t.store, t.response_code, dt.date(1996, 1, 1))


@query(
    "m_gift_tax_lines",
    """SELECT card_number, merchant, CAST(transaction_date AS VARCHAR) AS transaction_date, transaction_type, '3%' AS discount, CAST(amount_cents AS DOUBLE) / 100 AS amount, CAST(amount_cents * 3 AS DOUBLE) / 10000 AS discount_value, CAST(amount_cents * 45 AS DOUBLE) / 1000000 AS gst_value, CAST(amount_cents * 97 AS DOUBLE) / 10000 AS net_value FROM gift_txn WHERE merchant LIKE '%RCH1%'""",
)
def _gift_tax(t: Tables):
    return P.gift_tax_lines(t.gift_txn, "%RCH1%")


_CODES = {"MERCH10": "PRE", "MERCH1": "DIG", "MERCH": "OTH"}
_ACCOUNTS = {"MERCH10": "118298", "MERCH1": "116685", "MERCH": "114757"}


@query(
    "m_partner_ledger",
    """WITH p AS (SELECT merchant, CAST(transaction_date AS DATE) AS day, sum(amount_cents) AS a, sum(discount_cents) AS d FROM partner_txn WHERE transaction_date IS NOT NULL GROUP BY ALL),
k AS (SELECT *, CASE WHEN merchant LIKE 'MERCH10%' THEN 'PRE' WHEN merchant LIKE 'MERCH1%' THEN 'DIG' ELSE 'OTH' END AS code, CASE WHEN merchant LIKE 'MERCH10%' THEN '118298' WHEN merchant LIKE 'MERCH1%' THEN '116685' ELSE '114757' END AS acct, lpad(CAST(isoyear(day) % 100 AS VARCHAR), 2, '0') AS yy FROM p)
SELECT merchant, CAST(day AS VARCHAR) AS day, code || strftime(day, '%d%m') || yy || 'ACT' AS reference_no, acct AS customer_account, '204743' AS gl_account, merchant || ' ' || strftime(day, '%d-%m-') || yy AS customer_text, '5975' AS profit_centre, '' AS cost_centre, CAST(a AS DOUBLE) / 100 AS amount FROM k
UNION ALL SELECT merchant, CAST(day AS VARCHAR), code || strftime(day, '%d%m') || yy || 'DIS', acct, '699200', merchant || ' ' || strftime(day, '%d-%m-') || yy, '', '9876', CAST(-d AS DOUBLE) / 100 FROM k""",
)
def _partner_ledger(t: Tables):
    return P.partner_ledger(t.partner_txn, "transaction_date", _CODES, _ACCOUNTS)


@query(
    "m_activation_ledger",
    """WITH p AS (SELECT merchant, transaction_date AS day, sum(amount_cents) AS a FROM gift_txn WHERE transaction_date IS NOT NULL AND merchant LIKE 'MERCH1%' GROUP BY ALL), k AS (SELECT *, lpad(CAST(isoyear(day) % 100 AS VARCHAR), 2, '0') AS yy, CASE WHEN merchant LIKE 'MERCH10%' THEN 'PRE' ELSE 'DIG' END AS code FROM p)
SELECT merchant, CAST(day AS VARCHAR) AS day, code || strftime(day, '%d%m') || yy || 'ACT' AS reference_no, CAST(a AS DOUBLE) / 100 AS amount FROM k UNION ALL SELECT merchant, CAST(day AS VARCHAR), code || strftime(day, '%d%m') || yy || 'DIS', CAST(-(a * 3 // 100) AS DOUBLE) / 100 FROM k""",
)
def _activation_ledger(t: Tables):
    rows = t.gift_txn.where(col("merchant").startswith("MERCH1")).groupBy("merchant", "transaction_date").agg(F.sum("amount_cents").alias("amount_cents"))
    out = P.partner_ledger(rows, "transaction_date", _CODES, _ACCOUNTS, F.floor(col("amount_cents") * 3 / 100))
    return out.select("merchant", "day", "reference_no", "amount")


_AP = "ap AS (SELECT req_tx_ref AS order_no, req_store, req_date, req_type, CAST(sum(CASE WHEN req_time <= '18:00:00' THEN amount_cents ELSE 0 END) AS BIGINT) AS before_cutoff, CAST(sum(CASE WHEN req_time > '18:00:00' THEN amount_cents ELSE 0 END) AS BIGINT) AS after_cutoff FROM apm_txn WHERE req_type IN ('N', 'N-', 'R', 'P') GROUP BY ALL)"


@query(
    "m_apm_missing",
    f"""WITH {_AP}, st AS (SELECT transaction_id, store_id, payment_date, CAST(sum(amount_cents) AS BIGINT) AS c FROM apm_settlement GROUP BY ALL)
SELECT coalesce(order_no, transaction_id) AS order_no, req_store, CAST(req_date AS VARCHAR) AS req_date, req_type, before_cutoff, after_cutoff, store_id, CAST(payment_date AS VARCHAR) AS payment_date, c AS settled_cents, CASE WHEN order_no IS NULL THEN 'Missing in requests' WHEN transaction_id IS NULL THEN 'Missing in settlement' ELSE 'Not Missing' END AS flag FROM ap FULL JOIN st ON order_no = transaction_id""",
)
def _apm_missing(t: Tables):
    return C.apm_missing(t.apm_txn, t.apm_settlement)


@query(
    "m_apm_tran_level",
    f"""WITH {_AP}, st AS (SELECT transaction_id, CAST(sum(amount_cents) AS BIGINT) AS c FROM apm_settlement GROUP BY 1) SELECT order_no, req_store, CAST(req_date AS VARCHAR) AS req_date, req_type, before_cutoff, after_cutoff, c AS settled_cents, CASE WHEN coalesce(c, 0) = before_cutoff + after_cutoff THEN 'Matched' ELSE 'Mismatched' END AS flag FROM ap LEFT JOIN st ON order_no = transaction_id""",
)
def _apm_tran(t: Tables):
    return C.apm_tran_level(t.apm_txn, t.apm_settlement)


@query(
    "m_apm_store_level",
    f"""WITH {_AP}, st AS (SELECT transaction_id, store_id, CAST(sum(amount_cents) AS BIGINT) AS c FROM apm_settlement GROUP BY 1, 2) SELECT DISTINCT req_store, CAST(req_date AS VARCHAR) AS req_date, req_type, c AS settled_cents, before_cutoff, after_cutoff, CASE WHEN c = before_cutoff + after_cutoff THEN 'Matched' ELSE 'Mismatched' END AS flag FROM ap LEFT JOIN st ON order_no = transaction_id AND store_id = req_store""",
)
def _apm_store(t: Tables):
    return C.apm_store_level(t.apm_txn, t.apm_settlement)


@query(
    "m_apm_clearing",
    "SELECT a.transaction_id, CAST(a.payment_date AS VARCHAR) AS payment_date, a.store_id, a.n AS transaction_count, m.division, m.brand, m.company, s.merchant_organisation_id, CAST(a.c AS DOUBLE) / 100 AS amount FROM (SELECT transaction_id, payment_date, store_id, count(*) AS n, sum(amount_cents) AS c FROM apm_settlement GROUP BY ALL) a LEFT JOIN store m ON m.store_id = a.store_id LEFT JOIN sap_map s ON s.store_number = a.store_id",
)
def _clearing(t: Tables):
    return C.clearing(t.apm_settlement, t.store, t.sap_map)


_SW = "sw AS (SELECT CAST(order_number AS BIGINT) AS k, CAST(sum(CASE WHEN strftime(tstamp_local, '%H:%M:%S') <= '18:00:00' THEN transaction_total ELSE 0 END) AS BIGINT) AS switch_before, CAST(sum(CASE WHEN strftime(tstamp_local, '%H:%M:%S') > '18:00:00' THEN transaction_total ELSE 0 END) AS BIGINT) AS switch_after FROM {s} GROUP BY 1)"
_WA = "wa AS (SELECT order_id AS k, CAST(sum(CASE WHEN gateway = 'WEX' THEN CASE WHEN transaction_type = 'REFUND' THEN -amount_cents ELSE amount_cents END ELSE 0 END) AS BIGINT) AS wallet_wex, CAST(sum(CASE WHEN gateway = 'QC' THEN CASE WHEN transaction_type = 'REFUND' THEN -amount_cents ELSE amount_cents END ELSE 0 END) AS BIGINT) AS wallet_gift, min(txn_time) AS wt FROM {w} GROUP BY 1)"
_PO = "po AS (SELECT reference_number AS k, CAST(sum(tender_cents) AS BIGINT) AS pos_cents, min(site_number) AS site_number FROM {p} GROUP BY 1)"


@query(
    "m_three_source_missing",
    f"""WITH {_SW.format(s="switch_txn")}, {_WA.format(w="wallet_txn")}, {_PO.format(p="pos_tender")}, ab AS (SELECT coalesce(sw.k, wa.k) AS k, switch_before, switch_after, wallet_wex, wallet_gift, wt FROM sw FULL JOIN wa ON sw.k = wa.k)
SELECT coalesce(ab.k, po.k) AS order_id, switch_before, switch_after, wallet_wex, wallet_gift, CAST(wt AS VARCHAR) AS wallet_time, pos_cents, site_number, CASE WHEN po.k IS NULL THEN 'Missing in POS' WHEN ab.k IS NULL THEN 'Missing in SWITCH/WALLET' ELSE 'Not Missing' END AS flag FROM ab FULL JOIN po ON ab.k = po.k""",
)
def _three(t: Tables):
    return C.three_source_missing(t.switch_txn, t.wallet_txn, t.pos_tender)


@query(
    "m_three_source_match",
    f"""WITH {_SW.format(s="switch_txn")}, {_WA.format(w="wallet_txn")}, {_PO.format(p="pos_tender")}
SELECT po.k AS order_id, pos_cents, site_number, switch_before, switch_after, wallet_wex, wallet_gift, CASE WHEN pos_cents = coalesce(switch_before, 0) + coalesce(switch_after, 0) + coalesce(wallet_wex, 0) + coalesce(wallet_gift, 0) THEN 'Matched' ELSE 'Mismatched' END AS flag FROM po LEFT JOIN sw ON sw.k = po.k LEFT JOIN wa ON wa.k = po.k""",
)
def _three_match(t: Tables):
    return C.three_source_match(t.switch_txn, t.wallet_txn, t.pos_tender)


@query(
    "m_three_source_store",
    f"""WITH {_WA.format(w='wallet_txn')}, p AS (SELECT reference_number AS k, site_number, business_date AS day, sum(tender_cents) AS c FROM pos_tender GROUP BY ALL), s AS (SELECT CAST(order_number AS BIGINT) AS k, left(net_term_id, 10) AS site_number, sum(transaction_total) AS c FROM switch_txn GROUP BY ALL)
SELECT p.site_number, CAST(p.day AS VARCHAR) AS day, CAST(sum(p.c) AS BIGINT) AS pos_cents, CAST(sum(coalesce(s.c, 0)) AS BIGINT) AS switch_cents, CAST(sum(coalesce(wallet_wex + wallet_gift, 0)) AS BIGINT) AS wallet_cents, CASE WHEN sum(p.c) = sum(coalesce(s.c, 0)) + sum(coalesce(wallet_wex + wallet_gift, 0)) THEN 'Matched' ELSE 'Mismatched' END AS flag
FROM p LEFT JOIN s ON s.k = p.k AND s.site_number = p.site_number LEFT JOIN wa ON wa.k = p.k GROUP BY p.site_number, p.day""",
)
def _three_store(t: Tables):
    return C.three_source_store(t.switch_txn, t.wallet_txn, t.pos_tender)


_GP = """g AS (SELECT CAST(reference_number AS BIGINT) AS k, outlet_code AS s, merchant, CAST(sum(amount_cents) AS BIGINT) AS gift_cents FROM gift_txn GROUP BY ALL), p AS (SELECT reference_number AS k, site_number AS s, CAST(sum(tender_cents) FILTER (tender_type = 'REDEEM') AS BIGINT) AS redeem_cents, CAST(sum(tender_cents) FILTER (tender_type = 'ACTIVATE') AS BIGINT) AS activate_cents FROM pos_tender GROUP BY ALL),
x AS (SELECT g.k AS order_id, g.s AS site_number, merchant, gift_cents, redeem_cents, activate_cents, CASE WHEN gift_cents = coalesce(redeem_cents, 0) + coalesce(activate_cents, 0) THEN 'Matched' ELSE 'Mismatched' END AS flag FROM g LEFT JOIN p ON p.k = g.k AND p.s = g.s)"""


@query("m_gift_pos_transactions", f"WITH {_GP} SELECT * FROM x")
def _gift_trans(t: Tables):
    return C.gift_pos_transactions(t.gift_txn, t.pos_tender)


@query("m_gift_pos_stores", f"WITH {_GP} SELECT site_number, merchant, count(*) AS orders, CAST(sum(gift_cents) AS BIGINT) AS gift_cents, CAST(sum(redeem_cents) AS BIGINT) AS redeem_cents, CAST(sum(activate_cents) AS BIGINT) AS activate_cents FROM x GROUP BY ALL")
def _gift_stores(t: Tables):
    return C.gift_pos_stores(t.gift_txn, t.pos_tender)


@query(
    "m_gift_online_summary",
    """SELECT g.*, w.wallet_cents, w.wallet_kind FROM (SELECT CAST(reference_number AS BIGINT) AS order_id, transaction_type, transaction_status, CAST(sum(amount_cents) AS BIGINT) AS gift_cents FROM gift_txn GROUP BY ALL) g JOIN (SELECT order_id, CAST(sum(amount_cents) AS BIGINT) AS wallet_cents, CASE transaction_type WHEN 'PURCHASE' THEN 'GIFT CARD REDEEM' ELSE 'GIFT CARD ACTIVATE' END AS wallet_kind FROM wallet_txn GROUP BY order_id, transaction_type) w ON w.order_id = g.order_id""",
)
def _gift_online(t: Tables):
    return C.gift_online(t.gift_txn, t.wallet_txn)


@query(
    "m_gift_online_missing",
    """SELECT coalesce(g.k, w.k) AS order_id, gift_cents, wallet_cents, CASE WHEN g.k IS NULL THEN 'Missing in gift cards' WHEN w.k IS NULL THEN 'Missing in wallet' ELSE 'Not Missing' END AS flag FROM (SELECT CAST(reference_number AS BIGINT) AS k, CAST(sum(amount_cents) AS BIGINT) AS gift_cents FROM gift_txn WHERE transaction_status = 'SUCCESS' GROUP BY 1) g
 FULL JOIN (SELECT order_id AS k, CAST(sum(amount_cents) AS BIGINT) AS wallet_cents FROM wallet_txn WHERE gateway = 'QC' GROUP BY 1) w ON g.k = w.k""",
)
def _gift_missing(t: Tables):
    return C.gift_online_missing(t.gift_txn, t.wallet_txn)
