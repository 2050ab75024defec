"""Checked settlement pipelines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.plans import settlement as P
from ledgerloom.workload.feeds import CALENDAR_SQL, RUN_DATE, RUN_TS, STORE_WIDTH, Tables
from ledgerloom.workload.registry import query
from ledgerloom.workload.scratch import kept

col = F.col

_UID_QP = """'QP_' || coalesce(trim(invoice_number), 'Null') || '_' || CASE WHEN length(card_number) < 10 THEN card_number ELSE left(card_number, 6) || repeat('*', length(card_number) - 9) || right(card_number, 3) END || '_' || transaction_type || '_' || coalesce(strftime(transaction_date, '%Y%m%dT%H%M%S'), '19000101T000000')"""
_GIFT_TS = "CAST(coalesce(CAST(transaction_date AS VARCHAR), '1900-01-01') || ' ' || coalesce(transaction_time, '00:00:00') AS TIMESTAMP)"
_SCHEME = """CASE t.proc_id_iss_b WHEN 'AMEX' THEN 'AMEX' WHEN 'EHB' THEN 'EFTPOS' WHEN 'FDF' THEN 'FUEL CARDS' WHEN 'RED' THEN 'GIFT CARDS' WHEN 'VDCS' THEN 'VISA' WHEN 'MC' THEN 'MASTERCARD'
 WHEN 'FDI' THEN CASE WHEN t.inst_id_recon_iss = 'I0' THEN 'UPI' ELSE 'DINERS' END WHEN 'ANZ' THEN CASE WHEN t.inst_id_recon_iss = 'I0' THEN 'UPI' ELSE 'ACCOUNT' END END"""
_KIND = """CASE WHEN t.proc_id_iss_b = 'RED' THEN CASE upper(y.abbr) WHEN 'PURCHASE' THEN 'REDEMPTION' WHEN 'REFUND' THEN 'ACTIVATION' WHEN 'BALANCE INQUIRY - SAVINGS' THEN 'BALANCE INQUIRY' ELSE upper(y.abbr) END ELSE upper(y.abbr) END || CASE WHEN t.mti = '1440' THEN ' REVERSAL' ELSE '' END"""

_SOURCES = f"""src AS (
SELECT 'QC_' || approval_code || '_' || reference_number || '_' || CAST(batch_number AS VARCHAR) || '_' || strftime({_GIFT_TS}, '%Y%m%dT%H%M%S') AS uid, {_GIFT_TS} AS ts, 'gift' AS fn, outlet_code AS store_id, transaction_type AS kind, '' AS q, amount_cents AS a, 'NONE' AS issuer
 FROM gift_txn WHERE transaction_status = 'SUCCESS' AND merchant NOT IN (SELECT division FROM settlement_window WHERE division_type = 'PARTNER')
UNION ALL SELECT 'DP_' || txn_ref, date_trunc('second', txn_time), 'wallet', left(terminal_id, 10), transaction_type, CASE WHEN length(txn_ref) - length(replace(txn_ref, '.', '')) = 0 THEN 'WEX' ELSE 'QC' END, amount_cents, 'NONE'
 FROM wallet_txn WHERE transaction_type = 'PURCHASE' AND length(txn_ref) - length(replace(txn_ref, '.', '')) IN (0, 2)
UNION ALL SELECT 'LK_' || CAST(req_tx_ref AS VARCHAR) || '_' || strftime(req_date, '%Y%m%d') || 'T' || replace(req_time, ':', ''), CAST(CAST(req_date AS VARCHAR) || ' ' || req_time AS TIMESTAMP), 'apm', req_store, req_type, '', amount_cents, 'NONE'
 FROM apm_txn WHERE req_type IN ('N', 'N-', 'P', 'R') AND amount_cents <> 0
UNION ALL SELECT 'CY_' || CAST(a.tran_uid AS VARCHAR) || '_' || a.transaction_type || '_' || strftime(strptime(CAST(a.transaction_timestamp AS VARCHAR), '%Y%m%d%H%M%S'), '%Y%m%dT%H%M%S'), strptime(CAST(a.transaction_timestamp AS VARCHAR), '%Y%m%d%H%M%S'), 'acquirer',
 left(coalesce(a.terminal_id, k.value), 10), a.transaction_type, 'CY', a.transaction_amount, a.scheme FROM acquirer_txn a LEFT JOIN key_value k ON k.attribute = 'merchant-terminal' AND upper(trim(k.key)) = a.merchant_id
 WHERE coalesce(a.transaction_approval_status, 0) = 0 AND a.transaction_amount <> 0
UNION ALL SELECT 'TC_' || t.tran_uid, date_trunc('second', t.tstamp_trans), 'switch', left(t.net_term_id, 10), upper(y.abbr), 'TC', t.transaction_total * c.settlement_amount_flag * c.spend_factor, coalesce({_SCHEME}, 'NONE')
 FROM switch_txn t JOIN tran_type y ON CAST(y.dn_tran_code AS INT) = CAST(t.tran_type_id AS INT) JOIN response_code r ON r.action_code = t.act_code AND r.approval_flag = 'Y'
 JOIN type_code c ON c.tran_type_desc = {_KIND} AND c.settlement_amount_flag <> 0 AND c.spend_factor <> 0 WHERE t.transaction_total <> 0 OR t.surcharge_amount <> 0
UNION ALL SELECT 'ED_' || t.retrieval_ref_num || '_' || t.pan || '_' || strftime(t.local_timestamp, '%Y%m%dT%H%M%S'), date_trunc('second', t.local_timestamp), 'edp', left(t.card_acceptor_terminal_id, 10), c.tran_type_desc, 'EDP', abs(t.amount_txn) * c.settlement_amount_flag * c.spend_factor, 'NONE'
 FROM edp_txn t JOIN tran_type y ON CAST(y.dn_tran_code AS INT) = CAST(t.txn_type_indicator AS INT) JOIN type_code c ON c.tran_type_desc = upper(y.abbr) || CASE WHEN t.mti = '1440' THEN ' REVERSAL' ELSE '' END AND c.settlement_amount_flag <> 0 AND c.spend_factor <> 0
 WHERE CAST(t.action_code AS INT) IN (SELECT CAST(action_code AS INT) FROM response_code) AND t.txn_disposition = 1 AND t.local_timestamp IS NOT NULL AND t.amount_txn <> 0),
live AS (SELECT * FROM src WHERE coalesce(store_id, '') <> ''), one AS (SELECT * FROM live WHERE uid NOT IN (SELECT uid FROM live GROUP BY uid HAVING count(*) > 1))"""
_PRE = f"""{_SOURCES},
pre AS (SELECT o.uid, upper(m.state) AS state, upper(coalesce(m.site_name, '')) || CASE WHEN coalesce(m.site_name, '') = '' OR coalesce(m.suburb, '') = '' THEN '' ELSE ',' END || upper(m.suburb) AS area, m.division, w.file_prefix, o.store_id, f.record_type, o.fn, o.ts,
 CASE WHEN upper(m.is_online) = 'ONLINE' THEN 'Y' ELSE 'N' END AS eft, CASE WHEN left(o.uid, 2) IN ('TC', 'ED') THEN o.a ELSE abs(o.a) * f.settlement_factor END AS a
FROM one o JOIN store m ON m.store_id = o.store_id AND NOT m.is_closed JOIN settlement_window w ON w.division = m.division AND w.is_active = 'Y'
JOIN sap_map s ON s.store_number = o.store_id AND s.active_flag <> 'N' AND coalesce(s.company_code, '') <> ''
LEFT JOIN factor f ON f.settlement_factor <> 0 AND f.transaction_type = o.kind AND f.tran_qualifier = CASE WHEN left(o.uid, 2) = 'QC' THEN w.division_type ELSE o.q END
LEFT JOIN window_by_store b ON b.store_id = o.store_id LEFT JOIN settlement_std d ON d.tran_uid = o.uid
WHERE (left(o.uid, 2) IN ('TC', 'ED') OR f.settlement_factor IS NOT NULL) AND strpos(coalesce(s.exclude_issuers, ''), o.issuer) = 0 AND d.tran_uid IS NULL AND (w.settle_by_store <> 'Y' OR b.store_id IS NOT NULL)
AND o.ts > CASE WHEN b.store_id IS NULL OR w.settle_by_store = 'N' THEN CASE WHEN w.last_execution_time IS NULL THEN TIMESTAMP '1900-01-01' ELSE CAST(CAST(w.last_execution_time AS DATE) + w.days_lookback AS TIMESTAMP) END
 ELSE CAST(CAST(b.last_execution_time AS DATE) + b.days_lookback AS TIMESTAMP) END
AND o.ts >= CASE WHEN b.store_id IS NULL OR w.settle_by_store = 'N' THEN CAST(w.earliest_date AS TIMESTAMP) ELSE CAST(b.earliest_date AS TIMESTAMP) END AND o.ts < TIMESTAMP '2001-07-15')"""


def _sources(t: Tables):
    w = STORE_WIDTH
    return [
        P.gift_source(t.gift_txn, t.settlement_window, w),
        P.wallet_source(t.wallet_txn, w),
        P.apm_source(t.apm_txn),
        P.acquirer_source(t.acquirer_txn, t.key_value, w),
        P.switch_source(t.switch_txn, t.tran_type, t.response_code, t.type_code, w),
        P.edp_source(t.edp_txn, t.tran_type, t.response_code, t.type_code, w),
    ]


def _pre(t: Tables):
    return P.pre_settlement(P.combined(_sources(t)), t.store, t.settlement_window, t.window_by_store, t.sap_map, t.factor, t.settlement_std, RUN_DATE)


@query(
    "m_pre_settlement",
    f"WITH {_PRE} SELECT uid AS tran_uid, state, area AS business_area, division, file_prefix, store_id, record_type, fn AS filename, CAST(ts AS VARCHAR) AS transaction_time, eft AS eft_flag, CAST(a AS BIGINT) AS amount_cents, 0 AS discount_cents FROM pre",
)
def _pre_settlement(t: Tables):
    return _pre(t)


@query(
    "m_pre_settlement_file",
    f"""WITH {_PRE}, d AS (SELECT file_prefix, store_id, sum(a) AS a FROM pre GROUP BY ALL), p AS (SELECT DISTINCT file_prefix FROM settlement_window)
SELECT file_prefix || '_Presettlement_APM_20010714' AS file_name, file_prefix AS merchant, 'H' AS record_type, 0 AS line_rank, 'store_id' AS store_id, 'amount_in_dollar' AS amount_in_dollar FROM p
UNION ALL SELECT file_prefix || '_Presettlement_APM_20010714', file_prefix, 'D', 1, store_id, CAST(CAST(CAST(a AS DECIMAL(20,0)) / 100 AS DECIMAL(20,2)) AS VARCHAR) FROM d
UNION ALL SELECT p.file_prefix || '_Presettlement_APM_20010714', p.file_prefix, 'T', 2, CAST(count(d.store_id) AS VARCHAR), NULL FROM p LEFT JOIN d ON d.file_prefix = p.file_prefix GROUP BY p.file_prefix""",
)
def _pre_file(t: Tables):
    return P.pre_settlement_file(_pre(t), t.settlement_window, RUN_DATE)


_FEE = "CASE WHEN {flag} = 'N' THEN 0 ELSE CAST(round((s.settlement_cents + s.discount_cents) * m.bp / 100.0 + m.fx * 10000) AS BIGINT) END"
_FLAG = "CASE WHEN coalesce(w.commission_store, '') = '' THEN 'N' WHEN s.transaction_type LIKE '%REVERSAL%' THEN 'Y' WHEN s.transaction_type LIKE '%REFUND%' THEN 'N' ELSE 'Y' END"
_MAP = "mp AS (SELECT *, CAST(round(coalesce(CAST(commission_percent AS DOUBLE), 0) * 100) AS BIGINT) AS bp, coalesce(CAST(commission_fixed AS DOUBLE), 0) AS fx FROM sap_map WHERE active_flag <> 'N')"
_SEQ = "co AS (SELECT company_code, row_number() OVER (ORDER BY company_code) - 1 AS seq FROM (SELECT DISTINCT company_code FROM sap_map WHERE active_flag <> 'N'))"
_NAME = "'{p}_' || strftime(TIMESTAMP '2001-07-15 06:30:00' + to_seconds(co.seq), '%Y%m%d%H%M%S')"
_LEDGER = f"""{_MAP}, {_SEQ},
dtl AS (SELECT {_NAME.format(p='LEDGER')} AS file_name, m.company_code, s.record_type AS kind, CAST(s.transaction_timestamp AS DATE) AS day, CASE WHEN coalesce(s.order_number, '') <> '' AND w.division_type = 'INTERNAL' THEN s.order_number END AS order_ref,
 m.merchant_organisation_id AS org, m.merchant_store_number AS store_no, m.customer_number AS customer, s.store_id, m.currency_code AS currency, c.merchant_organisation_id AS org_c, c.merchant_store_number AS store_no_c, c.customer_number AS customer_c, w.commission_store, c.currency_code AS currency_c,
 (s.settlement_cents + s.discount_cents) * 100 AS amt, {_FEE.format(flag=_FLAG)} AS fee
 FROM settlement_std s JOIN store d ON d.store_id = s.store_id JOIN settlement_window w ON w.division = d.division JOIN mp m ON m.store_number = s.store_id LEFT JOIN mp c ON c.store_number = w.commission_store JOIN co ON co.company_code = m.company_code
 WHERE s.setlmnt_result_file IS NULL AND s.tran_uid NOT LIKE 'QP%'),
lines AS (SELECT file_name, company_code, kind, 'settlement' AS line, org, store_no, customer, store_id AS location, currency, day, order_ref, CAST(round(sum(amt - fee) / 100.0) AS BIGINT) AS cents FROM dtl GROUP BY ALL HAVING sum(amt - fee) <> 0
 UNION ALL SELECT file_name, company_code, kind, 'commission', org_c, store_no_c, customer_c, commission_store, currency_c, day, order_ref, CAST(round(sum(fee) / 100.0) AS BIGINT) FROM dtl GROUP BY ALL HAVING sum(fee) <> 0)"""


def _lines(t: Tables):
    return P.ledger_lines(P.ledger_detail(t.settlement_std, t.store, t.settlement_window, t.sap_map, RUN_TS))


@query(
    "m_ledger_settlement_lines",
    f"WITH {_LEDGER} SELECT file_name, company_code, kind, line, org, store_no, customer, location, currency, CAST(day AS VARCHAR) AS day, order_ref, cents AS amount_cents FROM lines",
)
def _ledger_lines(t: Tables):
    return _lines(t)


_FILE_COLUMNS = ["kind", "line", "org", "store_no", "customer", "location", "currency", "day", "order_ref"]


@query(
    "m_ledger_settlement_file",
    f"""WITH {_LEDGER}, c2 AS (SELECT co.company_code, {_NAME.format(p='LEDGER')} AS file_name, 'ledgersettlement' || CASE co.company_code WHEN '1410' THEN 'aus' WHEN '2025' THEN 'nzl' ELSE 'oth' END || co.company_code AS merchant FROM co)
SELECT 'D' AS record_type, 1 AS line_rank, l.file_name, c2.merchant, l.company_code, kind, line, org, store_no, customer, location, currency, CAST(day AS VARCHAR) AS day, order_ref, l.cents AS amount_cents, CAST(NULL AS BIGINT) AS line_count FROM lines l JOIN c2 ON c2.company_code = l.company_code
 UNION ALL BY NAME SELECT 'H' AS record_type, 0 AS line_rank, file_name, merchant, company_code FROM c2
 UNION ALL BY NAME SELECT 'T' AS record_type, 2 AS line_rank, c2.file_name, c2.merchant, c2.company_code, CAST(coalesce(sum(l.cents), 0) AS BIGINT) AS amount_cents, count(l.file_name) AS line_count FROM c2 LEFT JOIN lines l ON l.file_name = c2.file_name GROUP BY ALL""",
)
def _ledger_file(t: Tables):
    return P.ledger_file(_lines(t), t.sap_map, RUN_TS)


@query(
    "m_partner_rows",
    f"""WITH q AS (SELECT *, {_UID_QP} AS uid FROM partner_txn WHERE amount_cents <> 0 OR discount_cents <> 0),
f AS (SELECT * FROM q WHERE uid NOT IN (SELECT tran_uid FROM settlement_std) QUALIFY row_number() OVER (PARTITION BY uid ORDER BY load_time, amount_cents, discount_cents, store_id, merchant, line_no) = 1)
SELECT f.uid AS tran_uid, CAST(coalesce(f.transaction_date, TIMESTAMP '1900-01-01') AS VARCHAR) AS transaction_timestamp, f.store_id, m.division, CASE WHEN upper(m.is_online) = 'ONLINE' THEN trim(f.invoice_number) ELSE '' END AS order_number,
 abs(f.amount_cents) * x.settlement_factor AS settlement_cents, x.record_type, -abs(f.discount_cents) * x.settlement_factor AS discount_cents
FROM f JOIN store m ON m.store_id = f.store_id AND NOT m.is_closed JOIN settlement_window w ON w.division = m.division AND w.is_active = 'Y' JOIN sap_map s ON s.store_number = f.store_id AND s.active_flag <> 'N'
JOIN factor x ON x.tran_qualifier = 'QP' AND x.transaction_type = f.transaction_type
WHERE coalesce(f.transaction_date, TIMESTAMP '1900-01-01') > CASE WHEN w.last_execution_time IS NULL THEN TIMESTAMP '1900-01-01' ELSE CAST(CAST(w.last_execution_time AS DATE) + w.days_lookback AS TIMESTAMP) END
AND coalesce(f.transaction_date, TIMESTAMP '1900-01-01') >= CAST(w.earliest_date AS TIMESTAMP) AND coalesce(f.transaction_date, TIMESTAMP '1900-01-01') <= CAST(DATE '2001-07-15' + w.day_lag AS TIMESTAMP) + to_minutes(CAST(w.settlement_cutoff // 100 * 60 + w.settlement_cutoff % 100 AS INT))""",
)
def _partner_rows(t: Tables):
    return P.partner_rows(t.partner_txn, t.store, t.settlement_window, t.sap_map, t.factor, t.settlement_std, RUN_DATE)


_UID_LK = "'LK_' || CAST(req_tx_ref AS VARCHAR) || '_' || strftime(req_date, '%Y%m%d') || 'T' || replace(req_time, ':', '')"


@query(
    "m_wallet_rows",
    f"""WITH a AS (SELECT {_UID_LK} AS uid, CAST(CAST(req_date AS VARCHAR) || ' ' || req_time AS TIMESTAMP) AS ts, * FROM apm_txn WHERE req_type IN ('N', 'N-', 'P', 'R') AND amount_cents <> 0)
SELECT a.uid AS tran_uid, CAST(a.ts AS VARCHAR) AS transaction_timestamp, a.req_store AS store_id, m.division, abs(a.amount_cents) * f.settlement_factor AS settlement_cents, f.record_type FROM a JOIN store m ON m.store_id = a.req_store AND NOT m.is_closed
JOIN settlement_window w ON w.division = m.division AND w.is_active = 'Y' JOIN factor f ON f.tran_qualifier = '' AND f.settlement_factor <> 0 AND f.transaction_type = a.req_type JOIN sap_map s ON s.store_number = a.req_store AND s.active_flag <> 'N'
WHERE a.uid NOT IN (SELECT tran_uid FROM settlement_std) AND m.division NOT IN (SELECT division FROM store WHERE site_name IS NULL AND division <> '') AND a.ts > coalesce(w.last_execution_time, TIMESTAMP '1900-01-01')
AND a.ts <= CAST(DATE '2001-07-15' + w.day_lag AS TIMESTAMP) + to_minutes(CAST(w.settlement_cutoff // 100 * 60 + w.settlement_cutoff % 100 AS INT))""",
)
def _wallet_rows(t: Tables):
    findings = t.store.where(col("site_name").isNull() & (col("division") != "")).select("division", F.lit("Store not found").alias("message"))
    return P.wallet_rows(t.apm_txn, t.store, t.settlement_window, t.sap_map, t.factor, t.settlement_std, findings, RUN_DATE)


_DAY = dt.date(2000, 6, 15)


@query(
    "m_transaction_listing",
    f"""WITH i AS (SELECT 'SCDR|' || scdr_token AS card_id, max(pymt_acct_ref) AS par, max('AL' || scdr_token) AS pan_alias FROM switch_txn WHERE card_type = 'C' AND scdr_token IS NOT NULL GROUP BY 1),
r AS (SELECT t.*, y.abbr, c.approval_flag, m.store_id, m.is_online, w.file_prefix FROM switch_txn t JOIN response_code c ON c.action_code = t.act_code AND c.action_code <> '902' JOIN tran_type y ON CAST(y.dn_tran_code AS INT) = CAST(t.tran_type_id AS INT)
 JOIN store m ON m.store_id = left(t.net_term_id, 10) JOIN settlement_window w ON w.division = m.division WHERE CAST(t.tstamp_local AS DATE) = DATE '{_DAY}' AND t.net_term_id <> ''
 QUALIFY row_number() OVER (PARTITION BY t.tran_uid ORDER BY m.store_id, t.transaction_total, t.masked_pan, t.tstamp_local, t.act_code) = 1)
SELECT t.file_prefix || '_Txn_Listing_20000615' AS file_name, t.file_prefix AS merchant, 'D' AS record_type, 'TC_' || t.tran_uid AS transaction_uid, t.store_id, t.net_term_id AS terminal_id, CAST(t.transaction_total AS VARCHAR) AS transaction_amt, strftime(t.tstamp_trans, '%Y%m%d%H%M%S') AS transaction_timestamp,
 CASE WHEN length(t.masked_pan) < 10 THEN t.masked_pan ELSE left(t.masked_pan, 6) || '******' || right(t.masked_pan, 4) END AS pan, t.mti, CAST(t.purchase_total AS VARCHAR) AS sale_amt, CAST(t.cashout_total AS VARCHAR) AS cashout_amt, upper(t.abbr) AS transaction_type_desc, {_SCHEME} AS scheme,
 CASE t.card_type WHEN 'C' THEN 'CREDIT' ELSE 'DEBIT' END AS card_type, CASE t.approval_flag WHEN 'Y' THEN '1' ELSE '0' END AS approval_status, CASE WHEN upper(t.is_online) = 'ONLINE' THEN t.order_number ELSE '' END AS order_num, upper(coalesce(s.merchant_store_number, '')) AS merchant_store_id,
 coalesce(i.par, t.pymt_acct_ref) AS par, coalesce(i.pan_alias, t.scdr_token) AS pan_alias FROM r t LEFT JOIN i ON i.card_id = 'SCDR|' || t.scdr_token LEFT JOIN sap_map s ON s.store_number = t.store_id""",
)
def _listing(t: Tables):
    from ledgerloom.functions import cards as K

    known = t.switch_txn.where((col("card_type") == "C") & col("scdr_token").isNotNull())
    identity = known.select(K.card_id(token=col("scdr_token")).alias("card_id"), col("pymt_acct_ref").alias("par"), F.concat(F.lit("AL"), col("scdr_token")).alias("pan_alias"))
    return P.transaction_listing(t.switch_txn, t.tran_type, t.response_code, t.store, t.settlement_window, t.sap_map, identity, _DAY, STORE_WIDTH)


_POST = f"""{_SEQ}, p AS (SELECT {_NAME.format(p='FEES')} AS file_name, m.company_code, m.merchant_organisation_id, m.merchant_store_number, d.site_name, m.customer_number, s.store_id, m.currency_code, CAST(s.transaction_timestamp AS DATE) AS calendar_date,
 sum(s.settlement_cents + s.discount_cents) AS net, sum(s.discount_cents) AS disc, count(*) AS record_count FROM settlement_std s JOIN store d ON d.store_id = s.store_id AND NOT d.is_closed JOIN sap_map m ON m.store_number = s.store_id AND m.active_flag <> 'N' JOIN co ON co.company_code = m.company_code
 WHERE s.setlmnt_result_file IS NULL AND s.tran_uid LIKE 'QP%' GROUP BY ALL),
x AS (SELECT * EXCLUDE (net, disc), 'GCNETRECOVERY' AS fee_type, CAST(net AS BIGINT) AS fee_value FROM p UNION ALL SELECT * EXCLUDE (net, disc), 'GCPARTNERDISC', CAST(disc AS BIGINT) FROM p)"""


@query(
    "m_partner_posting",
    f"""WITH {_POST}, {CALENDAR_SQL} SELECT x.* REPLACE (CAST(x.calendar_date AS VARCHAR) AS calendar_date), strftime(fp_end_date + 5, '%Y%m%d') AS pay_due_date, 'WEEKLY' AS frequency FROM x LEFT JOIN calendar c ON c.calendar_date = x.calendar_date""",
)
def _posting(t: Tables):
    return P.partner_posting(t.settlement_std, t.store, t.sap_map, t.calendar, RUN_TS)


@query(
    "m_partner_posting_file",
    f"""WITH {_POST}, {CALENDAR_SQL}, c2 AS (SELECT company_code, {_NAME.format(p='FEES')} AS file_name, 'partnerfeeposting' || CASE company_code WHEN '1410' THEN 'aus' WHEN '2025' THEN 'nzl' ELSE 'oth' END || company_code AS merchant FROM co)
SELECT 'D' AS record_type, 1 AS line_rank, x.* REPLACE (CAST(x.calendar_date AS VARCHAR) AS calendar_date), c2.merchant, strftime(fp_end_date + 5, '%Y%m%d') AS pay_due_date, 'WEEKLY' AS frequency, CAST(NULL AS BIGINT) AS line_count FROM x JOIN c2 ON c2.company_code = x.company_code LEFT JOIN calendar c ON c.calendar_date = x.calendar_date
 UNION ALL BY NAME SELECT 'H' AS record_type, 0 AS line_rank, file_name, merchant, company_code FROM c2
 UNION ALL BY NAME SELECT 'T' AS record_type, 2 AS line_rank, file_name, merchant, company_code, CAST(coalesce((SELECT sum(fee_value) FROM x WHERE x.company_code = c2.company_code), 0) AS BIGINT) AS fee_value, (SELECT count(*) FROM x WHERE x.company_code = c2.company_code) AS line_count FROM c2""",
)
def _posting_file(t: Tables):
    return P.partner_posting_file(P.partner_posting(t.settlement_std, t.store, t.sap_map, t.calendar, RUN_TS), t.sap_map, RUN_TS)


@query(
    "m_commission_listing",
    f"""WITH {_MAP}, d AS (SELECT w.file_prefix AS merchant, s.tran_uid, CAST(CAST(round({_FEE.format(flag=_FLAG)} / 100.0) AS BIGINT) AS VARCHAR) AS commission_amt FROM settlement_std s JOIN store x ON x.store_id = s.store_id
 JOIN settlement_window w ON w.division = x.division AND w.commission_store <> '' JOIN mp m ON m.store_number = s.store_id AND (m.commission_percent IS NOT NULL OR m.commission_fixed IS NOT NULL) WHERE s.setlmnt_result_file <> '')
SELECT merchant, 'H' AS record_type, 0 AS line_rank, 'tran_uid' AS tran_uid, 'commission_amt' AS commission_amt FROM d GROUP BY merchant UNION ALL SELECT merchant, 'D', 1, tran_uid, commission_amt FROM d UNION ALL SELECT merchant, 'T', 2, CAST(count(*) AS VARCHAR), NULL FROM d GROUP BY merchant""",
)
def _commission(t: Tables):
    return P.commission_listing(t.settlement_std, t.store, t.settlement_window, t.sap_map)


@query(
    "m_payout_instructions",
    f"""WITH {_LEDGER} SELECT d.division, l.location || strftime(l.day, '%Y%m%d') || '2001-07-15T06:30:00' AS merchant_payment_uid, CAST(sum(l.cents) AS BIGINT) AS amount, l.file_name AS batch_name, '2001-07-15 06:30:00' AS batch_datetime, '2001-07-16 00:00:00' AS payment_initiated_at
 FROM lines l JOIN store d ON d.store_id = l.location JOIN settlement_window w ON w.division = d.division AND w.division_type = 'ISO' WHERE l.location IS DISTINCT FROM w.commission_store GROUP BY d.division, l.location, l.day, l.file_name""",
)
def _payouts(t: Tables):
    return P.payout_instructions(_lines(t), t.store, t.settlement_window, RUN_TS)


_LOGGED = f"""{_SOURCES}, every AS (SELECT uid, ts, store_id, kind, q, a FROM live
 UNION ALL SELECT {_UID_QP}, coalesce(transaction_date, TIMESTAMP '1900-01-01'), store_id, transaction_type, 'QP', amount_cents FROM partner_txn WHERE amount_cents <> 0 OR discount_cents <> 0),
due AS (SELECT o.*, left(o.uid, 2) AS ds, m.division, s.store_number, s.active_flag, s.company_code, w.division_type, w.settle_by_store, b.store_id AS own, f.settlement_factor,
 CASE WHEN b.store_id IS NULL OR w.settle_by_store = 'N' THEN {{w}} ELSE {{b}} END AS inside
 FROM every o JOIN store m ON m.store_id = o.store_id AND NOT m.is_closed JOIN settlement_window w ON w.division = m.division AND w.is_active = 'Y' LEFT JOIN window_by_store b ON b.store_id = o.store_id AND b.is_active = 'Y'
 JOIN log_flags g ON g.division = m.division AND g.data_source = left(o.uid, 2) LEFT JOIN sap_map s ON s.store_number = o.store_id
 LEFT JOIN factor f ON f.settlement_factor <> 0 AND f.transaction_type = o.kind AND f.tran_qualifier = CASE WHEN left(o.uid, 2) = 'QC' THEN w.division_type ELSE o.q END
 WHERE o.uid NOT IN (SELECT tran_uid FROM settlement_std)),
kept AS (SELECT *, row_number() OVER (PARTITION BY uid ORDER BY ts, store_id, kind, a) AS copy FROM due WHERE inside AND (ds IN ('TC', 'ED') OR settlement_factor IS NOT NULL) AND (ds NOT IN ('QC', 'TC') OR division_type <> 'PARTNER')
 AND (ds <> 'TC' OR settle_by_store = 'N' OR own IS NOT NULL) AND (ds <> 'QC' OR (active_flag <> 'N' AND coalesce(trim(company_code), '') <> '')))"""
_INSIDE = """(o.ts > coalesce(CAST(CAST({t}.last_execution_time AS DATE) + {t}.days_lookback AS TIMESTAMP), TIMESTAMP '1900-01-01') AND o.ts >= CAST({t}.earliest_date AS TIMESTAMP)
 AND o.ts <= CAST(DATE '2001-07-15' + {t}.day_lag AS TIMESTAMP) + to_minutes(CAST({t}.settlement_cutoff // 100 * 60 + {t}.settlement_cutoff % 100 AS INT)))"""


@query(
    "m_missing_store_report",
    f"""WITH {_LOGGED.format(w=_INSIDE.format(t='w'), b=_INSIDE.format(t='b'))}
SELECT DISTINCT 'B9' AS batch_number, store_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS tran_date, message, ds AS data_source, division, CAST(ts AS VARCHAR) AS transaction_time, '2001-07-15 06:30:00' AS created
FROM (SELECT *, CASE WHEN copy > 1 THEN 'Duplicate transaction ' || uid || ' ' ELSE '' END || CASE WHEN store_number IS NULL THEN 'Store is missing in settlement mapping' WHEN coalesce(active_flag, 'N') = 'N' THEN 'Store not active in settlement mapping'
 WHEN coalesce(trim(company_code), '') = '' THEN 'Company code is missing in settlement mapping' ELSE '' END AS message FROM kept) WHERE message <> ''""",
)
def _missing(t: Tables):
    from ledgerloom.plans import missing_store as N

    trans = P.combined([*_sources(t), P.partner_source(t.partner_txn)])
    return N.report(trans, t.store, t.settlement_window, t.window_by_store, t.sap_map, t.factor, t.log_flags, t.settlement_std, "B9", RUN_TS, kept)
