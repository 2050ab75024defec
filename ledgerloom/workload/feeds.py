"""Payment-shaped feeds projected from the given tables.

The pipelines in ``ledgerloom.plans`` expect switch, gift-card, wallet, acquirer, chargeback
and nested order feeds.  The given tables hold none of these, so each feed is a projection of
a whole given table (never a subset), written once in SQL that Spark and the checking engine
both read.  ``{{secs:x}}`` is the one dialect-dependent piece: an interval of x seconds.
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.sources.tables import fiscal_calendar

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# the run the workload pretends to be in
RUN_DATE = dt.date(2001, 7, 15)
RUN_TS = dt.datetime(2001, 7, 15, 6, 30, 0)
BASELINE_FROM = dt.date(2001, 2, 1)
STORE_WIDTH = 10
SITE_DIVISIONS = ("NATION_1", "NATION_2")

_STORE_KEY = "concat('S', lpad(cast({k} as string), 9, '0'))"


def _store(k: str) -> str:
    return _STORE_KEY.format(k=k)


_LINE_SECS = "(l_orderkey * 7919 + l_linenumber * 104729 + l_partkey * 31) % 86400"
_ORDER_SECS = "(o_orderkey * 7919 + o_custkey * 31) % 86400"

_RATE_PERIODS = [
    ("DATE '1995-01-01'", "DATE '1997-12-31'"),
    ("DATE '1998-01-01'", "DATE '2000-06-30'"),
    ("DATE '2000-07-01'", "CAST(NULL AS DATE)"),
]


def _rate(card: str, k: int, start: str, end: str) -> str:
    return f"""
SELECT r_name AS merchant, '{card}' AS card_type, {start} AS from_date, {end} AS to_date,
       CASE (r_regionkey + {k}) % 4 WHEN 0 THEN 'ALL' WHEN 1 THEN 'FIXED' WHEN 2 THEN 'PERCENT' ELSE 'NONE' END AS proc_fee_code,
       1.5 + r_regionkey AS proc_fee_percent, 0.25 * {k + 1} AS proc_fee_fixed
FROM region"""


FEED_SQL: dict[str, str] = {
    # one row per supplier
    "store": f"""
SELECT {_store('s_suppkey')} AS store_id,
       CASE WHEN s_suppkey % 17 = 16 THEN '' ELSE n_name END AS division,
       CASE WHEN s_suppkey % 13 = 12 THEN NULL ELSE s_name END AS site_name,
       concat('SUB', cast(s_suppkey % 40 as string)) AS suburb,
       r_name AS state,
       concat('C', cast(n_regionkey as string)) AS company,
       concat('BRAND', cast(s_suppkey % 7 as string)) AS brand,
       concat('IG', cast(n_nationkey as string)) AS invoice_group,
       concat('MG', cast(n_regionkey as string)) AS merchant_group,
       CASE WHEN s_suppkey % 5 = 0 THEN 'Online' ELSE 'Not Online' END AS is_online,
       concat('5', lpad(cast(s_suppkey % 9 as string), 3, '0')) AS mcc_code,
       r_name AS ratecard_group,
       s_suppkey % 29 = 28 AS is_closed,
       -10.0 - cast((s_suppkey * 7) % 3000 as double) / 100 AS latitude,
       115.0 + cast((s_suppkey * 13) % 3500 as double) / 100 AS longitude
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    # one row per line item, repeats of (order, line) are repeated transaction ids
    "switch_txn": f"""
SELECT cast(l_shipdate + INTERVAL 1 DAY as date) AS file_date,
       l_shipdate + INTERVAL 1 DAY AS load_time,
       concat(cast(l_orderkey as string), '-', cast(l_linenumber as string)) AS tran_uid,
       l_shipdate + {{{{secs:{_LINE_SECS}}}}} AS tstamp_trans,
       l_shipdate + {{{{secs:{_LINE_SECS}}}}} AS tstamp_local,
       CASE WHEN l_partkey % 37 = 36 THEN '' ELSE concat({_store('l_suppkey')}, lpad(cast(l_linenumber as string), 3, '0')) END AS net_term_id,
       CASE WHEN l_partkey % 101 = 0 THEN '45678' ELSE concat('4', lpad(cast(l_partkey as string), 14, '5')) END AS masked_pan,
       CASE WHEN l_partkey % 53 = 52 THEN NULL ELSE concat('TK', cast(l_partkey as string)) END AS scdr_token,
       concat('PAR', cast(l_partkey % 1000 as string)) AS pymt_acct_ref,
       CASE l_partkey % 8 WHEN 0 THEN 'AMEX' WHEN 1 THEN 'EHB' WHEN 2 THEN 'FDF' WHEN 3 THEN 'FDI'
            WHEN 4 THEN 'RED' WHEN 5 THEN 'ANZ' WHEN 6 THEN 'VDCS' ELSE 'MC' END AS proc_id_iss_b,
       concat('I', cast(l_suppkey % 3 as string)) AS inst_id_recon_iss,
       CASE WHEN l_partkey % 2 = 0 THEN 'C' ELSE 'D' END AS card_type,
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN '1440' ELSE '1240' END AS mti,
       CASE l_linenumber WHEN 2 THEN '09' WHEN 3 THEN '20' WHEN 4 THEN '01' WHEN 5 THEN '31' ELSE '00' END AS tran_type_id,
       CASE WHEN cast(l_quantity as bigint) % 11 = 0 THEN '051' ELSE '000' END AS act_code,
       cast(round(l_extendedprice * 100) as bigint) AS transaction_total,
       cast(round(l_extendedprice * 100) as bigint) AS amt_recon_net,
       CASE WHEN l_linenumber IN (1, 2, 6) THEN cast(round(l_extendedprice * 100) as bigint) ELSE 0 END AS purchase_total,
       CASE WHEN l_linenumber = 2 THEN cast(l_quantity as bigint) * 100 ELSE 0 END AS cashout_total,
       cast(round(l_tax * 10000) as bigint) AS surcharge_amount,
       cast(round(l_extendedprice * l_discount * 10) as bigint) AS interchange_fee,
       CASE WHEN l_linenumber = 7 THEN 0 ELSE 5 END AS processing_fees,
       CASE WHEN l_linestatus = 'F' THEN '0' ELSE '1' END AS pos_crdhldr_presnt,
       CASE cast(l_quantity as bigint) % 6 WHEN 0 THEN '6' WHEN 1 THEN 'B' WHEN 2 THEN 'C' ELSE '5' END AS pos_crd_dat_in_mod,
       cast(l_orderkey as string) AS order_number
FROM lineitem""",
    "gift_txn": f"""
SELECT concat('60', lpad(cast(l_partkey as string), 12, '7')) AS card_number,
       concat('MERCH', cast(l_suppkey % 11 as string)) AS merchant,
       {_store('l_suppkey')} AS outlet_code,
       concat('PG', cast(l_partkey % 5 as string)) AS program_group,
       CASE WHEN cast(l_quantity as bigint) = 7 THEN NULL ELSE cast(l_shipdate as date) END AS transaction_date,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE concat(lpad(cast(l_orderkey % 24 as string), 2, '0'), ':', lpad(cast(l_partkey % 60 as string), 2, '0'), ':00') END AS transaction_time,
       CASE l_linenumber % 3 WHEN 0 THEN 'GIFT CARD ACTIVATE' WHEN 1 THEN 'GIFT CARD REDEEM' ELSE 'GIFT CARD RELOAD' END AS transaction_type,
       CASE WHEN l_returnflag = 'R' THEN 'FAILED' ELSE 'SUCCESS' END AS transaction_status,
       concat('A', cast(l_orderkey % 9000 as string)) AS approval_code,
       cast(l_orderkey as string) AS reference_number,
       cast(l_linenumber as bigint) AS batch_number,
       concat('INV', cast(l_orderkey as string)) AS invoice_number,
       cast(round(l_extendedprice * 100) as bigint) AS amount_cents,
       cast(round(l_extendedprice * l_discount * 100) as bigint) AS discount_cents
FROM lineitem""",
    # a card's life: sales, reissues, redemptions and their cancellations, one event a line item
    "gift_events": f"""
SELECT concat('60', lpad(cast(l_partkey as string), 12, '7')) AS card_number,
       concat('MERCH', cast(l_suppkey % 11 as string)) AS merchant,
       {_store('l_suppkey')} AS outlet_code,
       {_store('l_suppkey')} AS activation_store,
       CASE WHEN l_suppkey % 3 = 0 THEN 'SAP Hybris' ELSE concat('Outlet ', cast(l_suppkey as string)) END AS activation_location,
       concat('PG', cast(l_partkey % 5 as string)) AS program_group,
       concat('D', cast(l_partkey % 9 as string)) AS design_code,
       cast(l_shipdate as date) AS transaction_date,
       cast(l_orderkey * 10 + l_linenumber as bigint) AS event_no,
       CASE l_linenumber WHEN 1 THEN 'GIFT CARD REDEEM' WHEN 2 THEN 'GIFT CARD RELOAD' WHEN 4 THEN 'GIFT CARD CANCEL REDEEM' WHEN 5 THEN 'GIFT CARD REISSUE' WHEN 7 THEN 'GIFT CARD CANCEL ACTIVATE' ELSE 'GIFT CARD ACTIVATE' END AS transaction_type,
       concat('INV', cast(l_orderkey as string)) AS invoice_number,
       concat('SAP ORD-', lpad(cast(l_orderkey as string), 8, '0')) AS notes,
       CASE WHEN l_partkey % 31 = 0 THEN NULL ELSE CASE WHEN l_linenumber IN (1, 7) THEN -1 ELSE 1 END * cast(round(l_extendedprice * 100) as bigint) END AS amount_cents,
       CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE cast(round(l_tax * 1000) as bigint) END AS adjustment_cents,
       CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE cast(round(l_extendedprice * l_discount * 100) as bigint) END AS balance_cents
FROM lineitem""",
    "card_orders": """
SELECT lpad(cast(o_orderkey as string), 8, '0') AS order_no, concat('PAY', cast(o_orderkey % 3 as string)) AS payment_method, cast(o_orderdate as date) AS order_date,
       CASE WHEN o_custkey % 4 = 0 THEN NULL ELSE concat('UNIT', cast(o_custkey % 4 as string)) END AS b2b_unit, concat('T', cast(o_custkey % 2 as string)) AS user_type, concat('C', cast(o_custkey as string)) AS customer_id,
       concat('APP', cast(o_orderkey % 2 as string)) AS sales_application, cast(1 + o_orderkey % 4 as bigint) AS cards, cast(round(o_totalprice) as bigint) AS discount_cents
FROM orders""",
    "partner_txn": f"""
SELECT concat('MERCH', cast(l_suppkey % 11 as string)) AS merchant,
       {_store('l_suppkey')} AS store_id,
       CASE WHEN l_partkey % 41 = 0 THEN '12345' ELSE concat('60', lpad(cast(l_partkey as string), 12, '7')) END AS card_number,
       CASE WHEN l_partkey % 43 = 0 THEN NULL ELSE concat('INV', cast(l_orderkey as string)) END AS invoice_number,
       CASE WHEN l_returnflag = 'R' THEN 'CANCELLATION' ELSE 'ACTIVATION' END AS transaction_type,
       CASE WHEN l_partkey % 47 = 0 THEN NULL ELSE l_shipdate END AS transaction_date,
       l_shipdate + INTERVAL 1 DAY AS load_time,
       cast(l_linenumber as bigint) AS line_no,
       cast(round(l_extendedprice * 100) as bigint) AS amount_cents,
       cast(round(l_extendedprice * l_discount * 100) as bigint) AS discount_cents
FROM lineitem""",
    # the wallet's own activity: one row per line item
    "edp_txn": f"""
SELECT concat('R', cast(l_orderkey as string), '-', cast(l_linenumber as string)) AS retrieval_ref_num,
       concat('4', lpad(cast(l_partkey as string), 14, '5')) AS pan,
       concat({_store('l_suppkey')}, lpad(cast(l_linenumber as string), 3, '0')) AS card_acceptor_terminal_id,
       CASE WHEN l_partkey % 211 = 0 THEN NULL ELSE l_shipdate + {{{{secs:{_LINE_SECS}}}}} END AS local_timestamp,
       CASE l_linenumber WHEN 2 THEN '09' WHEN 3 THEN '20' WHEN 4 THEN '01' WHEN 5 THEN '31' WHEN 6 THEN '77' ELSE '00' END AS txn_type_indicator,
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN '1440' ELSE '1240' END AS mti,
       CASE cast(l_quantity as bigint) % 11 WHEN 0 THEN '51' WHEN 1 THEN '999' ELSE '0' END AS action_code,
       CASE WHEN l_returnflag = 'A' THEN 2 ELSE 1 END AS txn_disposition,
       cast(round(l_extendedprice * l_tax * 100) as bigint) AS amount_txn
FROM lineitem""",
    # which sources are logged for which division
    "log_flags": " UNION ALL ".join(
        f"SELECT division, '{source}' AS data_source FROM settlement_window WHERE {where}"
        for source, where in {"QC": "true", "DP": "true", "LK": "division_type <> 'ISO'", "ED": "true", "CY": "true", "TC": "true", "QP": "division_type = 'PARTNER'"}.items()
    ),
    # chargebacks of sales: the first line of the chargeback's order; some amounts differ by a cent
    "sale_chargebacks": f"""
SELECT c.id AS id, c.file_date AS file_date, {_store('l.l_suppkey')} AS store_id, cast(l.l_shipdate as date) AS txn_day,
       cast(round(l.l_extendedprice * 100) as bigint) + CASE WHEN c.id % 7 = 0 THEN 1 ELSE 0 END AS amount_cents
FROM chargebacks c JOIN lineitem l ON l.l_orderkey = c.id AND l.l_linenumber = 1""",
    "wallet_txn": f"""
SELECT CASE o_custkey % 3 WHEN 0 THEN cast(o_orderkey as string)
            WHEN 1 THEN concat(cast(o_orderkey as string), '.1')
            ELSE concat(cast(o_orderkey as string), '.1.2') END AS txn_ref,
       o_orderkey AS order_id,
       o_orderdate + {{{{secs:{_ORDER_SECS}}}}} AS txn_time,
       concat({_store('o_custkey % 90')}, '001') AS terminal_id,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'REFUND' ELSE 'PURCHASE' END AS transaction_type,
       CASE WHEN o_orderstatus = 'P' THEN 'QC' ELSE 'WEX' END AS gateway,
       cast(o_custkey as string) AS customer_ref,
       concat('CT', cast(o_custkey % 7 as string)) AS container_id,
       concat('IT', cast(o_orderkey % 5 as string)) AS item_id,
       CASE WHEN o_orderkey % 4 = 0 THEN 'VISA' ELSE 'MASTERCARD' END AS scheme_name,
       cast(round(o_totalprice * 100) as bigint) AS amount_cents
FROM orders""",
    "apm_txn": f"""
SELECT o_orderkey AS req_tx_ref,
       {_store('o_custkey % 100')} AS req_store,
       CASE o_orderkey % 5 WHEN 0 THEN 'N' WHEN 1 THEN 'P' WHEN 2 THEN 'R' WHEN 3 THEN 'N-' ELSE 'X' END AS req_type,
       cast(o_orderdate as date) AS req_date,
       lpad(cast(16 + o_orderkey % 4 as string), 2, '0') || ':' || CASE WHEN o_custkey % 3 = 0 THEN '00:00' WHEN o_custkey % 3 = 1 THEN '00:01' ELSE '59:59' END AS req_time,
       'TRANSACTION APPROVED' AS res_rt,
       cast(round(o_totalprice * 100) as bigint) AS amount_cents
FROM orders""",
    "apm_settlement": f"""
SELECT l_orderkey AS transaction_id, {_store('l_suppkey')} AS store_id, cast(l_shipdate as date) AS payment_date,
       cast(round(l_extendedprice * 100) as bigint) AS amount_cents
FROM lineitem""",
    "pos_tender": f"""
SELECT l_orderkey AS reference_number, {_store('l_suppkey')} AS site_number, cast(l_shipdate as date) AS business_date,
       CASE WHEN l_linenumber <= 3 THEN 'REDEEM' ELSE 'ACTIVATE' END AS tender_type,
       cast(round(l_extendedprice * (1 - l_discount) * 100) as bigint) AS tender_cents
FROM lineitem""",
    "acquirer_txn": f"""
SELECT o_orderkey AS tran_uid,
       cast(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) as bigint) * 1000000
         + (o_orderkey % 24) * 10000 + (o_custkey % 60) * 100 AS transaction_timestamp,
       cast(o_orderdate as date) AS file_date,
       CASE WHEN o_custkey % 19 = 18 THEN NULL ELSE concat({_store('o_custkey % 100')}, '001') END AS terminal_id,
       concat('MID', cast(o_custkey % 100 as string)) AS merchant_id,
       concat('4', lpad(cast(o_custkey as string), 11, '2')) AS pan,
       CASE WHEN o_orderkey % 2 = 0 THEN 'VISA' ELSE 'MASTERCARD' END AS scheme,
       CASE WHEN o_custkey % 3 = 0 THEN 'DEBIT' ELSE 'CREDIT' END AS card_type,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'REFUND' ELSE 'PURCHASE' END AS transaction_type,
       cast(round(o_totalprice * 100) as bigint) AS transaction_amount,
       CASE o_orderstatus WHEN 'P' THEN NULL WHEN 'F' THEN 0 ELSE 1 END AS transaction_approval_status
FROM orders""",
    # several loads per trace: the line number is the load day
    "scheme_fee": f"""
SELECT CASE WHEN l_linenumber = 6 THEN NULL ELSE l_orderkey END AS trace_id,
       l_shipdate AS load_time,
       concat({_store('l_suppkey')}, '001') AS term_id,
       cast(l_partkey % 100 as bigint) AS fee_code,
       cast(round(l_extendedprice * 100) as bigint) AS transaction_amt,
       cast(round(l_extendedprice * l_tax * 10000) as bigint) AS interchange_fee
FROM lineitem""",
    "chargebacks": f"""
SELECT cast(o_orderdate + INTERVAL 30 DAY as date) AS file_date,
       o_orderkey AS id,
       CASE WHEN o_custkey % 23 = 0 THEN 'NULL' ELSE concat('BR', cast(o_custkey * 4 + o_orderkey % 3 as string)) END AS bank_ref_no,
       {_store('o_custkey % 100')} AS store_id,
       CASE o_orderkey % 3 WHEN 0 THEN 'Visa' WHEN 1 THEN 'Mastercard' ELSE 'Other' END AS bank,
       concat('R', cast(o_orderkey % 12 as string)) AS reason,
       CASE WHEN o_orderstatus = 'F' THEN 'f' ELSE 't' END AS status_open,
       CASE o_orderkey % 4 WHEN 0 THEN 'PIN' WHEN 1 THEN 'SIG' WHEN 2 THEN 'CNP' ELSE 'NOVER' END AS signature,
       cast(round(o_totalprice * 100) as bigint) AS amount_cents,
       o_orderdate + INTERVAL 5 DAY AS received_dt,
       o_orderdate + {{{{secs:{_ORDER_SECS}}}}} AS txn_dttm_local,
       CASE WHEN o_orderkey % 5 IN (0, 1, 2) THEN o_orderdate + INTERVAL 7 DAY END AS rr_sent_dttm_utc,
       CASE WHEN o_orderkey % 5 IN (1, 2, 3) THEN o_orderdate + INTERVAL 12 DAY END AS response_dttm_utc,
       CASE WHEN o_orderkey % 7 IN (0, 3) THEN o_orderdate + INTERVAL 20 DAY END AS charged_dt,
       CASE WHEN o_orderkey % 6 IN (0, 1) THEN o_orderdate + INTERVAL 15 DAY END AS chgbk_challenge_dt,
       CASE WHEN o_orderkey % 11 IN (0, 4) THEN o_orderdate + INTERVAL 25 DAY END AS chgbk_rev_dt
FROM orders""",
    "sap_map": f"""
SELECT {_store('s_suppkey')} AS store_number,
       CASE s_nationkey % 3 WHEN 0 THEN '1410' WHEN 1 THEN '2025' ELSE '3300' END AS company_code,
       concat('CUST', cast(s_suppkey as string)) AS customer_number,
       concat('ORG', cast(s_nationkey as string)) AS merchant_organisation_id,
       concat('MS', cast(s_suppkey as string)) AS merchant_store_number,
       CASE WHEN s_suppkey % 19 = 18 THEN 'N' ELSE 'Y' END AS active_flag,
       CASE WHEN s_suppkey % 6 = 0 THEN 'AMEX,MC' ELSE NULL END AS exclude_issuers,
       CASE WHEN s_suppkey % 4 = 0 THEN '1.25' ELSE NULL END AS commission_percent,
       CASE WHEN s_suppkey % 8 = 0 THEN '0.10' ELSE NULL END AS commission_fixed,
       'AUD' AS currency_code
FROM supplier""",
    "settlement_window": """
SELECT n_name AS division,
       CASE WHEN n_nationkey % 5 = 4 THEN 'PARTNER' WHEN n_nationkey % 5 = 3 THEN 'ISO' ELSE 'INTERNAL' END AS division_type,
       CASE WHEN n_nationkey % 4 = 0 THEN 'Y' ELSE 'N' END AS settle_by_store,
       CASE WHEN n_nationkey = 24 THEN 'N' ELSE 'Y' END AS is_active,
       6 AS settlement_cycle,
       CASE WHEN n_nationkey % 2 = 0 THEN 0 ELSE 1830 END AS settlement_cutoff,
       -1 AS day_lag, 0 AS days_lookback,
       CASE WHEN n_nationkey % 6 = 0 THEN NULL ELSE TIMESTAMP '2001-05-31 23:10:00' END AS last_execution_time,
       DATE '2000-01-01' AS earliest_date,
       CASE WHEN n_nationkey % 2 = 0 THEN 'S000000000' ELSE '' END AS commission_store,
       concat('P', cast(n_nationkey as string)) AS file_prefix
FROM nation""",
    "window_by_store": f"""
SELECT {_store('s_suppkey')} AS store_id, 'Y' AS is_active, 1900 AS settlement_cutoff, -1 AS day_lag, 1 AS days_lookback,
       TIMESTAMP '2001-06-10 10:00:00' AS last_execution_time, DATE '2000-06-01' AS earliest_date
FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE n_nationkey % 4 = 0""",
    "rate_card": " UNION ALL ".join(
        _rate(card, k, start, end) for card in ("CREDIT", "DEBIT") for k, (start, end) in enumerate(_RATE_PERIODS)
    ),
    "control": """
SELECT cast(c.rule_id as double) AS rule_id, c.attribute AS attribute, c.merchant AS merchant, c.merchant_to_report AS merchant_to_report, cast(c.value as double) AS value
FROM (VALUES (0, 'Merge', 'NATION_3', 'NATION_8', 0),
      (1, 'Ratio_NotPresent To Total_Low', 'NATION_1', 'NATION ONE', 15),
      (1, 'Ratio_NotPresent To Total_High', 'NATION_1', '', 25),
      (1, 'Default_Low', '*', '', 18),
      (2, 'Ratio_ManualToCardPresent_Low', 'NATION_2', '', 2),
      (2, 'Ratio_ManualToCardPresent_High', 'NATION_2', 'NATION TWO', 3),
      (8, 'Cashout_Low', '', '', 120),
      (8, 'Cashout_High', '', '', 150),
      (8, 'Single PAN', '', '', 30),
      (10, 'Low', '', '', 110),
      (10, 'High', '', '', 130),
      (12, 'Low', '', '', 105),
      (12, 'High', '', '', 125),
      (15, 'Value Difference_Low', '', '', 5000),
      (15, 'Value Difference_High', '', '', 9000),
      (16, 'Low', '', '', 140),
      (16, 'High', '', '', 160),
      (20, 'Low', '', '', 115),
      (20, 'High', '', '', 135),
      (21, 'Low', '', '', 112),
      (21, 'High', '', '', 132),
      (23, 'Low', '', '', 108),
      (23, 'High', '', '', 128),
      (24, 'Low', '', '', 118),
      (24, 'High', '', '', 138)) c(rule_id, attribute, merchant, merchant_to_report, value)""",
    "key_value": f"""
SELECT 'merchant-terminal' AS attribute, concat(' mid', cast(s_suppkey as string)) AS key, concat({_store('s_suppkey')}, '777') AS value FROM supplier
UNION ALL SELECT 'partner-terminal', concat('Merch', cast(n_nationkey as string)), {_store('n_nationkey')} FROM nation""",
    "tran_type": """
SELECT v.dn_tran_code AS dn_tran_code, v.abbr AS abbr FROM (VALUES ('0', 'Purchase'), ('9', 'Purchase with Cashout'), ('20', 'Refund'), ('1', 'Cashout'), ('31', 'Balance Inquiry - Savings')) v(dn_tran_code, abbr)""",
    "type_code": """
SELECT t.tran_type_desc AS tran_type_desc, t.settlement_amount_flag AS settlement_amount_flag, t.spend_factor AS spend_factor
FROM (VALUES ('PURCHASE', 1, 1),
      ('PURCHASE WITH CASHOUT', 1, 1),
      ('REFUND', 1, -1),
      ('CASHOUT', 1, 1),
      ('REDEMPTION', 1, 1),
      ('ACTIVATION', 1, -1),
      ('BALANCE INQUIRY', 0, 0),
      ('BALANCE INQUIRY - SAVINGS', 0, 0),
      ('PURCHASE REVERSAL', 1, -1),
      ('PURCHASE WITH CASHOUT REVERSAL', 1, -1),
      ('REFUND REVERSAL', 1, 1),
      ('CASHOUT REVERSAL', 1, -1),
      ('REDEMPTION REVERSAL', 1, -1),
      ('ACTIVATION REVERSAL', 1, 1)) t(tran_type_desc, settlement_amount_flag, spend_factor)""",
    "factor": """
SELECT f.transaction_type AS transaction_type, f.tran_qualifier AS tran_qualifier, f.settlement_factor AS settlement_factor, f.record_type AS record_type
FROM (VALUES ('GIFT CARD REDEEM', 'INTERNAL', 1, '1'),
      ('GIFT CARD REDEEM', 'ISO', 1, '1'),
      ('GIFT CARD ACTIVATE', 'INTERNAL', -1, '2'),
      ('GIFT CARD RELOAD', 'INTERNAL', 0, '2'),
      ('PURCHASE', 'WEX', 1, '1'),
      ('PURCHASE', 'QC', 1, '1'),
      ('N', '', 1, '3'),
      ('P', '', 1, '3'),
      ('R', '', -1, '4'),
      ('N-', '', -1, '4'),
      ('PURCHASE', 'CY', 1, '5'),
      ('REFUND', 'CY', -1, '6'),
      ('ACTIVATION', 'QP', 1, '7'),
      ('CANCELLATION', 'QP', -1, '8')) f(transaction_type, tran_qualifier, settlement_factor, record_type)""",
    "response_code": "SELECT v.action_code AS action_code, v.approval_flag AS approval_flag FROM (VALUES ('000', 'Y'), ('051', 'N')) v(action_code, approval_flag)",
    # switch rows with kind, scheme and approval worked out: the analytics grain
    "billing": """
SELECT s.tran_uid AS tran_uid, substr(s.net_term_id, 1, 10) AS store_id, s.tstamp_trans AS tstamp_trans, cast(s.tstamp_trans as date) AS tran_date,
       s.scdr_token AS card_id, s.order_number AS order_number, s.load_time AS load_time,
       concat(CASE WHEN s.proc_id_iss_b = 'RED' THEN CASE upper(t.abbr) WHEN 'PURCHASE' THEN 'REDEMPTION' WHEN 'REFUND' THEN 'ACTIVATION'
              WHEN 'BALANCE INQUIRY - SAVINGS' THEN 'BALANCE INQUIRY' ELSE upper(t.abbr) END ELSE upper(t.abbr) END,
              CASE WHEN s.mti = '1440' THEN ' REVERSAL' ELSE '' END) AS kind,
       CASE s.proc_id_iss_b WHEN 'AMEX' THEN 'AMEX' WHEN 'EHB' THEN 'EFTPOS' WHEN 'FDF' THEN 'FUEL CARDS'
            WHEN 'RED' THEN 'GIFT CARDS' WHEN 'VDCS' THEN 'VISA' WHEN 'MC' THEN 'MASTERCARD'
            WHEN 'FDI' THEN CASE WHEN s.inst_id_recon_iss IN ('I0', 'UPI') THEN 'UPI' ELSE 'DINERS' END
            WHEN 'ANZ' THEN CASE WHEN s.inst_id_recon_iss IN ('I0', 'UPI') THEN 'UPI' ELSE 'ACCOUNT' END END AS scheme,
       CASE s.card_type WHEN 'C' THEN 'CREDIT' ELSE 'DEBIT' END AS card_type,
       CASE r.approval_flag WHEN 'Y' THEN 'A' ELSE 'D' END AS approval,
       s.act_code AS declined_reason, s.transaction_total AS amount_cents, s.interchange_fee AS interchange_fee, s.processing_fees AS processing_fees
FROM switch_txn s JOIN tran_type t ON cast(s.tran_type_id as int) = cast(t.dn_tran_code as int)
JOIN response_code r ON s.act_code = r.action_code""",
    "settlement_std": f"""
SELECT concat(CASE l_linenumber % 3 WHEN 0 THEN 'TC' WHEN 1 THEN 'ED' ELSE 'QP' END, '_', cast(l_orderkey as string), '_', cast(l_linenumber as string), '_', cast(l_partkey as string)) AS tran_uid,
       {_store('l_suppkey')} AS store_id,
       CASE WHEN l_linenumber % 2 = 0 THEN '1' ELSE '2' END AS record_type,
       CASE WHEN l_returnflag = 'R' THEN 'REFUND' WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN 'PURCHASE REVERSAL' ELSE 'PURCHASE' END AS transaction_type,
       concat('f', cast(l_orderkey % 50 as string)) AS filename,
       l_shipdate + {{{{secs:{_LINE_SECS}}}}} AS transaction_timestamp,
       CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * cast(round(l_extendedprice * 100) as bigint) AS settlement_cents,
       -cast(round(l_extendedprice * l_discount * 10) as bigint) AS discount_cents,
       CASE WHEN l_linestatus = 'F' THEN 'done_file' ELSE NULL END AS setlmnt_result_file,
       cast(l_orderkey as string) AS order_number
FROM lineitem""",
    "area_benchmark": """
SELECT concat('AREA', cast(c_nationkey as string)) AS area, o_orderpriority AS industry_code,
       cast(date_trunc('month', o_orderdate) as date) AS period, cast(o_orderdate as date) AS file_date,
       CASE WHEN o_orderkey % 97 = 0 THEN 99999 ELSE cast(round(o_totalprice * 100) as bigint) END AS avg_ticket_cents
FROM orders JOIN customer ON o_custkey = c_custkey""",
    # e-commerce orders: customer, contact details that change now and then, decision
    "ecom_order": """
SELECT concat('RQ', cast(o_orderkey as string)) AS request_id,
       o_custkey AS customer_id,
       concat('merchant_', cast(o_orderkey % 6 as string), '_online') AS merchant_id,
       o_orderdate AS order_time,
       concat('Addr ', cast((o_orderkey % 5) * (o_custkey % 4) as string)) AS address,
       concat('u', cast(o_custkey % 50 + (o_orderkey % 7) * (o_custkey % 2) as string), '@Mail', cast(o_custkey % 9 as string), '.example') AS email,
       concat('04', cast(o_custkey % 300 as string)) AS phone,
       CASE o_orderstatus WHEN 'F' THEN 'ACCEPT' WHEN 'O' THEN 'REVIEW' ELSE 'REJECT' END AS decision,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'ACCEPT' WHEN '2-HIGH' THEN 'REJECT' ELSE NULL END AS review_decision,
       cast(round(o_totalprice * 100) as bigint) AS amount_cents,
       -12.0 - cast(o_custkey % 2500 as double) / 100 AS latitude,
       116.0 + cast(o_custkey % 3000 as double) / 100 AS longitude,
       concat('S', lpad(cast(o_custkey % 100 as string), 9, '0')) AS store_id,
       concat('B', cast(o_custkey % 30 as string)) AS card_bin,
       o_orderkey AS order_id
FROM orders""",
}

_WORD = re.compile(r"[A-Za-z_]+")


def feeds_in(sql: str) -> list[str]:
    """Feeds a query needs, inner ones first."""
    found: list[str] = []

    def visit(text: str) -> None:
        for word in _WORD.findall(text):
            if word in FEED_SQL and word not in found and FEED_SQL[word] is not text:
                visit(FEED_SQL[word])
                if word not in found:
                    found.append(word)

    visit(sql)
    return found


def _dialect(sql: str, engine: str) -> str:
    template = r"make_dt_interval(0, 0, 0, \1)" if engine == "spark" else r"to_seconds(\1)"
    return re.sub(r"\{\{secs:(.*?)\}\}", template, sql)


def oracle(sql: str) -> str:
    """Checking query with the feeds it names in front of it."""
    names = feeds_in(sql)
    body = sql.strip()
    if not names:
        return body
    prelude = ",\n".join(f"{n} AS ({_dialect(FEED_SQL[n], 'duckdb').strip()})" for n in names)
    if body[:4].upper() == "WITH":
        return f"WITH {prelude},\n{body[4:].strip()}"
    return f"WITH {prelude}\n{body}"


#: the oracles' calendar, by its own rule: periods by their last weeks, edges by counting days
CALENDAR_SQL = """cd AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM (SELECT CAST(min(o_orderdate) AS DATE) - 400 AS a, CAST(max(o_orderdate) AS DATE) + 400 AS b FROM orders)),
cs AS (SELECT d, CAST(CASE WHEN d >= date_trunc('week', make_date(year(d), 6, 30)) THEN date_trunc('week', make_date(year(d), 6, 30)) ELSE date_trunc('week', make_date(year(d) - 1, 6, 30)) END AS DATE) AS fy_start_date FROM cd),
cw AS (SELECT *, (d - fy_start_date) // 7 + 1 AS wofy FROM cs), cp AS (SELECT *, 1 + len(list_filter([4, 8, 13, 17, 21, 26, 30, 34, 39, 43, 47], lambda x: x < wofy)) AS pofy FROM cw),
calendar AS (SELECT d AS calendar_date, CAST(date_trunc('week', d) AS DATE) AS fw_start_date, min(d) OVER p AS fp_start_date, max(d) OVER p AS fp_end_date, wofy, pofy, fy_start_date FROM cp WINDOW p AS (PARTITION BY fy_start_date, pofy))"""


class Tables:
    """Given tables and derived feeds as lazy DataFrames: ``t.orders``, ``t.switch_txn``."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark = spark
        self.path = path
        self._made: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        if name not in self._made:
            if name in GIVEN:
                self._made[name] = self.spark.read.parquet(f"{self.path}/{name}.parquet")
            elif name in FEED_SQL:
                self._made[name] = self._derive(name)
            else:
                raise AttributeError(name)
        return self._made[name]

    @property
    def calendar(self) -> DataFrame:
        """Fiscal calendar over the span of the orders, with a year to spare on both sides."""
        span = self.orders.agg(F.min("o_orderdate").cast("date").alias("a"), F.max("o_orderdate").cast("date").alias("b"))
        return fiscal_calendar(span.select(F.explode(F.sequence(F.date_sub("a", 400), F.date_add("b", 400))).alias("day")))

    def _derive(self, name: str) -> DataFrame:
        text = _dialect(FEED_SQL[name], "spark")
        inputs = {w: getattr(self, w) for w in set(_WORD.findall(text)) if w in GIVEN or (w in FEED_SQL and w != name)}
        refs = "|".join(inputs) or "$^"
        text = re.sub(rf"\b(FROM|JOIN)\s+({refs})\b", r"\1 {\2} \2", text)
        used = {k: v for k, v in inputs.items() if "{" + k + "}" in text}
        text = re.sub(r"(\{\w+\}) (\w+) ([a-z])\b(?=\s+(?:JOIN|ON))", r"\1 \3", text)
        return self.spark.sql(text, **used)
