"""Checked compliance rules.  The oracles use month self joins, the engine range windows."""

from __future__ import annotations

from ledgerloom.params import RunParams
from ledgerloom.plans import compliance as C
from ledgerloom.workload.feeds import BASELINE_FROM, RUN_DATE, RUN_TS, SITE_DIVISIONS, STORE_WIDTH, Tables
from ledgerloom.workload.registry import query

P = RunParams(RUN_DATE, RUN_TS, store_width=STORE_WIDTH, baseline_from=BASELINE_FROM)
SITES = SITE_DIVISIONS
W0, W1, R0, B0 = P.window_start, P.window_end, P.report_start, P.baseline_from
SINCE, UNTIL = "1995-01-01", "2001-07-12"

_SITES_SQL = "('NATION_1', 'NATION_2')"
_MERCHANT = "upper(trim(CASE WHEN coalesce(mc.merchant_to_report, '') <> '' THEN mc.merchant_to_report ELSE m.division END))"


def _site(col: str, blank: bool) -> str:
    text = f"CASE WHEN m.division IN {_SITES_SQL} THEN upper(trim(m.{col})) ELSE '' END"
    return f"coalesce({text}, '')" if blank else text


def _from(src: str, term: str = "net_term_id") -> str:
    return f"""FROM {src} t JOIN store m ON upper(substr(trim(t.{term}), 1, 10)) = m.store_id AND coalesce(m.division, '') <> ''
LEFT JOIN control mc ON mc.rule_id = 0 AND mc.attribute = 'Merge' AND mc.merchant = m.division
WHERE coalesce(t.{term}, '') <> ''"""


def _cv(rule: float, attr: str, scale: str = "") -> str:
    return f"(SELECT value{scale} FROM control WHERE rule_id = {rule} AND attribute = '{attr}')"


def _avg(value: str, weight: str = "1", scale: str = "", empty: str = "NULL") -> str:
    parts = [f"coalesce(p{i}.{value}, 0)" for i in (1, 2, 3)]
    counts = [f"CASE WHEN coalesce(p{i}.{value}, 0) = 0 THEN 0 ELSE {weight.replace('#', f'p{i}.')} END" for i in (1, 2, 3)]
    total, n = " + ".join(parts), " + ".join(counts)
    return f"CASE WHEN m.mon < DATE '{B0}' THEN NULL WHEN ({n}) = 0 THEN {empty} ELSE CAST({total} AS DOUBLE){scale} / ({n}) END"


def _joins(keys: list[str], src: str = "monthly") -> str:
    out = f"FROM {src} m"
    for i in (1, 2, 3):
        on = " AND ".join(f"p{i}.{k} = m.{k}" for k in keys)
        out += f"\nLEFT JOIN {src} p{i} ON {on} AND p{i}.mon = CAST(m.mon - INTERVAL {i} MONTH AS DATE)"
    return out + f"\nWHERE m.mon >= DATE '{R0}' AND m.mon < DATE '{W1}'"


_MON = "CAST(date_trunc('month', {ts}) AS DATE)"


def _limits(rule: float, low: str = "Low", high: str = "High") -> str:
    return f"{_cv(rule, low, ' * 0.01')} AS threshold1, {_cv(rule, high, ' * 0.01')} AS threshold2"


def _rule1_sql(rule: int, where: str, aggs: str, outs: str, low: str, high: str, floor: tuple[str, str]) -> str:
    return f"""WITH days AS (SELECT substr(net_term_id, 1, 10) AS store_id, CAST(tstamp_local AS DATE) AS d, {aggs}
FROM switch_txn WHERE net_term_id <> '' {where} GROUP BY 1, 2)
SELECT coalesce(nullif(r1.merchant_to_report, ''), nullif(r2.merchant_to_report, ''), m.division) AS merchant, s.store_id, m.site_name,
 CAST(s.d AS VARCHAR) AS transaction_date,
 coalesce(coalesce(r1.value, (SELECT value FROM control WHERE rule_id = {rule} AND attribute = 'Default_Low')) * 0.01, {floor[0]}) AS threshold1,
 coalesce(coalesce(r2.value, (SELECT value FROM control WHERE rule_id = {rule} AND attribute = 'Default_High')) * 0.01, {floor[1]}) AS threshold2,
 {outs}
FROM days s JOIN store m ON m.store_id = s.store_id AND m.division <> ''
LEFT JOIN control r1 ON r1.merchant = m.division AND r1.rule_id = {rule} AND r1.attribute = '{low}'
LEFT JOIN control r2 ON r2.merchant = m.division AND r2.rule_id = {rule} AND r2.attribute = '{high}'"""


_R1 = ("count(*) FILTER (pos_crdhldr_presnt = '0') AS cp, count(*) FILTER (pos_crdhldr_presnt <> '0') AS cnp", "s.cp AS card_present, s.cnp AS card_not_present",
       "Ratio_NotPresent To Total_Low", "Ratio_NotPresent To Total_High", ("0.2", "0.3"))


@query("i11_rule1_card_presence", _rule1_sql(1, "", *_R1))
def _rule1(t: Tables):
    return C.rule1(t.switch_txn, t.store, t.control, P)


@query("i11_rule2_1_card_presence_window", _rule1_sql(1, f"AND tstamp_local >= TIMESTAMP '{W0}' AND tstamp_local < TIMESTAMP '{W1}'", *_R1))
def _rule2_1(t: Tables):
    return C.rule2_1(t.switch_txn, t.store, t.control, P)


@query(
    "i12_rule2_manual_entry",
    _rule1_sql(2, "AND pos_crdhldr_presnt = '0'", "count(*) AS cp, count(*) FILTER (pos_crd_dat_in_mod = '6') AS man", "s.cp AS card_present, s.man AS manual_count",
               "Ratio_ManualToCardPresent_Low", "Ratio_ManualToCardPresent_High", ("0.01", "0.015")),
)
def _rule2(t: Tables):
    return C.rule2(t.switch_txn, t.store, t.control, P)


_CASH = f"""cash AS (SELECT {_MERCHANT} AS merchant, {_site('store_id', False)} AS store_id, {_site('site_name', False)} AS site_name,
 t.masked_pan, t.tstamp_local, t.cashout_total {_from('switch_txn')} AND t.pos_crdhldr_presnt = '0' AND t.cashout_total <> 0
 AND t.act_code IN (SELECT action_code FROM response_code WHERE approval_flag = 'Y'))"""
_RULE8 = f"""{_CASH}, monthly AS (SELECT merchant, store_id, site_name, {_MON.format(ts='tstamp_local')} AS mon, day(last_day({_MON.format(ts='tstamp_local')})) AS days, sum(cashout_total) AS c
 FROM cash WHERE tstamp_local >= TIMESTAMP '{W0}' AND tstamp_local < TIMESTAMP '{W1}' GROUP BY ALL),
rule8 AS (SELECT m.merchant, m.store_id, m.site_name, m.mon, m.days, m.c, {_avg('c', '#days', ' / 100', '0')} AS a1, {_avg('c', '1', ' / 100', '0')} AS a2
 {_joins(['merchant', 'store_id', 'site_name'])})"""


@query(
    "i13_rule8_cashout_baseline",
    f"""WITH {_RULE8} SELECT merchant, store_id, site_name, CAST(mon AS VARCHAR) AS first_of_month, days AS days_in_month, CAST(c AS DOUBLE) / 100 AS cashout,
 a1 AS avg_daily_cashout_3mon, a2 AS rolling_3mon_avg, {_limits(8, 'Cashout_Low', 'Cashout_High')}, {_cv(8, 'Single PAN')} AS threshold3 FROM rule8""",
)
def _rule8(t: Tables):
    return C.rule8(t.switch_txn, t.store, t.response_code, t.control, P, SITES)


@query(
    "i14_rule8_1_daily_cashout",
    f"""WITH {_RULE8}, pan AS (SELECT merchant, store_id, site_name, masked_pan, CAST(tstamp_local AS DATE) AS d, sum(cashout_total) AS c FROM cash
 WHERE tstamp_local >= TIMESTAMP '{R0}' GROUP BY ALL),
days AS (SELECT merchant, store_id, site_name, d, sum(c) AS c, count(*) FILTER (CAST(c AS DOUBLE) / 100 > {_cv(8, 'Single PAN')}) AS n FROM pan GROUP BY ALL)
SELECT x.merchant, x.store_id, x.site_name, CAST(x.d AS VARCHAR) AS transaction_date, day(last_day(x.d)) AS days_in_month, CAST(x.c AS DOUBLE) / 100 AS cashout,
 x.n AS cashout_exceeding_threshold, r.a1 AS avg_daily_cashout_3mon, {_limits(8, 'Cashout_Low', 'Cashout_High')}, {_cv(8, 'Single PAN')} AS threshold3
FROM days x LEFT JOIN rule8 r ON r.merchant = x.merchant AND r.store_id = x.store_id AND r.site_name = x.site_name AND r.mon = date_trunc('month', x.d)""",
)
def _rule8_1(t: Tables):
    return C.rule8_1(t.switch_txn, t.store, t.response_code, t.control, P, SITES)


def _window(ts: str = "t.tstamp_local") -> str:
    return f"AND {ts} >= TIMESTAMP '{W0}' AND {ts} < TIMESTAMP '{W1}'"


_CPN = "count(*) FILTER (t.pos_crdhldr_presnt = '0') AS count_cp, count(*) FILTER (t.pos_crdhldr_presnt <> '0') AS count_cnp"
_S4 = ["merchant", "mcc_code", "store_id", "site_name"]
_S3 = ["merchant", "store_id", "site_name"]


def _sites_sql(blank: bool, mcc: bool) -> str:
    out = f"{_MERCHANT} AS merchant, {_site('store_id', blank)} AS store_id, {_site('site_name', blank)} AS site_name"
    return out + (", coalesce(m.mcc_code, '') AS mcc_code" if mcc else "")


def _count_rule(rule: int, keys: list[str], blank: bool, where: str, aggs: str, pairs: dict[str, str], extra: str = "") -> str:
    mcc = "mcc_code" in keys
    outs = ", ".join(f"m.{k}" for k in keys)
    vals = ", ".join(f"m.{v}, {_avg(v)} AS {n}" for v, n in pairs.items())
    return f"""WITH monthly AS (SELECT {_sites_sql(blank, mcc)}{extra}, {_MON.format(ts='t.tstamp_local')} AS mon, {aggs}
 {_from('switch_txn')} {_window()} {where} GROUP BY ALL)
SELECT {outs}, CAST(m.mon AS VARCHAR) AS first_of_month, {vals}, {_limits(rule)} {_joins(keys)}"""


@query("i15_rule10_presence_baseline", _count_rule(10, _S4, True, "", _CPN, {"count_cp": "rolling_avg_cp", "count_cnp": "rolling_avg_cnp"}))
def _rule10(t: Tables):
    return C.rule10(t.switch_txn, t.store, t.control, P, SITES)


@query(
    "i16_rule12_fallback_baseline",
    _count_rule(12, _S3, False, "AND t.pos_crdhldr_presnt = '0'", "count(*) AS count_cp, count(*) FILTER (t.pos_crd_dat_in_mod IN ('B', 'C')) AS count_fallback",
                {"count_cp": "rolling_avg_cp", "count_fallback": "rolling_avg_fallback"}),
)
def _rule12(t: Tables):
    return C.rule12(t.switch_txn, t.store, t.control, P, SITES)


_SCHEME = """CASE t.proc_id_iss_b WHEN 'AMEX' THEN 'AMEX' WHEN 'EHB' THEN 'EFTPOS' WHEN 'FDF' THEN 'FUEL CARDS' WHEN 'RED' THEN 'GIFT CARDS' WHEN 'VDCS' THEN 'VISA' WHEN 'MC' THEN 'MASTERCARD'
 WHEN 'FDI' THEN CASE WHEN t.inst_id_recon_iss = 'I0' THEN 'UPI' ELSE 'DINERS' END WHEN 'ANZ' THEN CASE WHEN t.inst_id_recon_iss = 'I0' THEN 'UPI' ELSE 'ACCOUNT' END END"""


@query(
    "i19_rule21_scheme_baseline",
    _count_rule(21, [*_S3, "scheme"], False, "", _CPN, {"count_cp": "rolling_avg_cp", "count_cnp": "rolling_avg_cnp"}, f", {_SCHEME} AS scheme"),
)
def _rule21(t: Tables):
    return C.rule21(t.switch_txn, t.store, t.control, P, SITES)


@query(
    "i17_rule15_16_purchase_refund_baseline",
    f"""WITH typed AS (SELECT t.*, left(upper(y.abbr), 6) AS k FROM switch_txn t JOIN tran_type y ON CAST(t.tran_type_id AS INT) = CAST(y.dn_tran_code AS INT)
 WHERE left(upper(y.abbr), 6) IN ('PURCHA', 'REFUND')),
monthly AS (SELECT {_sites_sql(True, True)}, {_MON.format(ts='t.tstamp_local')} AS mon, sum(CASE WHEN t.k = 'PURCHA' THEN t.purchase_total ELSE 0 END) AS pv,
 sum(CASE WHEN t.k = 'REFUND' THEN t.transaction_total ELSE 0 END) AS rv, count(*) FILTER (t.k = 'PURCHA' AND t.purchase_total <> 0) AS pc,
 count(*) FILTER (t.k = 'REFUND' AND t.transaction_total <> 0) AS rc {_from('typed')} {_window()} GROUP BY ALL)
SELECT {', '.join('m.' + k for k in _S4)}, CAST(m.mon AS VARCHAR) AS first_of_month, CAST(m.pv AS DOUBLE) / 100 AS purchase_value, CAST(m.rv AS DOUBLE) / 100 AS refund_value,
 m.pc AS purchase_count, m.rc AS refund_count, {_avg('pv', scale=' / 100')} AS rolling_purchase_value, {_avg('rv', scale=' / 100')} AS rolling_refund_value,
 {_avg('pc')} AS rolling_purchase_count, {_avg('rc')} AS rolling_refund_count, {_cv(15, 'Value Difference_Low')} AS value_diff_low, {_cv(15, 'Value Difference_High')} AS value_diff_high,
 {_cv(16, 'Low', ' * 0.01')} AS refund_low, {_cv(16, 'High', ' * 0.01')} AS refund_high {_joins(_S4)}""",
)
def _rule15(t: Tables):
    return C.rule15_16(t.switch_txn, t.store, t.tran_type, t.control, P, SITES)


_SETTLED = f"""raw AS (SELECT t.net_term_id AS terminal, {_SCHEME} AS scheme, t.tstamp_trans, t.amt_recon_net AS cents,
 CASE WHEN t.proc_id_iss_b = 'RED' THEN CASE upper(y.abbr) WHEN 'PURCHASE' THEN 'REDEMPTION' WHEN 'REFUND' THEN 'ACTIVATION' WHEN 'BALANCE INQUIRY - SAVINGS' THEN 'BALANCE INQUIRY' ELSE upper(y.abbr) END
  ELSE upper(y.abbr) END || CASE WHEN t.mti = '1440' THEN ' REVERSAL' ELSE '' END AS kind
 FROM switch_txn t JOIN tran_type y ON CAST(t.tran_type_id AS INT) = CAST(y.dn_tran_code AS INT)
 JOIN response_code r ON r.action_code = t.act_code AND r.approval_flag = 'Y' WHERE t.amt_recon_net <> 0
 UNION ALL SELECT terminal_id, scheme_name, txn_time, amount_cents, transaction_type FROM wallet_txn),
settled AS (SELECT {_sites_sql(True, True)}, t.scheme, t.tstamp_trans, coalesce(tc.spend_factor, 0) * t.cents AS v
 {_from('raw', 'terminal').replace('WHERE', 'LEFT JOIN type_code tc ON tc.tran_type_desc = t.kind WHERE')}
 AND t.tstamp_trans >= TIMESTAMP '{SINCE}' AND t.tstamp_trans < TIMESTAMP '{UNTIL}')"""
_BYSCHEME = f"""{_SETTLED}, byscheme AS (SELECT merchant, mcc_code, store_id, site_name, scheme, {_MON.format(ts='tstamp_trans')} AS mon, sum(v) AS v FROM settled GROUP BY ALL)"""


def _detail(t: Tables, since=SINCE, until=UNTIL):
    return C.settled_detail(t.switch_txn, t.wallet_txn, t.tran_type, t.response_code, t.store, t.type_code, t.control, P, SITES, since, until)


def _window_detail(t: Tables):
    """The months of the report and of their baselines only; the range reaches the scan."""
    return _detail(t, max(SINCE, str(P.window_start)), min(UNTIL, str(P.window_end)))


@query(
    "i20_rule22_part1_settlement_by_scheme",
    f"WITH {_BYSCHEME} SELECT merchant, mcc_code, store_id, site_name, scheme, CAST(mon AS VARCHAR) AS first_of_month, CAST(v AS DOUBLE) / 100 AS settlement_amount FROM byscheme",
)
def _rule22p1(t: Tables):
    return C.billing_by_scheme(_detail(t))


_KEPT = f"mon >= DATE '{W0}' AND mon < DATE '{W1}'"


@query(
    "i18_rule20_deposit_baseline",
    f"""WITH {_BYSCHEME}, monthly AS (SELECT merchant, mcc_code, store_id, site_name, mon, sum(v) AS v FROM byscheme WHERE {_KEPT} GROUP BY ALL)
SELECT {', '.join('m.' + k for k in _S4)}, CAST(m.mon AS VARCHAR) AS first_of_month, CAST(m.v AS DOUBLE) / 100 AS deposit_value, {_avg('v', scale=' / 100')} AS rolling_avg, {_limits(20)} {_joins(_S4)}""",
)
def _rule20(t: Tables):
    return C.rule20(C.billing_by_scheme(_window_detail(t)), t.control, P)


@query(
    "i21_rule22_scheme_deposit_baseline",
    f"""WITH {_BYSCHEME}, monthly AS (SELECT * FROM byscheme WHERE {_KEPT})
SELECT {', '.join('m.' + k for k in [*_S4, 'scheme'])}, CAST(m.mon AS VARCHAR) AS first_of_month, CAST(m.v AS DOUBLE) / 100 AS deposit_value, {_avg('v', scale=' / 100')} AS rolling_avg,
 0 AS threshold_low, 0 AS threshold_high {_joins([*_S4, 'scheme'])}""",
)
def _rule22(t: Tables):
    return C.rule22(C.billing_by_scheme(_window_detail(t)), P)


def _per_tran(scale: str = " / 100") -> str:
    v = " + ".join(f"coalesce(p{i}.v, 0)" for i in (1, 2, 3))
    n = " + ".join(f"coalesce(p{i}.n, 0)" for i in (1, 2, 3))
    return f"CASE WHEN m.mon < DATE '{B0}' OR ({n}) = 0 THEN NULL ELSE CAST({v} AS DOUBLE){scale} / ({n}) END AS rolling_avg_trans, {_avg('v', scale=' / 100')} AS rolling_avg_value, {_avg('n')} AS rolling_avg_count"


@query(
    "i22_rule23_average_value_baseline",
    f"""WITH {_SETTLED}, monthly AS (SELECT merchant, mcc_code, store_id, site_name, {_MON.format(ts='tstamp_trans')} AS mon, sum(v) AS v, count(*) AS n FROM settled
 WHERE tstamp_trans >= TIMESTAMP '{W0}' AND tstamp_trans < TIMESTAMP '{W1}' GROUP BY ALL)
SELECT {', '.join('m.' + k for k in _S4)}, CAST(m.mon AS VARCHAR) AS first_of_month, CAST(m.v AS DOUBLE) / 100 AS trans_value, m.n AS trans_count, CAST(m.v AS DOUBLE) / 100 / m.n AS avg_trans,
 {_per_tran()}, {_limits(23)} {_joins(_S4)}""",
)
def _rule23(t: Tables):
    return C.rule23(_window_detail(t), t.control, P)


@query(
    "i23_rule24_chargeback_baseline",
    f"""WITH one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY bank_ref_no ORDER BY txn_dttm_local, id) AS rn FROM chargebacks) WHERE rn = 1),
monthly AS (SELECT {_sites_sql(False, False)}, {_MON.format(ts='t.txn_dttm_local')} AS mon, sum(t.amount_cents) AS v, count(*) AS n {_from('one', 'store_id')} AND t.amount_cents <> 0 {_window('t.txn_dttm_local')} GROUP BY ALL)
SELECT {', '.join('m.' + k for k in _S3)}, CAST(m.mon AS VARCHAR) AS first_of_month, CAST(m.v AS DOUBLE) / 100 AS trans_value, m.n AS trans_count, {_per_tran()}, {_limits(24)} {_joins(_S3)}""",
)
def _rule24(t: Tables):
    return C.rule24(t.chargebacks, t.store, t.control, P, SITES)


@query(
    "i24_alert_level",
    f"""WITH {_RULE8} SELECT merchant, store_id, site_name, CAST(mon AS VARCHAR) AS first_of_month, CAST(c AS DOUBLE) / 100 AS cashout, a2 AS rolling_3mon_avg,
 CASE WHEN a2 <> 0 AND CAST(c AS DOUBLE) / 100 / a2 >= {_cv(8, 'Cashout_High', ' * 0.01')} THEN 'high' WHEN a2 <> 0 AND CAST(c AS DOUBLE) / 100 / a2 >= {_cv(8, 'Cashout_Low', ' * 0.01')} THEN 'low' ELSE 'none' END AS alert_level FROM rule8""",
)
def _alert(t: Tables):
    out = C.with_alert(C.rule8(t.switch_txn, t.store, t.response_code, t.control, P, SITES), "cashout", "rolling_3mon_avg")
    return out.select("merchant", "store_id", "site_name", "first_of_month", "cashout", "rolling_3mon_avg", "alert_level")
