"""Checked pipelines over versioned tables: the settlement run and replacement by day with roll back."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.plans import settlement_run as R
from ledgerloom.sinks.versions import VersionedTables, Write, replace_days
from ledgerloom.workload.feeds import RUN_TS, Tables
from ledgerloom.workload.registry import query
from ledgerloom.workload.scratch import new_folder

col = F.col

FIRST_TS = dt.datetime(2000, 6, 1, 6, 30)
_ARRIVED = dt.datetime(2000, 6, 1)

# the text of each table's rows: columns in order
_SHOWN = {
    "settlement": ["tran_uid", "settlement_cents", "setlmnt_result_file", "posting_date"],
    "windows": ["division", "division_type", "last_execution_time"],
    "windows_by_store": ["store_id", "last_execution_time"],
    "result": ["record_type", "file_name", "merchant", "company_code", "kind", "line", "org", "store_no", "customer", "location", "currency", "day", "order_ref", "amount_cents", "line_count"],
    "history": ["run_ts", "run", "record_type", "file_name", "location", "day", "order_ref", "line", "amount_cents", "line_count"],
    "audit": ["division", "record_type", "filename", "posting_file", "batch_number", "cutoff_start", "cutoff_end", "first_trans_time", "last_trans_time", "no_trans_posted", "amount_posted", "discount_amount", "created"],
    "control": ["batch_number", "processing_date", "merchant_name", "etl_complete", "extract_wf_complete", "extract_start", "extract_end", "file_date", "remarks"],
}


def _shown(tables: VersionedTables) -> DataFrame:
    out = None
    for name, columns in _SHOWN.items():
        text = F.concat_ws("|", *[F.coalesce(col(c).cast("string"), F.lit("")) for c in columns])
        part = tables.read(name).select(F.lit(name).alias("table_name"), text.alias("line"))
        out = part if out is None else out.unionByName(part)
    return out


class Stopped(Exception):
    """A run that ends after one of its writes."""


def stop_after(wanted: str):
    def check(table: str) -> None:
        if table == wanted:
            raise Stopped(table)

    return check


def attempts(run, stops) -> None:
    """The run, stopped after each of the given writes, then whole, then once more."""
    for table in stops:
        try:
            run(stop_after(table))
            raise AssertionError(f"the run wasn't stopped after {table}")
        except Stopped:
            pass
    assert run(None) and not run(None)


_FIXED = """mp AS (SELECT *, CAST(round(coalesce(CAST(commission_percent AS DOUBLE), 0) * 100) AS BIGINT) AS bp, coalesce(CAST(commission_fixed AS DOUBLE), 0) AS fx FROM sap_map WHERE active_flag <> 'N'),
co AS (SELECT company_code, row_number() OVER (ORDER BY company_code) - 1 AS seq FROM (SELECT DISTINCT company_code FROM sap_map WHERE active_flag <> 'N')),
std0 AS (SELECT *, CAST(NULL AS DATE) AS posting_date FROM settlement_std WHERE transaction_timestamp < TIMESTAMP '2000-06-01'),
win0 AS (SELECT * FROM settlement_window), wbs0 AS (SELECT * FROM window_by_store)"""
_FLAG = "CASE WHEN coalesce(w.commission_store, '') = '' THEN 'N' WHEN s.transaction_type LIKE '%REVERSAL%' THEN 'Y' WHEN s.transaction_type LIKE '%REFUND%' THEN 'N' ELSE 'Y' END"


def _run_sql(n: int, std: str, batch: str, ts: dt.datetime) -> str:
    """Tables after one run, named by its number, from those before it."""
    day, at = ts.date(), f"TIMESTAMP '{ts}'"
    cut = "CAST(DATE '{day}' + {t}.day_lag AS TIMESTAMP) + to_minutes(CAST({t}.settlement_cutoff // 100 * 60 + {t}.settlement_cutoff % 100 AS INT))"
    own = "b.store_id IS NULL OR w.settle_by_store = 'N'"
    high = "SELECT k, min(m) AS m FROM (SELECT {k} AS k, left(s.tran_uid, 2) AS src, max(s.transaction_timestamp) AS m FROM {std} s {j} WHERE s.tran_uid NOT LIKE 'QP%' GROUP BY ALL) GROUP BY 1"
    return f"""nm{n} AS (SELECT company_code, seq, 'LEDGER_' || strftime({at} + to_seconds(seq), '%Y%m%d%H%M%S') AS file_name FROM co),
open{n} AS (SELECT * FROM {std} WHERE setlmnt_result_file IS NULL AND tran_uid NOT LIKE 'QP%'),
dtl{n} AS (SELECT x.file_name, m.company_code, s.record_type AS kind, CAST(s.transaction_timestamp AS DATE) AS day, CASE WHEN coalesce(s.order_number, '') <> '' AND w.division_type = 'INTERNAL' THEN s.order_number END AS order_ref,
 m.merchant_organisation_id AS org, m.merchant_store_number AS store_no, m.customer_number AS customer, s.store_id, m.currency_code AS currency, c.merchant_organisation_id AS org_c, c.merchant_store_number AS store_no_c, c.customer_number AS customer_c, w.commission_store, c.currency_code AS currency_c,
 (s.settlement_cents + s.discount_cents) * 100 AS amt, CASE WHEN {_FLAG} = 'N' THEN 0 ELSE CAST(round((s.settlement_cents + s.discount_cents) * m.bp / 100.0 + m.fx * 10000) AS BIGINT) END AS fee
 FROM open{n} s JOIN store d ON d.store_id = s.store_id JOIN win{n - 1} w ON w.division = d.division JOIN mp m ON m.store_number = s.store_id LEFT JOIN mp c ON c.store_number = w.commission_store JOIN nm{n} x ON x.company_code = m.company_code),
lines{n} AS (SELECT file_name, company_code, kind, 'settlement' AS line, org, store_no, customer, store_id AS location, currency, day, order_ref, CAST(round(sum(amt - fee) / 100.0) AS BIGINT) AS cents FROM dtl{n} GROUP BY ALL HAVING sum(amt - fee) <> 0
 UNION ALL SELECT file_name, company_code, kind, 'commission', org_c, store_no_c, customer_c, commission_store, currency_c, day, order_ref, CAST(round(sum(fee) / 100.0) AS BIGINT) FROM dtl{n} GROUP BY ALL HAVING sum(fee) <> 0),
heads{n} AS (SELECT *, 'ledgersettlement' || CASE company_code WHEN '1410' THEN 'aus' WHEN '2025' THEN 'nzl' ELSE 'oth' END || company_code AS merchant FROM nm{n}),
file{n} AS (SELECT 'H' AS record_type, file_name, merchant, company_code, NULL AS kind, NULL AS line, NULL AS org, NULL AS store_no, NULL AS customer, NULL AS location, NULL AS currency, CAST(NULL AS DATE) AS day, NULL AS order_ref, CAST(NULL AS BIGINT) AS amount_cents, CAST(NULL AS BIGINT) AS line_count FROM heads{n}
 UNION ALL SELECT 'D', l.file_name, h.merchant, l.company_code, l.kind, l.line, l.org, l.store_no, l.customer, l.location, l.currency, l.day, l.order_ref, l.cents, NULL FROM lines{n} l JOIN heads{n} h ON h.company_code = l.company_code
 UNION ALL SELECT 'T', h.file_name, h.merchant, h.company_code, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, CAST(coalesce(sum(l.cents), 0) AS BIGINT), count(l.file_name) FROM heads{n} h LEFT JOIN lines{n} l ON l.file_name = h.file_name GROUP BY ALL),
post{n} AS (SELECT s.*, x.company_code, x.seq, x.file_name AS posting_file FROM open{n} s JOIN mp m ON m.store_number = s.store_id AND trim(m.company_code) <> '' JOIN nm{n} x ON x.company_code = m.company_code),
audit{n} AS (SELECT d.division, s.record_type, s.filename, s.posting_file, '{batch}' AS batch_number, min(coalesce(CASE WHEN {own} THEN w.last_execution_time ELSE b.last_execution_time END, TIMESTAMP '1900-01-01')) AS cutoff_start,
 max(CASE WHEN {own} THEN {cut.format(day=day, t='w')} ELSE {cut.format(day=day, t='b')} END) AS cutoff_end, min(s.transaction_timestamp) AS first_trans_time, max(s.transaction_timestamp) AS last_trans_time,
 count(*) AS no_trans_posted, CAST(sum(s.settlement_cents) AS BIGINT) AS amount_posted, CAST(sum(coalesce(s.discount_cents, 0)) AS BIGINT) AS discount_amount, {at} AS created
 FROM post{n} s JOIN store d ON d.store_id = s.store_id JOIN win{n - 1} w ON w.division = d.division AND w.is_active = 'Y' AND w.division_type <> 'PARTNER' LEFT JOIN wbs{n - 1} b ON b.store_id = s.store_id AND b.is_active = 'Y' GROUP BY ALL),
hs{n} AS ({high.format(k='s.store_id', std=std, j='')}), hd{n} AS ({high.format(k='d.division', std=std, j="JOIN store d ON d.store_id = s.store_id ANTI JOIN (SELECT store_id FROM window_by_store WHERE is_active = 'Y') a ON a.store_id = s.store_id")}),
wbs{n} AS (SELECT w.* REPLACE (coalesce(h.m, w.last_execution_time) AS last_execution_time) FROM wbs{n - 1} w LEFT JOIN hs{n} h ON h.k = w.store_id),
win{n} AS (SELECT w.* REPLACE (coalesce(h.m, w.last_execution_time) AS last_execution_time) FROM win{n - 1} w LEFT JOIN hd{n} h ON h.k = w.division),
ctl{n} AS (SELECT '{batch}' AS batch_number, CAST({at} + to_seconds(any_value(p.seq)) AS DATE) AS processing_date, h.merchant AS merchant_name, true AS etl_complete, NULL AS extract_wf_complete, date_trunc('second', min(p.transaction_timestamp)) AS extract_start, date_trunc('second', max(p.transaction_timestamp)) AS extract_end, {at} + to_seconds(any_value(p.seq)) AS file_date, NULL AS remarks
 FROM post{n} p JOIN heads{n} h ON h.company_code = p.company_code GROUP BY h.merchant),
std{n} AS (SELECT s.* REPLACE (CASE WHEN s.setlmnt_result_file IS NULL AND p.f IS NOT NULL THEN p.f ELSE s.setlmnt_result_file END AS setlmnt_result_file, CASE WHEN s.setlmnt_result_file IS NULL AND p.f IS NOT NULL THEN DATE '{day}' ELSE s.posting_date END AS posting_date)
 FROM {std} s LEFT JOIN (SELECT tran_uid, max(posting_file) AS f FROM post{n} GROUP BY 1) p ON p.tran_uid = s.tran_uid)"""


def _line_sql(table: str, source: str) -> str:
    text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in _SHOWN[table])
    return f"SELECT '{table}' AS table_name, concat_ws('|', {text}) AS line FROM ({source})"


_AFTER = f"""{_FIXED},
{_run_sql(1, 'std0', 'B1', FIRST_TS)},
both1 AS (SELECT * FROM std1 UNION ALL BY NAME SELECT *, CAST(NULL AS DATE) AS posting_date FROM settlement_std WHERE transaction_timestamp >= TIMESTAMP '2000-06-01'),
{_run_sql(2, 'both1', 'B2', RUN_TS)}"""
_HISTORY = f"SELECT TIMESTAMP '{FIRST_TS}' AS run_ts, 'B1' AS run, * FROM file1 UNION ALL SELECT TIMESTAMP '{RUN_TS}', 'B2', * FROM file2"


@query(
    "m_settlement_run_state",
    f"WITH {_AFTER} "
    + " UNION ALL ".join(
        _line_sql(t, s)
        for t, s in {
            "settlement": "SELECT * FROM std2", "windows": "SELECT * FROM win2", "windows_by_store": "SELECT * FROM wbs2", "result": "SELECT * FROM file2", "history": _HISTORY,
            "audit": "SELECT * FROM audit1 UNION ALL SELECT * FROM audit2", "control": "SELECT * FROM ctl1 UNION ALL SELECT * FROM ctl2",
        }.items()
    ),
)
def _settlement_run(t: Tables):
    """All tables after two runs with an arrival in between; every step is repeated, the runs after stops."""
    tables = VersionedTables(t.spark, new_folder(t.spark, "settlement"))
    early = t.settlement_std.where(col("transaction_timestamp") < F.lit(_ARRIVED))
    late = t.settlement_std.where(col("transaction_timestamp") >= F.lit(_ARRIVED))
    for _ in range(2):
        R.start(tables, early, t.settlement_window, t.window_by_store, "LOAD", "yyyy")
    attempts(lambda stop: R.run(tables, t.store, t.sap_map, "B1", FIRST_TS, after_write=stop), ["history"])
    for _ in range(2):
        R.arrive(tables, late, "LATE", "yyyy")
    attempts(lambda stop: R.run(tables, t.store, t.sap_map, "B2", RUN_TS, after_write=stop), ["audit"])
    return _shown(tables)


@query(
    "j05_replace_days_roll_back",
    """WITH l AS (SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders),
n AS (SELECT o_orderkey, month, -cents AS cents FROM l WHERE month >= DATE '2001-01-01'), two AS (SELECT * FROM l WHERE month < DATE '2001-01-01' UNION ALL SELECT * FROM n)
SELECT v AS version, o_orderkey, CAST(month AS VARCHAR) AS month, cents FROM (SELECT 1 AS v, * FROM l UNION ALL SELECT 2, * FROM two UNION ALL SELECT 3, o_orderkey, month, 0 FROM l UNION ALL SELECT 4, * FROM two)""",
)
def _j05_roll_back(t: Tables):
    """Load, replace some months, a replacement that stops before its commit, one that fails its check and is rolled back."""
    tables = VersionedTables(t.spark, new_folder(t.spark, "replaced"))
    rows = t.orders.select("o_orderkey", F.trunc("o_orderdate", "month").alias("month"), F.round(col("o_totalprice") * 100).cast("long").alias("cents"))
    later = rows.where(col("month") >= F.lit(dt.date(2001, 1, 1))).withColumn("cents", -col("cents"))
    nothing = rows.withColumn("cents", F.lit(0).cast("long"))
    replace_days(tables, "orders", rows, "month", "one")
    replace_days(tables, "orders", later, "month", "two")
    try:
        tables.commit("stopped", {"orders": Write(nothing, "parts", "month")}, stop_after("orders"))
    except Stopped:
        pass
    replace_days(tables, "orders", nothing, "month", "three", check=lambda now: not now.where(col("cents") != 0).isEmpty())
    out = None
    for version in tables.versions():
        part = tables.read("orders", version).select(F.lit(version).alias("version"), "o_orderkey", "month", "cents")
        out = part if out is None else out.unionByName(part)
    return out
