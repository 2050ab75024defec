"""Checked runs over scratch state: catalog reconciliation, and the fee-listing run with its views."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators import recon as Q
from ledgerloom.plans import fee_run as R
from ledgerloom.sinks.versions import VersionedTables
from ledgerloom.workload.feeds import RUN_DATE, STORE_WIDTH, Tables
from ledgerloom.workload.q_versions import attempts
from ledgerloom.workload.registry import query
from ledgerloom.workload.scratch import new_folder

col = F.col

# tables of the scratch catalog: name, given table, its columns in Spark and in the oracle
_LOADED = {
    "orders_feed": ("orders", "o_orderkey", "o_orderdate", "concat('orders_', o_orderpriority)"),
    "line_feed": ("lineitem", "l_orderkey", "l_shipdate", "concat('lines_', l_returnflag)"),
    "switch_feed": ("switch_txn", "tran_uid", "tstamp_trans", "concat('switch_', card_type)"),
    "wallet_feed": ("wallet_txn", "txn_ref", "txn_time", "concat('wallet_', gateway)"),
}
_ARRIVED = {"settled": ("settlement_std", "tran_uid", "transaction_timestamp"), "chargeback_feed": ("chargebacks", "id", "received_dt")}
_RECON_SQL = " UNION ALL ".join(
    [f"SELECT '{n}' AS table_name, CAST({d} AS DATE) AS file_date, {f} AS file_name, CAST({d} AS DATE) + INTERVAL 1 DAY AS load_time, count(*) AS rows FROM {t} GROUP BY ALL" for n, (t, _, d, f) in _LOADED.items()]
    + [f"SELECT '{n}', CAST({d} AS DATE), ' ', NULL, count(*) FROM {t} GROUP BY ALL" for n, (t, _, d) in _ARRIVED.items()]
)


@query(
    "i10_catalog_reconciliation",
    f"""WITH f AS ({_RECON_SQL}), s AS (SELECT unnest({sorted([*_LOADED, *_ARRIVED])}) AS table_name), d AS (SELECT CAST(unnest(generate_series(DATE '2001-07-08', DATE '2001-07-14', INTERVAL 1 DAY)) AS DATE) AS file_date)
SELECT s.table_name, CAST(d.file_date AS VARCHAR) AS file_date, f.file_name, CAST(f.load_time AS VARCHAR) AS load_time, coalesce(f.rows, 0) AS rows FROM s, d LEFT JOIN f ON f.table_name = s.table_name AND f.file_date = d.file_date""",
)
def _i10_catalog(t: Tables):
    """A scratch database of six tables with load dates, one without and a view; the plan comes from its catalog."""
    spark, home = t.spark, new_folder(t.spark, "catalog")
    database = "scratch_" + home.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{home}/db'")
    try:
        store = lambda df, name: df.write.option("path", f"{home}/tables/{name}").saveAsTable(f"{database}.{name}")
        for name, (source, key, at, file) in _LOADED.items():
            day = col(at).cast("date")
            store(getattr(t, source).select(key, day.alias("file_date"), F.expr(file).alias("file_name"), F.date_add(day, 1).cast("timestamp_ntz").alias("load_time")), name)
        for name, (source, key, at) in _ARRIVED.items():
            store(getattr(t, source).select(key, col(at).cast("timestamp_ntz").alias("load_dttm")), name)
        store(t.nation, "undated")
        spark.sql(f"CREATE VIEW {database}.orders_view AS SELECT * FROM {database}.orders_feed")
        # the tables' folders outlive the database, which only names them
        return Q.catalog_reconciliation(spark, [database], RUN_DATE).drop("database")
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


@query("a16_catalog_columns", "SELECT 'orders' AS table_name, count(*) AS columns FROM (DESCRIBE orders) UNION ALL SELECT 'supplier', count(*) FROM (DESCRIBE supplier)")
def _a16(t: Tables):
    """Columns by table of a scratch database, counted from the catalog; the rows are those of the given tables."""
    spark, home = t.spark, new_folder(t.spark, "catalog")
    database = "scratch_" + home.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{home}/db'")
    try:
        for name in ("orders", "supplier"):
            getattr(t, name).write.option("path", f"{home}/tables/{name}").saveAsTable(f"{database}.{name}")
        return Q.catalog_scan(spark, [database]).groupBy("table_name").agg(F.count("*").alias("columns"))
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


_RUNS = [dt.datetime(2000, 7, 8, 5), dt.datetime(2000, 7, 9, 5), dt.datetime(2000, 7, 15, 5)]
_DAYS = [["2000-07-04"], ["2000-07-05"], [f"2000-07-{d:02d}" for d in range(6, 12)]]
_NAMES = """cf AS (SELECT DISTINCT p, v FROM (SELECT file_prefix AS p, CASE WHEN commission_store = '' THEN 'V1' ELSE 'V2' END AS v FROM settlement_window UNION ALL SELECT file_prefix || 'OLD', 'V1' FROM settlement_window WHERE division_type = 'ISO')),
nm AS (SELECT p || '_feelist_' || v AS name, p, v, row_number() OVER (ORDER BY p || '_feelist_' || v) - 1 AS seq FROM cf)"""
_D4 = "CAST(CAST({c} AS DECIMAL(24,4)) AS VARCHAR)"
_SCHEME = """CASE t.proc_id_iss_b WHEN 'AMEX' THEN 'AMEX' WHEN 'EHB' THEN 'EFTPOS' WHEN 'FDF' THEN 'FUEL CARDS' WHEN 'RED' THEN 'GIFT CARDS' WHEN 'VDCS' THEN 'VISA' WHEN 'MC' THEN 'MASTERCARD'
 WHEN 'FDI' THEN CASE WHEN t.inst_id_recon_iss = 'I0' THEN 'UPI' ELSE 'DINERS' END WHEN 'ANZ' THEN CASE WHEN t.inst_id_recon_iss = 'I0' THEN 'UPI' ELSE 'ACCOUNT' END END"""
_LISTED = f"""dd AS (SELECT t.*, w.file_prefix, CAST(t.tstamp_local AS DATE) AS td FROM switch_txn t JOIN store m ON m.store_id = left(t.net_term_id, 10) JOIN settlement_window w ON w.division = m.division WHERE CAST(t.tstamp_local AS DATE) BETWEEN DATE '2000-07-04' AND DATE '2000-07-11' AND t.act_code <> '902'),
li AS (SELECT 'D' AS record_type, t.net_term_id AS terminal_id, {_D4.format(c='t.transaction_total')} AS transaction_amt, strftime(t.tstamp_trans, '%Y%m%d%H%M%S') AS transaction_timestamp, CASE WHEN length(t.masked_pan) < 10 THEN t.masked_pan ELSE left(t.masked_pan, 6) || '******' || right(t.masked_pan, 4) END AS pan,
 printf('%06d', CAST(t.order_number AS BIGINT)) AS stan, t.mti, {_SCHEME} AS scheme, CASE t.card_type WHEN 'C' THEN 'Credit' ELSE 'Debit' END AS card_type, CASE WHEN t.proc_id_iss_b IN ('AMEX', 'FDI') THEN '0.0000' ELSE {_D4.format(c='t.interchange_fee')} END AS interchange_fee,
 {_D4.format(c='t.processing_fees')} AS processing_fee, t.file_prefix, CAST(t.td AS VARCHAR) AS tran_date FROM dd t UNION ALL SELECT 'T', CAST(count(*) AS VARCHAR), NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, file_prefix, CAST(td AS VARCHAR) FROM dd GROUP BY file_prefix, td)"""


def _text(columns: list[str]) -> str:
    return "concat_ws('|', " + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in columns) + ")"


def _control_rows() -> str:
    parts = []
    for k, (ts, days) in enumerate(zip(_RUNS, _DAYS), 1):
        parts.append(
            f"SELECT 'control' AS source, concat_ws('|', 'FTLF{k:09d}', '{ts.date()}', name, 'true', CAST(CAST(d AS TIMESTAMP) + to_seconds(seq) AS VARCHAR), CAST(TIMESTAMP '{ts}' + to_seconds(seq) AS VARCHAR)) AS line FROM nm, (SELECT CAST(unnest({days}) AS DATE) AS d)"
        )
    return " UNION ALL ".join(parts)


@query(
    "m_fee_listing_run",
    f"""WITH {_NAMES}, {_LISTED}
SELECT lower('vw_' || p || '_fee_listing_' || v) AS source, CASE WHEN v = 'V1' THEN {_text(R.LISTING_LAYOUTS['V1'])} ELSE {_text(R.LISTING_LAYOUTS['V2'])} END AS line FROM nm JOIN li ON li.file_prefix = nm.p WHERE tran_date >= '2000-07-06'
UNION ALL SELECT 'history', concat_ws('|', terminal_id, transaction_amt, transaction_timestamp, tran_date, CASE tran_date WHEN '2000-07-04' THEN '2000-07-08' WHEN '2000-07-05' THEN '2000-07-09' ELSE '2000-07-15' END) FROM li WHERE record_type = 'D'
UNION ALL {_control_rows()}
UNION ALL SELECT 'gap', concat_ws('|', name, d) FROM nm, (SELECT unnest({_DAYS[2]}) AS d)""",
)
def _fee_run(t: Tables):
    """Two daily runs and one after five missed days; the views, the history, the control rows and the gaps before the last run."""
    spark = t.spark
    tables = VersionedTables(spark, new_folder(spark, "fees"))
    old = col("division_type") == "ISO"
    config = t.settlement_window.select(
        "file_prefix", F.when(col("commission_store") == "", "V1").otherwise("V2").alias("version"),
        F.when(old, F.concat("file_prefix", F.lit("OLD"))).alias("file_prefix_old"), F.when(old, "V1").alias("version_old"),
    )
    for k, ts in enumerate(_RUNS):
        step = lambda stop, ts=ts: R.run(tables, [t.switch_txn], t.store, t.settlement_window, config, ts, STORE_WIDTH, after_write=stop)
        attempts(step, ["history"] if k == 2 else [])
    missing = R.control_gaps(tables.read("control", tables.versions()[1]), config, dt.date(2000, 7, 4), dt.date(2000, 7, 11))
    shown = lambda df, columns: F.concat_ws("|", *[F.coalesce(col(c).cast("string"), F.lit("")) for c in columns])
    line = lambda df, source, columns: df.select(F.lit(source).alias("source"), shown(df, columns).alias("line"))
    out = line(tables.read("history"), "history", ["terminal_id", "transaction_amt", "transaction_timestamp", "tran_date", "processing_date"])
    out = out.unionByName(line(tables.read("control"), "control", ["batch_number", "processing_date", "merchant_name", "etl_complete", "extract_start", "file_date"]))
    out = out.unionByName(line(missing, "gap", ["name", "day"]))
    for name in R.create_listing_views(tables.read("listing"), config, replace=True):
        view = spark.table(name)
        out = out.unionByName(line(view, name, view.columns))
        spark.catalog.dropTempView(name)  # the rows are bound; the session keeps no view
    return out
