"""Checked table-state operators (J-01..J-20)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.operators import control as O
from ledgerloom.sinks import files as S
from ledgerloom.sinks import tables as W
from ledgerloom.sources import ingest as I
from ledgerloom.workload.feeds import RUN_DATE, RUN_TS, Tables
from ledgerloom.workload.registry import query
from ledgerloom.workload.scratch import new_folder

col = F.col


@query("j01_next_date_files", "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT CAST(max(l_shipdate) AS DATE) + 1 FROM lineitem WHERE l_shipdate < TIMESTAMP '2000-03-01')")
def _j01(t: Tables):
    files = t.orders.select("o_orderkey", col("o_orderdate").cast("date").alias("file_date"))
    loaded = t.lineitem.where(col("l_shipdate") < "2000-03-01").select(col("l_shipdate").cast("date").alias("file_date"))
    return I.next_date_files(files, loaded).select("o_orderkey")


@query(
    "j02_above_group_high_water",
    """WITH h AS (SELECT CASE WHEN l_suppkey % 2 = 0 THEN l_suppkey ELSE -l_suppkey END AS g, max(CAST(l_shipdate AS DATE)) AS m FROM lineitem WHERE l_shipdate < TIMESTAMP '2001-01-01' GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey AS g FROM lineitem LEFT JOIN h ON h.g = l_suppkey WHERE h.m IS NULL OR CAST(l_shipdate AS DATE) > h.m""",
)
def _j02(t: Tables):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", col("l_suppkey").alias("g"), col("l_shipdate").cast("date").alias("file_date"))
    # the loaded part; odd suppliers are known there by another key, so they count as unseen
    target = rows.where(col("file_date") < F.lit(dt.date(2001, 1, 1))).withColumn("g", F.when(col("g") % 2 == 0, col("g")).otherwise(-col("g")))
    return I.above_group_high_water(rows, target, "g").select("l_orderkey", "l_linenumber", "l_partkey", "g")


@query(
    "j03_overlap_unseen",
    """WITH target AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2001-02-01' AND o_orderkey % 3 <> 0)
SELECT o_orderkey FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) FROM target) - INTERVAL 3 DAY AND o_orderdate NOT IN (SELECT o_orderdate FROM target)""",
)
def _j03(t: Tables):
    # the stand-in target lacks some loads, as one does after late files
    target = t.orders.where((col("o_orderdate") < "2001-02-01") & (col("o_orderkey") % 3 != 0))
    return I.overlap_unseen(t.orders, target, "o_orderdate").select("o_orderkey")


@query(
    "j05_replace_partitions",
    "SELECT CAST(year(o_orderdate) AS BIGINT) AS y, count(*) AS n, CAST(sum(CASE WHEN year(o_orderdate) >= 2000 THEN 1 ELSE 0 END) AS BIGINT) AS replaced FROM orders GROUP BY 1",
)
def _j05(t: Tables):
    path = new_folder(t.spark, "replace")
    rows = t.orders.select("o_orderkey", F.year("o_orderdate").alias("y"))
    rows.withColumn("mark", F.lit(0)).write.partitionBy("y").parquet(path)
    W.replace_partitions(rows.where(col("y") >= 2000).withColumn("mark", F.lit(1)), path, "y")
    return t.spark.read.parquet(path).groupBy("y").agg(F.count("*").alias("n"), F.sum("mark").alias("replaced"))


@query("j06_j09_insert_missing", "SELECT DISTINCT l_partkey AS card FROM lineitem WHERE l_partkey NOT IN (SELECT o_custkey FROM orders)")
def _j06(t: Tables):
    known = t.orders.select(col("o_custkey").alias("card"))
    return W.only_new(t.lineitem.select(col("l_partkey").alias("card")).distinct(), known, ["card"])


@query(
    "j07_update_from",
    """WITH u AS (SELECT l_orderkey AS k, max(l_returnflag) AS f FROM lineitem WHERE l_quantity > 30 GROUP BY 1) SELECT o_orderkey, CASE WHEN u.k IS NOT NULL THEN nullif(u.f, 'N') ELSE o_orderstatus END AS o_orderstatus FROM orders LEFT JOIN u ON u.k = o_orderkey""",
)
def _j07(t: Tables):
    u = t.lineitem.where(col("l_quantity") > 30).groupBy(col("l_orderkey").alias("o_orderkey")).agg(F.nullif(F.max("l_returnflag"), F.lit("N")).alias("o_orderstatus"))
    return W.updated_from(t.orders.select("o_orderkey", "o_orderstatus"), u, ["o_orderkey"], ["o_orderstatus"])


@query("j08_update_where", "SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, CASE WHEN o_totalprice > 300000 THEN o_orderstatus ELSE o_orderpriority END AS o_orderpriority FROM orders")
def _j08(t: Tables):
    rows = t.orders.select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice")
    return W.updated_where(rows, col("o_totalprice") > 300000, {"o_orderstatus": F.lit("X"), "o_orderpriority": col("o_orderstatus")}).drop("o_totalprice")


@query("j10_delete_where", "SELECT store_id FROM store WHERE NOT coalesce(site_name = 'Supplier#000000003', false)")
def _j10(t: Tables):
    return W.without(t.store, col("site_name") == "Supplier#000000003").select("store_id")


@query("j12_next_batch", "SELECT 'FEE' AS lookup, 'FTLF' || lpad(CAST(count(*) + 1 AS VARCHAR), 9, '0') AS batch_number FROM orders")
def _j12(t: Tables):
    used = t.orders.agg(F.concat(F.lit("FTLF"), F.lpad(F.count("*").cast("string"), 9, "0")).alias("last_batch")).withColumn("lookup", F.lit("FEE"))
    return O.next_batch(used, "FEE")


@query(
    "j13_control_rows",
    """SELECT 'B1' AS batch_number, '2001-07-15' AS processing_date, n.n_name AS merchant_name, 'true' AS etl_complete, CAST(NULL AS VARCHAR) AS extract_wf_complete,
 CAST(coalesce(min(o_orderdate), TIMESTAMP '2001-07-15 06:30:00') AS VARCHAR) AS extract_start, CAST(coalesce(max(o_orderdate), TIMESTAMP '2001-07-15 06:30:00') AS VARCHAR) AS extract_end, '2001-07-15 06:30:00' AS file_date, CAST(NULL AS VARCHAR) AS remarks
 FROM nation n LEFT JOIN customer ON CASE c_nationkey WHEN 3 THEN 4 ELSE c_nationkey END = n_nationkey LEFT JOIN orders ON o_custkey = c_custkey GROUP BY n.n_name""",
)
def _j13(t: Tables):
    nation = F.when(col("c_nationkey") == 3, 4).otherwise(col("c_nationkey"))  # one nation without orders
    sold = t.orders.join(t.customer, col("o_custkey") == col("c_custkey")).join(t.nation, nation == col("n_nationkey"))
    return O.control_rows(sold.select(col("n_name").alias("name"), "o_orderdate"), t.nation.select(col("n_name").alias("name")), "name", "o_orderdate", "B1", RUN_TS)


_CTRL = """c AS (SELECT o_orderkey AS k, 'B' || CAST(o_custkey AS VARCHAR) AS batch_number, 'M' || CAST(o_orderkey AS VARCHAR) AS merchant_name, o_orderstatus <> 'P' AS etl_complete, CASE o_orderpriority WHEN '1-URGENT' THEN true WHEN '2-HIGH' THEN false END AS done FROM orders)"""


def _control(t: Tables):
    done = F.when(col("o_orderpriority") == "1-URGENT", True).when(col("o_orderpriority") == "2-HIGH", False)
    return t.orders.select(
        F.concat(F.lit("B"), col("o_custkey").cast("string")).alias("batch_number"),
        F.concat(F.lit("M"), col("o_orderkey").cast("string")).alias("merchant_name"),
        (col("o_orderstatus") != "P").alias("etl_complete"),
        done.alias("extract_wf_complete"),
        F.lit(None).cast("string").alias("remarks"),
    )


@query("j14_pending_extracts", f"WITH {_CTRL} SELECT batch_number, merchant_name FROM c WHERE etl_complete AND done IS NULL")
def _j14(t: Tables):
    return O.pending(_control(t)).select("batch_number", "merchant_name")


@query(
    "j14_closed_after_export",
    f"WITH {_CTRL} SELECT batch_number, merchant_name, CAST(CASE WHEN etl_complete AND done IS NULL THEN true ELSE done END AS VARCHAR) AS extract_wf_complete, CASE WHEN etl_complete AND done IS NULL THEN 'sent' END AS remarks FROM c",
)
def _j14c(t: Tables):
    control = _control(t)
    return O.closed(control, O.pending(control), True, "sent").drop("etl_complete")


@query(
    "j15_audit_batch",
    """SELECT d.division, s.record_type, s.filename, 'B7' AS batch_number, CAST(min(coalesce(w.last_execution_time, TIMESTAMP '1900-01-01')) AS VARCHAR) AS cutoff_start,
 CAST(max(CAST(DATE '2001-07-15' + w.day_lag AS TIMESTAMP) + to_minutes(CAST(w.settlement_cutoff // 100 * 60 + w.settlement_cutoff % 100 AS INT))) AS VARCHAR) AS cutoff_end, CAST(min(s.transaction_timestamp) AS VARCHAR) AS first_trans_time, CAST(max(s.transaction_timestamp) AS VARCHAR) AS last_trans_time,
 count(*) AS no_trans_posted, CAST(sum(s.settlement_cents) AS BIGINT) AS amount_posted, CAST(sum(s.discount_cents) AS BIGINT) AS discount_amount
 FROM settlement_std s JOIN store d ON d.store_id = s.store_id JOIN settlement_window w ON w.division = d.division AND w.is_active = 'Y' AND w.division_type <> 'PARTNER' WHERE s.setlmnt_result_file IS NULL GROUP BY ALL""",
)
def _j15(t: Tables):
    from ledgerloom.functions import dates as D

    w = t.settlement_window.where((col("is_active") == "Y") & (col("division_type") != "PARTNER"))
    rows = t.settlement_std.where(col("setlmnt_result_file").isNull()).join(t.store.select("store_id", "division"), "store_id").join(w, "division")
    start = F.coalesce("last_execution_time", F.lit("1900-01-01").cast("timestamp_ntz"))
    end = D.cutoff_on(F.date_add(F.lit(RUN_DATE), col("day_lag")), col("settlement_cutoff"))
    return O.audit_batch(rows, ["division", "record_type", "filename"], "transaction_timestamp", "settlement_cents", "discount_cents", start, end, "B7")


@query(
    "j16_mark_processed",
    """WITH p AS (SELECT tran_uid, max('OUT_' || record_type) AS f FROM settlement_std WHERE setlmnt_result_file IS NULL AND tran_uid NOT LIKE 'QP%' GROUP BY 1)
SELECT s.tran_uid, s.settlement_cents, CASE WHEN p.f IS NOT NULL THEN p.f ELSE s.setlmnt_result_file END AS setlmnt_result_file, CASE WHEN p.f IS NOT NULL THEN '2001-07-15' END AS posting_date FROM settlement_std s LEFT JOIN p ON p.tran_uid = s.tran_uid""",
)
def _j16(t: Tables):
    rows = t.settlement_std.select("tran_uid", "settlement_cents", "setlmnt_result_file", F.lit(None).cast("date").alias("posting_date"), "record_type")
    posted = rows.where(col("setlmnt_result_file").isNull() & ~col("tran_uid").startswith("QP")).select("tran_uid", F.concat(F.lit("OUT_"), col("record_type")).alias("result_file"))
    return O.mark_processed(rows.drop("record_type"), posted, RUN_TS)


@query(
    "j17_advance_watermark",
    """WITH h AS (SELECT store_id, min(m) AS m FROM (SELECT store_id, left(tran_uid, 2) AS src, max(transaction_timestamp) AS m FROM settlement_std WHERE tran_uid NOT LIKE 'QP%' GROUP BY ALL) GROUP BY 1)
SELECT w.store_id, CAST(coalesce(h.m, w.last_execution_time) AS VARCHAR) AS last_execution_time FROM window_by_store w LEFT JOIN h ON h.store_id = w.store_id""",
)
def _j17(t: Tables):
    facts = t.settlement_std.where(~col("tran_uid").startswith("QP"))
    return O.advance_watermark(t.window_by_store, facts, "store_id", "transaction_timestamp").select("store_id", "last_execution_time")


@query("j18_file_sequence_of_day", "SELECT coalesce(max(l_linenumber) FILTER (CAST(l_shipdate AS DATE) = DATE '2001-07-15') + 1, 1) AS file_sequence_number, '2001-07-15' AS file_transmission_date FROM lineitem")
def _j18(t: Tables):
    history = t.lineitem.select(col("l_shipdate").cast("date").alias("file_transmission_date"), col("l_linenumber").alias("file_sequence_number"))
    return O.file_sequence(history, RUN_DATE)


@query(
    "j19_entity_file_names",
    """WITH e AS (SELECT company_code, row_number() OVER (ORDER BY company_code) - 1 AS seq FROM (SELECT DISTINCT company_code FROM sap_map WHERE active_flag <> 'N'))
SELECT company_code, seq AS entity_seq, 'LEDGER_' || strftime(TIMESTAMP '2001-07-15 06:30:00' + to_seconds(seq), '%Y%m%d%H%M%S') AS file_name FROM e""",
)
def _j19(t: Tables):
    seq = S.entity_sequence(t.sap_map.where(col("active_flag") != "N"), "company_code")
    return seq.select("company_code", "entity_seq", S.stamped_name("LEDGER", RUN_TS, col("entity_seq")).alias("file_name"))


@query("j20_validity_columns", "SELECT c_custkey, '2001-07-15' AS effective_date, CAST(NULL AS VARCHAR) AS expiry_date, 1 AS is_current FROM customer")
def _j20(t: Tables):
    return W.with_validity(t.customer.select("c_custkey"), RUN_DATE)


@query("j21_audit_event", "SELECT 'orders' AS job, 'OK' AS status, count(*) AS rows, 90000 AS duration_ms FROM orders")
def _j21(t: Tables):
    event = W.audit_event(t.spark, "orders", "OK", RUN_TS, RUN_TS + dt.timedelta(seconds=90))
    counted = t.orders.agg(F.count("*")).scalar()
    return event.select("job", "status", counted.alias("rows"), "duration_ms")


