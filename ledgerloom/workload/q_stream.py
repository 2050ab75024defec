"""Checked near-real-time and streaming operators (L-01..L-05)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.sinks.versions import VersionedTables
from ledgerloom.sources.tables import fiscal_calendar
from ledgerloom.streaming import arrivals as A
from ledgerloom.streaming import nrt as N
from ledgerloom.workload.feeds import STORE_WIDTH, Tables
from ledgerloom.workload.registry import query
from ledgerloom.workload.scratch import new_folder

col = F.col
NOW = dt.datetime(2024, 1, 28, 12, 0, 0)


@query(
    "l01_nrt_tail",
    """WITH b AS (SELECT * REPLACE (CASE WHEN user_id % 10 = 9 THEN -user_id ELSE user_id END AS user_id) FROM events WHERE ts < TIMESTAMP '2024-01-20'), h AS (SELECT user_id, max(ts) AS m FROM b GROUP BY 1)
SELECT event_id, 'BATCH' AS src_type FROM b UNION ALL SELECT e.event_id, 'NRT' FROM events e LEFT JOIN h ON h.user_id = e.user_id WHERE (h.m IS NULL OR e.ts > h.m) AND e.ts <= TIMESTAMP '2024-01-28 12:00:00' AND e.ts >= TIMESTAMP '2024-01-14 12:00:00'""",
)
def _l01(t: Tables):
    # the batch side lags; it knows some users by another key, so their live rows are all new
    batch = t.events.where(col("ts") < "2024-01-20").withColumn("user_id", F.when(col("user_id") % 10 == 9, -col("user_id")).otherwise(col("user_id")))
    return A.nrt_tail(batch, t.events, "user_id", "ts", NOW, floor_days=14).select("event_id", "src_type")


def _arriving(t: Tables) -> str:
    """The events as files of one day each."""
    path = new_folder(t.spark, "landing")
    day = F.date_format("ts", "yyyyMMdd")
    t.events.withColumn("day", day).repartition("day").write.partitionBy("day").parquet(path)
    return path


@query("l02_file_arrival_ingest", "SELECT event_id, user_id, strftime(ts, '%Y-%m-%d') AS day FROM events")
def _l02(t: Tables):
    path, target, state = new_folder(t.spark, "text"), new_folder(t.spark, "landed"), new_folder(t.spark, "state")
    lines = t.events.select(F.concat_ws(",", col("event_id").cast("string"), col("user_id").cast("string"), F.date_format("ts", "yyyy-MM-dd")).alias("value"))
    lines.repartition(4).write.text(path)

    def parse(batch):
        f = F.split("value", ",")
        return batch.select("file_name", f[0].cast("long").alias("event_id"), f[1].cast("long").alias("user_id"), f[2].alias("day"))

    for _ in range(2):  # the second run finds no new files
        A.ingest_arrivals(A.arriving_lines(t.spark, path, 2), parse, target, state)
    return t.spark.read.parquet(target).select("event_id", "user_id", "day")


@query("l03_late_eligibility", "SELECT event_id FROM events WHERE ts > TIMESTAMP '2024-01-10' + to_days(CAST(user_id % 3 AS INT)) AND ts <= TIMESTAMP '2024-01-26 18:30:00'")
def _l03(t: Tables):
    from ledgerloom.functions import cards as K

    inside = K.in_settlement_window(col("ts"), F.lit("2024-01-10 05:00:00").cast("timestamp_ntz"), (col("user_id") % 3).cast("int"), F.lit("2024-01-01").cast("date"), F.lit(NOW.date()), F.lit(-2), F.lit(1830))
    return t.events.where(inside).select("event_id")


@query("l04_stream_dedupe", "SELECT event_id, user_id FROM events")
def _l04(t: Tables):
    out, state = new_folder(t.spark, "unique"), new_folder(t.spark, "state")
    twice = new_folder(t.spark, "twice")
    t.events.unionByName(t.events).repartition(4).write.parquet(twice)
    stream = A.arriving_rows(t.spark, twice, t.events.schema).withColumn("ts", col("ts").cast("timestamp"))
    unique = A.unique_stream(stream, ["event_id"], "ts", "60 days").select("event_id", "user_id")
    q = unique.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
    q.awaitTermination()
    return t.spark.read.parquet(out).select("event_id", "user_id")


@query(
    "l05_stream_windows",
    """SELECT CAST(time_bucket(INTERVAL 1 HOUR, ts) AS VARCHAR) AS period_start, event_type, count(*) AS rows, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY ALL""",
)
def _l05(t: Tables):
    path, out, state = _arriving(t), new_folder(t.spark, "windows"), new_folder(t.spark, "state")
    stream = A.arriving_rows(t.spark, path, t.events.schema).withColumn("ts", col("ts").cast("timestamp"))
    totals = A.windowed_totals(stream, "ts", ["event_type"], F.round(col("value") * 100).cast("long"), "1 hour", "40 days")

    def upsert(batch, batch_id):
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out)

    q = totals.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", state).trigger(availableNow=True).start()
    q.awaitTermination()
    newest = t.spark.read.parquet(out)
    last = newest.groupBy("period_start", "event_type").agg(F.max_by(F.struct("rows", "total"), "batch_id").alias("r"))
    return last.select(col("period_start").cast("timestamp_ntz").alias("period_start"), "event_type", "r.rows", "r.total")


_FISCAL = """e AS (SELECT CAST(ts AS DATE) AS d, event_type, CAST(round(value * 100) AS BIGINT) AS v FROM events),
f AS (SELECT *, CAST(CASE WHEN d >= date_trunc('week', make_date(year(d), 6, 30)) THEN date_trunc('week', make_date(year(d), 6, 30)) ELSE date_trunc('week', make_date(year(d) - 1, 6, 30)) END AS DATE) AS fy FROM e),
g AS (SELECT *, (d - fy) // 7 + 1 AS w FROM f)"""


@query(
    "l05_fiscal_weeks",
    f"WITH {_FISCAL} SELECT CAST(CAST(date_trunc('week', d) AS DATE) AS VARCHAR) AS fw_start_date, w AS wofy, 1 + len(list_filter([4, 8, 13, 17, 21, 26, 30, 34, 39, 43, 47], lambda x: x < w)) AS pofy, event_type, count(*) AS rows, CAST(sum(v) AS BIGINT) AS total FROM g GROUP BY ALL",
)
def _l05_fiscal(t: Tables):
    """Fiscal weeks of a stream in which every fifth row arrives nine days late."""
    spark = t.spark
    path, out, state = new_folder(spark, "late"), new_folder(spark, "weeks"), new_folder(spark, "state")
    arrival = col("ts") + F.make_dt_interval(days=F.when(col("event_id") % 5 == 0, 9).otherwise(0))
    t.events.withColumn("arrival", arrival).repartitionByRange(4, "arrival").drop("arrival").write.parquet(path)
    span = t.events.agg(F.min("ts").cast("date").alias("a"), F.max("ts").cast("date").alias("b"))
    calendar = fiscal_calendar(span.select(F.explode(F.sequence(F.date_sub("a", 7), F.date_add("b", 7))).alias("day"))).withColumn("fw_end_date", F.date_add("fw_start_date", 6))
    stream = A.arriving_rows(spark, path, t.events.schema, max_files=1).withColumn("ts", col("ts").cast("timestamp"))
    keys = ["fw_start_date", "wofy", "pofy", "event_type"]
    totals = A.calendar_totals(stream, "ts", calendar, keys[:3], "fw_end_date", ["event_type"], F.round(col("value") * 100).cast("long"), "60 days")

    def upsert(batch, batch_id):
        batch.withColumn("batch_id", F.lit(batch_id).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(out)

    totals.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    last = spark.read.parquet(out).groupBy(*keys).agg(F.max_by(F.struct("rows", "total"), "batch_id").alias("r"))
    return last.select(*keys, "r.rows", "r.total")


_NOW, _CUT, _FROM = dt.datetime(2001, 7, 15, 6, 30), "2001-06-20", "2001-06-05"


@query(
    "m_nrt_fees",
    f"""WITH a AS (SELECT 'TC' AS source, 'TC_' || tran_uid AS tran_uid, store_id, tstamp_trans, card_type, kind, approval, amount_cents, CASE WHEN processing_fees = 0 THEN load_time + INTERVAL 30 DAY ELSE load_time END AS arrival FROM billing
 UNION ALL SELECT 'CY', 'CY_' || CAST(a.tran_uid AS VARCHAR) || '_' || a.transaction_type || '_' || strftime(strptime(CAST(a.transaction_timestamp AS VARCHAR), '%Y%m%d%H%M%S'), '%Y%m%dT%H%M%S'), left(coalesce(a.terminal_id, k.value), 10), strptime(CAST(a.transaction_timestamp AS VARCHAR), '%Y%m%d%H%M%S'), a.card_type, a.transaction_type, CASE WHEN coalesce(a.transaction_approval_status, 0) = 0 THEN 'A' ELSE 'D' END, a.transaction_amount, CAST(a.file_date AS TIMESTAMP) + INTERVAL 1 DAY
 FROM acquirer_txn a LEFT JOIN key_value k ON k.attribute = 'merchant-terminal' AND upper(trim(k.key)) = a.merchant_id),
b AS (SELECT * FROM a WHERE arrival <= TIMESTAMP '{_CUT}'), h AS (SELECT store_id, max(tstamp_trans) AS m FROM b GROUP BY 1),
x AS (SELECT *, 'BATCH' AS src_type FROM b UNION ALL SELECT l.*, CASE WHEN h.m IS NULL OR l.tstamp_trans > h.m THEN 'NRT' ELSE 'LATE' END FROM a l LEFT JOIN h ON h.store_id = l.store_id
 WHERE l.arrival > TIMESTAMP '{_FROM}' AND l.tstamp_trans <= TIMESTAMP '{_NOW}' AND (h.m IS NULL OR l.tstamp_trans > h.m OR l.tran_uid NOT IN (SELECT tran_uid FROM b))),
p AS (SELECT 'TC_' || split_part(tran_uid, '_', 2) || '-' || split_part(tran_uid, '_', 3) AS uid, max(CAST(transaction_timestamp AS DATE) + 2) AS posting_date FROM settlement_std WHERE setlmnt_result_file IS NOT NULL AND tran_uid LIKE 'TC%' GROUP BY 1)
SELECT x.source, x.tran_uid, x.store_id, CAST(x.tstamp_trans AS VARCHAR) AS tstamp_trans, x.card_type, x.kind, x.approval, x.amount_cents, x.src_type, CAST(p.posting_date AS VARCHAR) AS settlement_date,
 coalesce(CASE r.proc_fee_code WHEN 'ALL' THEN CAST(x.amount_cents AS DOUBLE) / 100 * r.proc_fee_percent / 100 + r.proc_fee_fixed WHEN 'FIXED' THEN r.proc_fee_fixed WHEN 'PERCENT' THEN CAST(x.amount_cents AS DOUBLE) / 100 * r.proc_fee_percent / 100 ELSE 0 END, 0)::DOUBLE AS processing_fee
FROM x LEFT JOIN store s ON s.store_id = x.store_id LEFT JOIN rate_card r ON r.merchant = s.ratecard_group AND r.card_type = x.card_type AND CAST(x.tstamp_trans AS DATE) BETWEEN r.from_date AND coalesce(r.to_date, DATE '9999-12-31') LEFT JOIN p ON p.uid = x.tran_uid""",
)
def _nrt_fees(t: Tables):
    """Two sources, some rows a month late, one wrong rate that is put right after the rows have landed."""
    spark = t.spark
    late = F.when(col("processing_fees") == 0, 30).otherwise(0)
    switch = N.switch_live(t.billing, col("load_time") + F.make_dt_interval(days=late))
    online = N.online_live(t.acquirer_txn, t.key_value, STORE_WIDTH)
    online = online.withColumn("arrival", F.date_add(col("tstamp_trans").cast("date"), 1).cast("timestamp_ntz"))
    every = switch.unionByName(online)
    right = t.rate_card
    wrong = right.withColumn("proc_fee_percent", F.when(col("to_date").isNull() & (col("card_type") == "DEBIT"), col("proc_fee_percent") * 2).otherwise(col("proc_fee_percent")))
    part = F.split("tran_uid", "_")
    posted = t.settlement_std.where(col("setlmnt_result_file").isNotNull() & col("tran_uid").startswith("TC"))
    posted = posted.select(F.concat(F.lit("TC_"), part[1], F.lit("-"), part[2]).alias("tran_uid"), F.date_add(col("transaction_timestamp").cast("date"), 2).alias("posting_date"))

    tables = VersionedTables(spark, new_folder(spark, "live"))
    path, state = new_folder(spark, "landing"), new_folder(spark, "state")
    every.where(col("arrival") > F.lit(_FROM).cast("timestamp_ntz")).repartitionByRange(4, "arrival").drop("arrival").write.parquet(path)
    for _ in range(2):  # the second run finds nothing new
        stream = A.arriving_rows(spark, path, every.drop("arrival").schema, max_files=2)
        N.land(stream, tables, t.store, wrong, posted, "live", state)
    changed = right.where(col("to_date").isNull() & (col("card_type") == "DEBIT"))
    N.reprice(tables, t.store, right, changed, "rates")
    batch = N.dated(N.priced(every.where(col("arrival") <= F.lit(_CUT).cast("timestamp_ntz")).drop("arrival"), t.store, right), posted)
    return N.fact(batch, tables.read("live").drop("day"), _NOW).drop("merchant")
