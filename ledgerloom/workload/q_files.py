"""Checked sources and sinks (A, B): given tables written as text and read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import text as X
from ledgerloom.sinks import files as S
from ledgerloom.sinks import tables as W
from ledgerloom.sources import ingest as I
from ledgerloom.sources import tables as TB
from ledgerloom.sources import text_files as R
from ledgerloom.workload.feeds import RUN_TS, Tables
from ledgerloom.workload.registry import query
from ledgerloom.workload.scratch import new_folder

col = F.col


def _written(t: Tables, lines, what: str) -> str:
    path = new_folder(t.spark, what)
    lines.select("value").write.text(path)
    return path


def _order_line():
    return S.fixed_width_line(
        [
            S.Slot(F.lit("01"), 2),
            S.Slot(col("o_orderkey"), 12, right=True, fill="0"),
            S.Slot(col("o_orderpriority"), 18),
            S.Slot(F.round(col("o_totalprice") * 100).cast("long"), 14, right=True, fill="0"),
            S.Slot(F.date_format("o_orderdate", "yyyyMMdd"), 8),
        ]
    )


_ORDER_FIELDS = [R.Field("order_key", 2, 14), R.Field("priority", 14, 32, strip=True), R.Field("cents", 32, 46), R.Field("day", 46, 54)]


@query("a01_read_fixed_width", "SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS order_key, o_orderpriority AS priority, lpad(CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR), 14, '0') AS cents, strftime(o_orderdate, '%Y%m%d') AS day FROM orders")
def _a01(t: Tables):
    other = t.customer.select(F.concat(F.lit("99"), col("c_name")).alias("value"))
    path = _written(t, t.orders.select(_order_line().alias("value")).unionByName(other), "fixed")
    return R.read_fixed_width(t.spark, path, _ORDER_FIELDS, "01").drop("file_name")


_PARTS = {
    "01": [R.Field("priority", 14, 32, strip=True)],
    "02": [R.Field("cents", 14, 28)],
    "10": [R.Field("status", 14, 15)],
}


def _parts(t: Tables):
    """Every order on three lines, but the last line is missing for pending orders."""
    key = F.lpad(col("o_orderkey").cast("string"), 12, "0")
    line = F.explode(
        F.array(
            F.concat(F.lit("01"), key, F.rpad("o_orderpriority", 18, " ")),
            F.concat(F.lit("02"), key, F.lpad(F.round(col("o_totalprice") * 100).cast("long").cast("string"), 14, "0")),
            F.when(col("o_orderstatus") != "P", F.concat(F.lit("10"), key, col("o_orderstatus"))),
        )
    )
    return t.orders.select(line.alias("value")).where(col("value").isNotNull())


_A02 = "SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS counter, o_orderpriority AS priority, lpad(CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR), 14, '0') AS cents, o_orderstatus AS status FROM orders WHERE o_orderstatus <> 'P'"


def _assembled(t: Tables, mode: str):
    lines = R.read_lines(t.spark, _written(t, _parts(t).coalesce(1), "parts"))
    return R.assemble_multipart(lines, _PARTS, R.Field("counter", 2, 14), R.Field("part", 0, 2), mode).drop("file_name")


@query("a02_assemble_multipart_aggregate", _A02)
def _a02(t: Tables):
    return _assembled(t, "fail")


@query("a02_assemble_multipart_join", _A02)
def _a02j(t: Tables):
    return _assembled(t, "join")


@query("a03_a04_drop_edge_lines", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, c_mktsegment AS segment FROM customer")
def _a03(t: Tables):
    # one file with a banner, a header and a footer; rows keep their written order
    body = t.customer.select(F.lit(2).alias("rank"), col("c_custkey").alias("k"), F.concat_ws(" , ", col("c_custkey").cast("string"), "c_name", "c_mktsegment").alias("value"))
    edges = TB.local_table(t.spark, "rank int, k long, value string", [(0, 0, "BANNER"), (1, 0, "id,name,segment"), (3, 0, "FOOTER")])
    path = new_folder(t.spark, "edged")
    body.unionByName(edges).repartition(1).sortWithinPartitions("rank", "k").select("value").write.text(path)
    return R.read_delimited_skip(t.spark, path, ["id", "name", "segment"]).drop("file_name")


@query("a05_read_csv", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def _a05(t: Tables):
    path = new_folder(t.spark, "csv")
    t.supplier.select("s_suppkey", "s_name", "s_acctbal").write.option("sep", "|").option("header", True).csv(path)
    schema = T.StructType.fromDDL("s_suppkey long, s_name string, s_acctbal double")
    return R.read_csv(t.spark, path, schema, "|", header=True).drop("file_name")


@query("a06_curate_csv", "SELECT p_partkey, p_name, p_size FROM part")
def _a06(t: Tables):
    body = t.part.select(F.concat_ws("|", F.lit("D"), col("p_partkey").cast("string"), F.concat(col("p_name"), F.lit(" ")), col("p_size").cast("string")).alias("value"))
    edges = TB.local_table(t.spark, "value string", [("H|parts",), ("T|9",)])
    lines = R.read_lines(t.spark, _written(t, body.unionByName(edges), "marked"))
    schema = T.StructType.fromDDL("kind string, p_partkey long, p_name string, p_size long")
    return R.curate_csv(lines, schema, F.col("value").startswith("D|"), "|", strip=True).select("p_partkey", "p_name", "p_size")


@query("a07_parquet_append", "SELECT n_nationkey, n_name, count(*) AS customers FROM customer JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL UNION ALL SELECT n_nationkey, n_name, count(*) FROM supplier JOIN nation ON n_nationkey = s_nationkey GROUP BY ALL")
def _a07(t: Tables):
    path = new_folder(t.spark, "appended")
    schema = "n_nationkey int, n_name string, customers long"
    for df, key in ((t.customer, "c_nationkey"), (t.supplier, "s_nationkey")):
        df.join(t.nation, col("n_nationkey") == col(key)).groupBy("n_nationkey", "n_name").agg(F.count("*").alias("customers")).write.mode("append").parquet(path)
    return TB.read_parquet(t.spark, path, T.StructType.fromDDL(schema))


@query("a08_read_sheet", "SELECT CAST(p_partkey AS VARCHAR) AS part_key, p_brand AS brand_name FROM part")
def _a08(t: Tables):
    path = new_folder(t.spark, "sheet")
    t.part.select(col("p_partkey").alias("Part Key"), col("p_brand").alias("Brand Name")).write.option("header", True).csv(path)
    return R.read_sheet(t.spark, path)


@query("a09_external_text", "SELECT left(p_type, 1) AS kind, count(*) AS lines FROM part GROUP BY 1")
def _a09(t: Tables):
    lines = R.read_lines(t.spark, _written(t, t.part.select(col("p_type").alias("value")), "external"))
    return lines.where(col("file_name").isNotNull()).groupBy(F.left("value", F.lit(1)).alias("kind")).agg(F.count("*").alias("lines"))


@query(
    "a10_a11_a12_typed_projection",
    """SELECT '2001-07-15' AS file_date, 'orders_20010715.csv' AS file_name, '2001-07-15 06:30:00' AS load_time, 'P1' AS payload_id, o_orderkey AS id, CAST(CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderdate END AS VARCHAR) AS placed,
 CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS DOUBLE) / 100 END AS amount FROM orders""",
)
def _a10(t: Tables):
    cents = F.round(col("o_totalprice") * 100).cast("long").cast("decimal(18,2)") / 100
    text = t.orders.select(
        F.lit("orders_20010715.csv").alias("file_name"),
        col("o_orderkey").cast("string").alias("id"),
        F.when(col("o_orderkey") % 10 == 0, "unknown").otherwise(F.date_format("o_orderdate", "yyyyMMddHHmmss")).alias("placed"),
        F.date_format("o_orderdate", "yyyyMMdd").alias("day"),
        F.when(col("o_orderkey") % 7 == 0, "n/a").otherwise(cents.cast("decimal(18,2)").cast("string")).alias("amount"),
    )
    audited = I.with_audit(text, I.file_date_from_name(col("file_name")), RUN_TS, "P1")
    target = T.StructType.fromDDL("id long, placed timestamp_ntz, day date, amount decimal(38,9)")
    return I.curate(audited, "switch", target)


@query(
    "a13_file_date_from_name",
    "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS plain, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS gift, '20' || strftime(o_orderdate, '%y-%m-%d') AS scheme, CAST(NULL AS VARCHAR) AS none FROM orders",
)
def _a13(t: Tables):
    d = lambda f: F.date_format("o_orderdate", f)
    return t.orders.select(
        "o_orderkey",
        I.file_date_from_name(F.concat(F.lit("feed_"), d("yyyyMMdd"), F.lit(".csv"))).alias("plain"),
        I.file_date_from_name(F.concat(F.lit("g_"), d("yyyy_MM_dd"), F.lit("_10203040.csv")), "gift").alias("gift"),
        I.file_date_from_name(F.concat(F.lit("X.AR.T1.D"), d("yyMMdd"), F.lit(".E1")), "scheme").alias("scheme"),
        I.file_date_from_name(F.lit("nodate.csv")).alias("none"),
    )


@query("a14_file_not_loaded", "SELECT l_orderkey, l_linenumber, l_returnflag AS file_name FROM lineitem WHERE l_returnflag NOT IN (SELECT CASE o_orderstatus WHEN 'F' THEN 'R' ELSE 'Z' END FROM orders)")
def _a14(t: Tables):
    loaded = t.orders.select(F.when(col("o_orderstatus") == "F", "R").otherwise("Z").alias("file_name"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", col("l_returnflag").alias("file_name"))
    return I.not_loaded(rows, loaded)


@query("a15_empty_file_audit", "SELECT n_name AS file_name, count(c_custkey) AS rows, CASE WHEN count(c_custkey) = 0 THEN 'true' ELSE 'false' END AS is_empty FROM nation LEFT JOIN customer ON CASE c_nationkey WHEN 3 THEN 4 ELSE c_nationkey END = n_nationkey GROUP BY 1")
def _a15(t: Tables):
    rows = t.customer.join(t.nation, col("n_nationkey") == F.when(col("c_nationkey") == 3, 4).otherwise(col("c_nationkey"))).select(col("n_name").alias("file_name"))
    return I.empty_file_audit(t.nation.select(col("n_name").alias("file_name")), rows)


@query("a17_a18_spine_over_days", "WITH s AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS day) SELECT CAST(day AS VARCHAR) AS day, count(o_orderkey) AS n FROM s LEFT JOIN orders ON CAST(o_orderdate AS DATE) = day GROUP BY s.day")
def _a18(t: Tables):
    import datetime as dt

    spine = TB.date_spine(t.spark, dt.date(1995, 1, 1), dt.date(2001, 12, 31))
    per = t.orders.groupBy(col("o_orderdate").cast("date").alias("day")).agg(F.count("*").alias("n"))
    return spine.join(per, "day", "left").select("day", F.coalesce("n", F.lit(0)).alias("n"))


@query("a19_row_literals", "SELECT o_orderkey, v.label FROM orders JOIN (VALUES ('1-URGENT', 'now'), ('5-LOW', 'later')) v(p, label) ON v.p = o_orderpriority")
def _a19(t: Tables):
    labels = TB.local_table(t.spark, "o_orderpriority string, label string", [("1-URGENT", "now"), ("5-LOW", "later")])
    return t.orders.join(labels, "o_orderpriority").select("o_orderkey", "label")


@query("b03_append_with_column_list", "SELECT o_orderkey AS id, o_orderstatus AS status, CAST(NULL AS VARCHAR) AS remark FROM orders UNION ALL SELECT c_custkey, CAST(NULL AS VARCHAR), c_name FROM customer")
def _b03(t: Tables):
    target = TB.local_table(t.spark, "id long, status string, remark string", [])
    a = W.conform(t.orders.select(col("o_orderkey").alias("id"), col("o_orderstatus").alias("status")), target)
    return a.unionByName(W.conform(t.customer.select(col("c_name").alias("remark"), col("c_custkey").alias("id")), target))


@query("b04_append_partitioned", "SELECT CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS day, count(*) AS n, max(o_orderkey) AS newest FROM orders GROUP BY 1")
def _b04(t: Tables):
    path = new_folder(t.spark, "by_day")
    by_month = t.orders.withColumn("day", F.date_trunc("month", "o_orderdate").cast("date"))
    W.append_partitioned(by_month.select("day", "o_orderkey"), path, "day", files_per_value=2)
    return t.spark.read.parquet(path).groupBy("day").agg(F.count("*").alias("n"), F.max("o_orderkey").alias("newest"))


@query("b07_export_delimited", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name FROM supplier")
def _b07(t: Tables):
    path = new_folder(t.spark, "export")
    S.export_delimited(t.supplier.select("s_suppkey", "s_name"), path, "|", True)
    S.write_marker(t.spark, path, "_export.lck")
    return t.spark.read.option("sep", "|").option("header", True).csv(path)


_HDT = """WITH d AS (SELECT s_nationkey AS file_key, l_orderkey, l_linenumber, l_partkey, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem JOIN supplier ON l_suppkey = s_suppkey)
SELECT 'F' || CAST(file_key AS VARCHAR) AS file_name, 'H' AS record_type, 0 AS line_rank, CAST(NULL AS BIGINT) AS order_key, 'HEADER' AS text, CAST(NULL AS BIGINT) AS amount FROM d GROUP BY file_key
UNION ALL SELECT 'F' || CAST(file_key AS VARCHAR), 'D', 1, l_orderkey, CAST(l_partkey AS VARCHAR), cents FROM d
UNION ALL SELECT 'F' || CAST(file_key AS VARCHAR), 'T', 2, CAST(NULL AS BIGINT), CAST(count(*) AS VARCHAR), CAST(sum(cents) AS BIGINT) FROM d GROUP BY file_key"""


def _hdt(t: Tables):
    supplier = t.supplier.select(col("s_suppkey").alias("l_suppkey"), F.concat(F.lit("F"), col("s_nationkey").cast("string")).alias("file_name"))
    rows = t.lineitem.join(supplier, "l_suppkey")
    detail = rows.select("file_name", col("l_orderkey").alias("order_key"), col("l_partkey").cast("string").alias("text"), F.round(col("l_extendedprice") * 100).cast("long").alias("amount"))
    tail = S.trailer(detail, ["file_name"], col("amount"), "n", "amount").select("file_name", col("n").cast("string").alias("text"), "amount")
    header = tail.select("file_name", F.lit("HEADER").alias("text"))
    return S.file_lines(header, detail, tail)


@query("b09_header_detail_trailer", _HDT)
def _b09(t: Tables):
    return _hdt(t).select("file_name", "record_type", "line_rank", "order_key", "text", "amount")


@query(
    "b10_fixed_width_lines",
    """SELECT o_orderkey, '01' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') || rpad(o_orderpriority, 18, ' ') || lpad(CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR), 14, '0') || strftime(o_orderdate, '%Y%m%d') AS line FROM orders""",
)
def _b10(t: Tables):
    return t.orders.select("o_orderkey", _order_line().alias("line"))


@query("b10_ordered_text_files", f"SELECT file_name, count(*) AS lines, max(record_type) AS last_kind FROM ({_HDT}) GROUP BY 1")
def _b10w(t: Tables):
    path = new_folder(t.spark, "lines")
    rows = _hdt(t).withColumn("line", F.concat_ws("|", "record_type", F.coalesce(col("order_key").cast("string"), F.lit("")), "text"))
    S.write_lines(rows, path, "file_name", ["line_rank", "order_key", "text"])
    back = t.spark.read.option("lineSep", "\r\n").text(path)
    return back.groupBy("file_name").agg(F.count("*").alias("lines"), F.max(F.left("value", F.lit(1))).alias("last_kind"))


@query("b11_view", "SELECT c_custkey, c_mktsegment FROM customer")
def _b11(t: Tables):
    W.create_view(t.customer, "ledgerloom_customers", ["c_custkey", "c_mktsegment"])
    out = t.spark.sql("SELECT * FROM ledgerloom_customers")
    t.spark.catalog.dropTempView("ledgerloom_customers")  # the rows are bound; the session keeps no view
    return out


@query("b12_project_for_export", "SELECT p_partkey, p_name FROM part")
def _b12(t: Tables):
    return S.for_export(t.part.select("p_partkey", "p_name", "p_size"), ["p_size"], ["p_size", "p_partkey"])


@query("b13_money_text", "SELECT tran_uid, settlement_cents, CAST(CAST(settlement_cents AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2))::VARCHAR AS amount FROM settlement_std")
def _b13(t: Tables):
    from ledgerloom.functions import money as M

    return t.settlement_std.select("tran_uid", "settlement_cents", X.money_text(M.minor_to_major(col("settlement_cents"))).alias("amount"))


