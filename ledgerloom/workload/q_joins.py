"""Checked joins (E-01..E-22)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.functions import cards as K
from ledgerloom.operators import joins as J
from ledgerloom.operators import windows as W
from ledgerloom.sources.tables import local_table
from ledgerloom.workload.feeds import Tables
from ledgerloom.workload.registry import query

col = F.col


@query("e01_inner_join", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def _e01(t: Tables):
    return J.lookup(t.orders, t.customer, {"c_custkey": "o_custkey"}, ["c_name"], "inner").select("o_orderkey", "c_name")


@query("e02_left_join", "SELECT o_orderkey, l_linenumber, l_quantity FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey AND l_returnflag = 'R'")
def _e02(t: Tables):
    returned = t.lineitem.where(col("l_returnflag") == "R")
    return J.lookup(t.orders, returned, {"l_orderkey": "o_orderkey"}, ["l_linenumber", "l_quantity"]).select("o_orderkey", "l_linenumber", "l_quantity")


@query(
    "e03_full_outer",
    """SELECT coalesce(a.k, b.k) AS k, a.n_orders, b.n_lines FROM (SELECT CASE WHEN o_custkey % 5 = 0 THEN NULL ELSE o_custkey END AS k, count(*) AS n_orders FROM orders GROUP BY 1) a
 FULL JOIN (SELECT CASE WHEN l_partkey % 3 = 0 THEN NULL ELSE l_partkey END AS k, count(*) AS n_lines FROM lineitem GROUP BY 1) b ON a.k = b.k""",
)
def _e03(t: Tables):
    a = t.orders.groupBy(F.when(col("o_custkey") % 5 != 0, col("o_custkey")).alias("k")).agg(F.count("*").alias("n_orders"))
    b = t.lineitem.groupBy(F.when(col("l_partkey") % 3 != 0, col("l_partkey")).alias("k")).agg(F.count("*").alias("n_lines"))
    return J.full_outer(a, b, ["k"])


@query("e04_theta_join", "SELECT r_name, n_name, count(*) AS customers FROM region, nation, customer WHERE r_regionkey = n_regionkey AND n_nationkey = c_nationkey AND c_acctbal > n_nationkey * 100 GROUP BY ALL")
def _e04(t: Tables):
    rows = t.customer.join(t.nation, (col("n_nationkey") == col("c_nationkey")) & (col("c_acctbal") > col("n_nationkey") * 100)).join(t.region, col("r_regionkey") == col("n_regionkey"))
    return rows.groupBy("r_name", "n_name").agg(F.count("*").alias("customers"))


@query("e05_left_anti", "SELECT o_orderkey, o_totalprice FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def _e05(t: Tables):
    return J.left_anti(t.orders, t.lineitem.withColumnRenamed("l_orderkey", "o_orderkey"), ["o_orderkey"]).select("o_orderkey", "o_totalprice")


@query(
    "e06_not_in_null_aware",
    "SELECT o_orderkey, nullif(o_custkey % 50, 7) AS k FROM orders WHERE nullif(o_custkey % 50, 7) NOT IN (SELECT l_partkey % 60 FROM lineitem WHERE l_quantity > 45 AND l_partkey % 60 < 20)",
)
def _e06(t: Tables):
    rows = t.orders.select("o_orderkey", F.when(col("o_custkey") % 50 != 7, col("o_custkey") % 50).alias("k"))
    values = t.lineitem.where((col("l_quantity") > 45) & (col("l_partkey") % 60 < 20)).select((col("l_partkey") % 60).alias("k"))
    return J.not_in(rows, values, "k")


@query("e06_not_in_list_with_null", "SELECT o_orderkey FROM orders WHERE o_custkey NOT IN (SELECT nullif(l_suppkey, 3) FROM lineitem)")
def _e06b(t: Tables):
    values = t.lineitem.select(F.when(col("l_suppkey") != 3, col("l_suppkey")).alias("o_custkey"))
    return J.not_in(t.orders, values, "o_custkey").select("o_orderkey")


@query(
    "e07_not_exists_many_columns",
    """SELECT l_orderkey, l_linenumber, l_suppkey, l_returnflag FROM lineitem a WHERE l_returnflag = 'R' AND NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_returnflag = 'A' AND b.l_orderkey = a.l_orderkey AND b.l_linenumber = a.l_linenumber)""",
)
def _e07(t: Tables):
    keys = ["l_orderkey", "l_linenumber"]
    seen = t.lineitem.where(col("l_returnflag") == "A")
    return J.left_anti(t.lineitem.where(col("l_returnflag") == "R"), seen, keys).select(*keys, "l_suppkey", "l_returnflag")


@query("e08_semi_join", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 480000)")
def _e08(t: Tables):
    big = t.orders.where(col("o_totalprice") > 480000).withColumnRenamed("o_custkey", "c_custkey")
    return J.left_semi(t.customer, big, ["c_custkey"]).select("c_custkey", "c_name")


@query(
    "e09_exists_over_date_list",
    "SELECT o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2001-12-01', INTERVAL 7 DAY)) AS d) s WHERE s.d = o_orderdate)",
)
def _e09(t: Tables):
    span = t.orders.agg(F.lit("1995-01-01").cast("date").alias("a"), F.greatest(F.max(col("o_orderdate").cast("date")), F.lit("2001-12-01").cast("date")).alias("b"))
    days = span.select(F.explode(F.sequence("a", "b", F.expr("interval 7 day"))).alias("d")).select(col("d").cast("timestamp_ntz").alias("o_orderdate"))
    return J.left_semi(t.orders, days, ["o_orderdate"]).select("o_orderkey")


_MONTHLY = "SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS mon, sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS cents FROM orders GROUP BY ALL"


def _monthly(t: Tables):
    cents = F.round(col("o_totalprice") * 100).cast("long")
    return t.orders.groupBy("o_custkey", F.trunc(col("o_orderdate").cast("date"), "month").alias("mon")).agg(F.sum(cents).alias("cents"))


@query(
    "e10_self_join_shifted_months",
    f"""WITH m AS ({_MONTHLY}) SELECT m.o_custkey, CAST(m.mon AS VARCHAR) AS mon, CAST(m.cents AS BIGINT) AS cents, CAST(coalesce(p1.cents, 0) + coalesce(p2.cents, 0) + coalesce(p3.cents, 0) AS DOUBLE) / (SELECT 3) AS prior_mean
 FROM m LEFT JOIN m p1 ON p1.o_custkey = m.o_custkey AND p1.mon = m.mon - INTERVAL 1 MONTH LEFT JOIN m p2 ON p2.o_custkey = m.o_custkey AND p2.mon = m.mon - INTERVAL 2 MONTH
 LEFT JOIN m p3 ON p3.o_custkey = m.o_custkey AND p3.mon = m.mon - INTERVAL 3 MONTH""",
)
def _e10(t: Tables):
    w = _monthly(t)
    for i in (1, 2, 3):
        w = W.prior_period(w, ["o_custkey"], W.D.month_index(col("mon")), {f"p{i}": col("cents")}, i)
    total = F.coalesce("p1", F.lit(0)) + F.coalesce("p2", F.lit(0)) + F.coalesce("p3", F.lit(0))
    return w.select("o_custkey", "mon", "cents", (total.cast("double") / 3).alias("prior_mean"))


@query(
    "e11_previous_month_and_year",
    f"""WITH m AS ({_MONTHLY}) SELECT m.o_custkey, CAST(m.mon AS VARCHAR) AS mon, CAST(m.cents AS BIGINT) AS cents, CAST(lm.cents AS BIGINT) AS cents_lm, CAST(ly.cents AS BIGINT) AS cents_ly
 FROM m LEFT JOIN m lm ON lm.o_custkey = m.o_custkey AND lm.mon = m.mon - INTERVAL 1 MONTH LEFT JOIN m ly ON ly.o_custkey = m.o_custkey AND ly.mon = m.mon - INTERVAL 12 MONTH""",
)
def _e11(t: Tables):
    index = W.D.month_index(col("mon"))
    rows = W.prior_period(_monthly(t), ["o_custkey"], index, {"cents_lm": col("cents")}, 1)
    return W.prior_period(rows, ["o_custkey"], index, {"cents_ly": col("cents")}, 12)


@query(
    "e12_latest_row_with_ties",
    "SELECT l_partkey, l_orderkey, l_linenumber, l_quantity, CAST(l_shipdate AS VARCHAR) AS l_shipdate FROM (SELECT *, rank() OVER (PARTITION BY l_partkey ORDER BY l_shipdate DESC) AS r FROM lineitem) WHERE r = 1",
)
def _e12(t: Tables):
    return W.latest_with_ties(t.lineitem, ["l_partkey"], "l_shipdate").select("l_partkey", "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")


_RANGE = """SELECT a.tran_uid, m.state, r.proc_fee_code, CAST(r.proc_fee_percent AS DOUBLE) AS proc_fee_percent, CAST(r.proc_fee_fixed AS DOUBLE) AS proc_fee_fixed FROM acquirer_txn a JOIN store m ON m.store_id = substr(a.terminal_id, 1, 10)
 LEFT JOIN rate_card r ON upper(r.merchant) = upper(m.ratecard_group) AND upper(r.card_type) = upper(a.card_type) AND a.file_date BETWEEN r.from_date AND coalesce(r.to_date, DATE '2999-12-31')"""


def _rated(t: Tables, by_month: bool):
    dims = t.store.select("store_id", "state", "ratecard_group")
    rows = J.lookup(t.acquirer_txn, dims, {"store_id": F.left("terminal_id", F.lit(10))}, ["state", "ratecard_group"], "inner")
    on = {"merchant": F.upper("ratecard_group"), "card_type": F.upper("card_type")}
    out = J.range_lookup(rows, t.rate_card, on, col("file_date"), "from_date", "to_date", ["proc_fee_code", "proc_fee_percent", "proc_fee_fixed"], by_month=by_month)
    return out.select("tran_uid", "state", "proc_fee_code", "proc_fee_percent", "proc_fee_fixed")


@query("e13_range_lookup", _RANGE)
def _e13(t: Tables):
    return _rated(t, False)


@query("e13_range_lookup_by_month", _RANGE)
def _e13m(t: Tables):
    return _rated(t, True)


@query(
    "e14_active_months_before",
    """WITH a AS (SELECT DISTINCT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS am FROM orders), c AS (SELECT DISTINCT am AS mon FROM a)
SELECT CAST(c.mon AS VARCHAR) AS mon, a.o_custkey, count(DISTINCT a.am) AS active_months FROM c JOIN a ON c.mon > a.am GROUP BY c.mon, a.o_custkey""",
)
def _e14(t: Tables):
    return W.active_periods_before(t.orders.select("o_custkey", col("o_orderdate").cast("date").alias("mon")), "o_custkey", "mon", "active_months")


@query(
    "e15_cascade_match",
    """WITH one AS (SELECT trace_id, max(fee) AS fee FROM (SELECT trace_id, interchange_fee AS fee, rank() OVER (PARTITION BY trace_id ORDER BY load_time DESC) AS r FROM scheme_fee WHERE trace_id IS NOT NULL) WHERE r = 1 GROUP BY 1),
two AS (SELECT term_id, min(interchange_fee) AS fee FROM scheme_fee GROUP BY 1)
SELECT a.tran_uid, CAST(coalesce(one.fee, two.fee) AS BIGINT) AS fee, CASE WHEN one.fee IS NOT NULL THEN 1 WHEN two.fee IS NOT NULL THEN 2 END AS step
FROM acquirer_txn a LEFT JOIN one ON one.trace_id = a.tran_uid LEFT JOIN two ON upper(two.term_id) = upper(a.terminal_id)""",
)
def _e15(t: Tables):
    fees = t.scheme_fee
    newest = W.latest_with_ties(fees.where(col("trace_id").isNotNull()), ["trace_id"], "load_time")
    one = newest.groupBy("trace_id").agg(F.max("interchange_fee").alias("fee"))
    two = fees.groupBy(F.upper("term_id").alias("term_id")).agg(F.min("interchange_fee").alias("fee"))
    steps = [(one, {"trace_id": "tran_uid"}), (two, {"term_id": F.upper("terminal_id")})]
    return J.cascade_match(t.acquirer_txn, steps, "fee", step_out="step").select("tran_uid", "fee", "step")


@query("e16_derived_key_join", "SELECT s.tran_uid, s.transaction_total, m.division FROM switch_txn s JOIN store m ON upper(substr(trim(s.net_term_id), 1, 10)) = upper(trim(m.store_id))")
def _e16(t: Tables):
    dims = t.store.select(F.upper(F.trim("store_id")).alias("store_id"), "division")
    return J.lookup(t.switch_txn, dims, {"store_id": K.store_of_terminal(col("net_term_id"), 10)}, ["division"], "inner").select("tran_uid", "transaction_total", "division")


@query("e17_join_on_function", "SELECT b.tran_uid, b.amount_cents, c.spend_factor FROM billing b JOIN type_code c ON upper(trim(c.tran_type_desc)) = b.kind AND c.spend_factor <> 0")
def _e17(t: Tables):
    abbr = t.tran_type.select(col("dn_tran_code").cast("int").alias("c"), "abbr")
    rows = J.lookup(t.switch_txn, abbr, {"c": col("tran_type_id").cast("int")}, ["abbr"], "inner")
    codes = t.type_code.where(col("spend_factor") != 0).select(F.upper(F.trim("tran_type_desc")).alias("k"), "spend_factor")
    kind = K.calc_tran_type(col("proc_id_iss_b"), col("abbr"), col("mti"))
    return J.lookup(rows, codes, {"k": kind}, ["spend_factor"], "inner").select("tran_uid", col("transaction_total").alias("amount_cents"), "spend_factor")


@query(
    "e18_case_in_join",
    """SELECT b.tran_uid, b.amount_cents, r.from_date AS valid_from FROM billing b JOIN (SELECT card_type, CAST(min(from_date) AS VARCHAR) AS from_date FROM rate_card GROUP BY 1 UNION ALL SELECT 'Any', 'any') r
 ON r.card_type = CASE WHEN b.scheme IN ('VISA', 'MASTERCARD') THEN b.card_type ELSE 'Any' END""",
)
def _e18(t: Tables):
    rates = t.rate_card.groupBy("card_type").agg(F.min("from_date").cast("string").alias("valid_from"))
    rates = rates.unionByName(local_table(t.spark, "card_type string, valid_from string", [("Any", "any")]))
    bucket = F.when(col("scheme").isin("VISA", "MASTERCARD"), col("card_type")).otherwise("Any")
    return J.lookup(t.billing, rates, {"card_type": bucket}, ["valid_from"], "inner").select("tran_uid", "amount_cents", "valid_from")


@query("e19_scalar_threshold", "SELECT o_orderkey, (SELECT value * 0.01 FROM control WHERE rule_id = 8 AND attribute = 'Cashout_Low') AS low FROM orders")
def _e19(t: Tables):
    return t.orders.select("o_orderkey", J.control_value(t.control, 8, "Cashout_Low", 0.01).alias("low"))


@query(
    "e20_threshold_with_default",
    """SELECT m.store_id, m.division, coalesce(coalesce(c.value, (SELECT value FROM control WHERE rule_id = 1 AND attribute = 'Default_Low')) * 0.01, 0.2) AS low, coalesce(h.value * 0.01, 0.3) AS high
 FROM store m LEFT JOIN control c ON c.merchant = m.division AND c.rule_id = 1 AND c.attribute = 'Ratio_NotPresent To Total_Low' LEFT JOIN control h ON h.merchant = m.division AND h.rule_id = 1 AND h.attribute = 'Ratio_NotPresent To Total_High'""",
)
def _e20(t: Tables):
    out = J.threshold(t.store, t.control, col("division"), 1, "Ratio_NotPresent To Total_Low", "Default_Low", 0.2, out="low")
    out = J.threshold(out, t.control, col("division"), 1, "Ratio_NotPresent To Total_High", "Default_High", 0.3, out="high")
    return out.select("store_id", "division", "low", "high")


@query(
    "e21_bridge_key_value",
    """SELECT a.tran_uid, m.site_name FROM acquirer_txn a JOIN key_value k ON k.attribute = 'merchant-terminal' AND upper(trim(k.key)) = upper(trim(a.merchant_id)) JOIN store m ON m.store_id = substr(k.value, 1, 10)""",
)
def _e21(t: Tables):
    rows = J.bridge(t.acquirer_txn, t.key_value, "merchant-terminal", col("merchant_id"), "terminal")
    return J.lookup(rows, t.store, {"store_id": F.left("terminal", F.lit(10))}, ["site_name"], "inner").select("tran_uid", "site_name")


@query(
    "e22_unnest_outer_and_inner",
    """SELECT l_orderkey, l_linenumber, l_partkey, i AS item, 'outer' AS mode FROM lineitem LEFT JOIN LATERAL (SELECT unnest(CASE WHEN l_quantity > 25 THEN [l_suppkey, l_suppkey + 1] ELSE [] END) AS i) u ON true
UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, unnest(CASE WHEN l_quantity > 25 THEN [l_suppkey, l_suppkey + 1] ELSE [] END), 'inner' FROM lineitem""",
)
def _e22(t: Tables):
    empty = F.array().cast("array<bigint>")
    items = F.when(col("l_quantity") > 25, F.array(col("l_suppkey"), col("l_suppkey") + 1)).otherwise(empty)
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", items.alias("items"))
    outer = J.unnest(rows, col("items"), "item", outer=True).withColumn("mode", F.lit("outer"))
    inner = J.unnest(rows, col("items"), "item").withColumn("mode", F.lit("inner"))
    return outer.unionByName(inner).drop("items")
