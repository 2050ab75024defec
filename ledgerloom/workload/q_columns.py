"""Checked column functions: projections and predicates (C), scalars (S), composites (H)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ledgerloom.functions import cards as K
from ledgerloom.functions import dates as D
from ledgerloom.functions import geo as G
from ledgerloom.functions import money as M
from ledgerloom.functions import nested as N
from ledgerloom.functions import text as X
from ledgerloom.workload.feeds import RUN_DATE, Tables
from ledgerloom.workload.registry import query

col = F.col


@query("c01_projection", "SELECT o_orderkey AS id, o_orderpriority AS priority, 'AUD' AS currency, CAST(NULL AS VARCHAR) AS remark FROM orders")
def _c01(t: Tables):
    return t.orders.select(col("o_orderkey").alias("id"), col("o_orderpriority").alias("priority"), F.lit("AUD").alias("currency"), F.lit(None).cast("string").alias("remark"))


@query("c02_select_except", "SELECT * EXCLUDE (c_acctbal, c_name) FROM customer")
def _c02(t: Tables):
    return t.customer.drop("c_acctbal", "c_name")


@query("c03_star_plus_computed", "SELECT *, c_acctbal * 2 AS doubled FROM customer")
def _c03(t: Tables):
    return t.customer.select("*", (col("c_acctbal") * 2).alias("doubled"))


@query(
    "c04_case",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN CASE WHEN o_totalprice > 250000 THEN 'big done' ELSE 'done' END WHEN 'O' THEN 'open' END AS stage,
 CASE p.scheme WHEN 'VISA' THEN 'CREDIT' ELSE '' END AS kind FROM orders, (SELECT 'VISA' AS scheme) p""",
)
def _c04(t: Tables):
    done = F.when(col("o_totalprice") > 250000, "big done").otherwise("done")
    stage = F.when(col("o_orderstatus") == "F", done).when(col("o_orderstatus") == "O", "open")
    return t.orders.select("o_orderkey", stage.alias("stage"), K.scheme_card_type(F.lit("VISA"), F.lit("CREDIT")).alias("kind"))


@query("c05_nested_if", "SELECT o_orderkey, if(o_orderstatus = 'F', if(o_totalprice > 300000, 'a', 'b'), 'c') AS v FROM orders")
def _c05(t: Tables):
    return t.orders.select("o_orderkey", F.expr("if(o_orderstatus = 'F', if(o_totalprice > 300000, 'a', 'b'), 'c')").alias("v"))


@query(
    "c06_null_defaults",
    """SELECT store_id, coalesce(site_name, 'none') AS site, nullif(division, '') AS division, coalesce(nullif(trim(site_name), ''), nullif(trim(division), ''), store_id) AS label FROM store""",
)
def _c06(t: Tables):
    return t.store.select(
        "store_id",
        F.coalesce("site_name", F.lit("none")).alias("site"),
        F.nullif("division", F.lit("")).alias("division"),
        X.first_non_blank(col("site_name"), col("division"), col("store_id")).alias("label"),
    )


@query("c07_boolean_logic", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE (l_quantity > 40 AND l_discount < 0.03) OR NOT (l_returnflag <> 'R' OR l_tax <= 0.07)")
def _c07(t: Tables):
    keep = ((col("l_quantity") > 40) & (col("l_discount") < 0.03)) | ~((col("l_returnflag") != "R") | (col("l_tax") <= 0.07))
    return t.lineitem.where(keep).select("l_orderkey", "l_linenumber", "l_quantity")


@query("c08_in_list", "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus NOT IN ('P')")
def _c08(t: Tables):
    return t.orders.where(col("o_orderpriority").isin("1-URGENT", "2-HIGH") & ~col("o_orderstatus").isin("P")).select("o_orderkey")


@query(
    "c09_like_classification",
    """SELECT p_partkey, CASE WHEN p_name LIKE '%ring%' THEN 'Jewel' WHEN p_name LIKE '%bolt%' OR p_name LIKE '%gear%' THEN 'Hardware' ELSE 'Other' END AS category FROM part WHERE p_type NOT LIKE 'ECON%'""",
)
def _c09(t: Tables):
    kind = F.when(col("p_name").contains("ring"), "Jewel").when(col("p_name").contains("bolt") | col("p_name").like("%gear%"), "Hardware").otherwise("Other")
    return t.part.where(~col("p_type").like("ECON%")).select("p_partkey", kind.alias("category"))


@query(
    "c10_between_scalar_bounds",
    "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN (SELECT CAST(max(o_orderdate) AS DATE) - 365 FROM orders) AND (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)",
)
def _c10(t: Tables):
    newest = t.orders.agg(F.max("o_orderdate")).scalar()
    low = F.date_sub(newest.cast("date"), 365).cast("timestamp_ntz")
    high = F.date_add(newest.cast("date"), 1).cast("timestamp_ntz")
    return t.orders.where((col("o_orderdate") >= low) & (col("o_orderdate") < high)).select("o_orderkey")


@query("c11_null_and_blank", "SELECT store_id FROM store WHERE site_name IS NOT NULL AND coalesce(trim(division), '') <> ''")
def _c11(t: Tables):
    return t.store.where(col("site_name").isNotNull() & X.non_blank(col("division"))).select("store_id")


@query(
    "c12_safe_cast",
    """SELECT event_id, TRY_CAST(replace(event_type, 'click', '12.5') AS DOUBLE) AS n, TRY_CAST(props AS BIGINT) AS bad,
 CAST(CAST(try_strptime(strftime(ts, '%Y%m') || CASE WHEN user_id % 2 = 0 THEN '15' ELSE '45' END, '%Y%m%d') AS DATE) AS VARCHAR) AS d FROM events""",
)
def _c12(t: Tables):
    day = F.concat(F.date_format("ts", "yyyyMM"), F.when(col("user_id") % 2 == 0, "15").otherwise("45"))
    return t.events.select(
        "event_id",
        F.replace("event_type", F.lit("click"), F.lit("12.5")).try_cast("double").alias("n"),
        col("props").try_cast("long").alias("bad"),
        F.try_to_timestamp(day, F.lit("yyyyMMdd")).cast("date").alias("d"),
    )


@query("c13_strict_cast", "SELECT o_orderkey, CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS level, CAST(CAST(strptime('2001-' || lpad(CAST(o_orderkey % 12 + 1 AS VARCHAR), 2, '0') || '-01', '%Y-%m-%d') AS DATE) AS VARCHAR) AS d FROM orders")
def _c13(t: Tables):
    text = F.concat(F.lit("2001-"), F.lpad((col("o_orderkey") % 12 + 1).cast("string"), 2, "0"), F.lit("-01"))
    return t.orders.select("o_orderkey", F.substring("o_orderpriority", 1, 1).cast("long").alias("level"), F.to_date(text, "yyyy-MM-dd").alias("d"))


@query("c14_nested_field", "SELECT o_orderkey, o_custkey AS customer, o_totalprice AS amount FROM orders")
def _c14(t: Tables):
    report = t.orders.select("o_orderkey", F.struct(F.struct(col("o_custkey").alias("id")).alias("Customer"), F.struct(col("o_totalprice").alias("Amount")).alias("Pay")).alias("Report"))
    return report.select("o_orderkey", col("Report.Customer.id").alias("customer"), col("Report.Pay.Amount").alias("amount"))


@query("c15_subscript", "SELECT vec_id, CAST(embedding[1] AS DOUBLE) AS first_value, CAST(embedding[3] AS DOUBLE) AS third_value, CAST(embedding[100000] AS DOUBLE) AS beyond FROM embeddings")
def _c15(t: Tables):
    e = col("embedding")
    return t.embeddings.select("vec_id", N.safe_offset(e, 0).alias("first_value"), N.safe_offset(e, 2).alias("third_value"), N.safe_offset(e, 99999).alias("beyond"))


@query(
    "c16_name_value_lookup",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_quantity AS VARCHAR) AS quantity, CASE WHEN l_linenumber <= 3 THEN 'card ' || CAST(l_suppkey AS VARCHAR) END AS card, CAST(NULL AS VARCHAR) AS missing FROM lineitem""",
)
def _c16(t: Tables):
    def pair(name, value):
        return F.struct(name.alias("Name"), value.alias("Value"))

    fields = F.array(
        pair(F.lit("Quantity"), col("l_quantity").cast("string")),
        pair(F.when(col("l_linenumber") <= 3, "EDR Card no").otherwise("other"), F.concat(F.lit("card "), col("l_suppkey").cast("string"))),
        pair(F.lit("Quantity"), F.lit("repeated")),
        pair(F.lit(None).cast("string"), F.lit("nameless")),
    )
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", fields.alias("f")).withColumn("m", N.name_value_map(col("f")))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", F.try_element_at("m", F.lit("Quantity")).alias("quantity"), N.name_like_value(col("f"), "EDR Card%").alias("card"), N.name_value(col("f"), "Nope").alias("missing"))


@query("c17_signed_amount", "SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END * l_extendedprice AS signed_amount FROM lineitem")
def _c17(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", M.signed(col("l_extendedprice"), col("l_returnflag"), ["R"]).alias("signed_amount"))


@query("c18_unit_conversion", "SELECT tran_uid, transaction_total, CAST(transaction_total AS DOUBLE) / 100 AS dollars, CAST(interchange_fee AS DOUBLE) / 1000000 AS fee, CAST(transaction_total AS DOUBLE) / 100 / 1.1 AS ex_gst FROM switch_txn")
def _c18(t: Tables):
    dollars = M.minor_to_major(col("transaction_total"))
    return t.switch_txn.select("tran_uid", "transaction_total", dollars.alias("dollars"), M.minor_to_major(col("interchange_fee"), 6).alias("fee"), M.ex_gst(dollars).alias("ex_gst"))


@query(
    "c19_bands_and_cutoff",
    """SELECT req_tx_ref, CASE WHEN amount_cents IS NULL THEN 'NA' WHEN amount_cents < 5000000 THEN '<5e+06' WHEN amount_cents < 20000000 THEN '5e+06-2e+07' ELSE '>=2e+07' END AS band,
 CASE WHEN req_time <= '18:00:00' THEN 'Pre' ELSE 'Post' END AS cutoff FROM apm_txn""",
)
def _c19(t: Tables):
    at = F.to_timestamp_ntz(F.concat(col("req_date").cast("string"), F.lit(" "), col("req_time")), F.lit("yyyy-MM-dd HH:mm:ss"))
    return t.apm_txn.select("req_tx_ref", G.band(col("amount_cents"), [5000000, 20000000]).alias("band"), D.cutoff_label(at).alias("cutoff"))


@query("c20_sentinel_to_null", "SELECT id, nullif(bank_ref_no, 'NULL') AS bank_ref_no, nullif(amount_cents % 5, 0) AS rest, nullif(id % 3, 0) AS third FROM chargebacks")
def _c20(t: Tables):
    rows = t.chargebacks.select("id", "bank_ref_no", (col("amount_cents") % 5).alias("rest"), (col("id") % 3).alias("third"))
    return rows.select("id", X.null_text_to_null(col("bank_ref_no")).alias("bank_ref_no"), *X.sentinel_to_null(["rest", "third"], 0))


@query("c21_parameters", "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2000-07-15' AND o_orderstatus = 'F'")
def _c21(t: Tables):
    text = "SELECT o_orderkey FROM {orders} WHERE o_orderdate >= CAST(:since AS TIMESTAMP_NTZ) AND o_orderstatus = :status"
    return t.spark.sql(text, args={"since": "2000-07-15 00:00:00", "status": "F"}, orders=t.orders)


@query("c22_run_guard", "SELECT o_orderkey FROM orders WHERE (SELECT count(*) FROM lineitem WHERE CAST(l_shipdate AS DATE) = DATE '2001-07-14') > 0 AND o_orderstatus = 'P'")
def _c22(t: Tables):
    # the runner asks file_landed before it starts a rule; inside one query the guard is a scalar
    landed = t.switch_txn.where(col("file_date") == F.lit(RUN_DATE))
    return t.orders.where((landed.select("file_date").limit(1).agg(F.count("*")).scalar() > 0) & (col("o_orderstatus") == "P")).select("o_orderkey")


@query(
    "s01_s25_string_functions",
    """SELECT p_partkey, p_name || '/' || p_brand AS s_concat, trim('  ' || p_name || ' ') AS s_trim, ltrim('  ' || p_name) AS s_ltrim, rtrim(p_name || 'xyx', 'xy') AS s_rtrim_set,
 upper(p_name) AS s_upper, lower(p_type) AS s_lower, left(p_name, 4) AS s_left, right(p_name, 3) AS s_right, substr(p_name, 2, 5) AS s_substr, substr(p_name, -3, 2) AS s_from_end, length(p_name) AS s_length,
 replace(p_name, 'e', '#') AS s_replace, lpad(p_name, 12, '*') AS s_lpad, rpad(p_name, 6, '*') AS s_rpad, repeat('ab', 2) AS s_repeat, strpos(p_name, ' ') AS s_strpos, split_part(p_name, ' ', 1) AS s_split,
 CASE WHEN regexp_matches(p_name, '^(red|blue)') THEN 1 ELSE 0 END AS s_rlike, regexp_replace(p_brand, '[^0-9]', '', 'g') AS s_regexp_replace, regexp_extract(p_brand, '#([0-9]+)', 1) AS s_regexp_extract,
 printf('%06d', p_size) AS s_format, CAST(p_size AS VARCHAR) AS s_string, to_base64(unhex(sha256(p_name))) AS s_sha256_base64 FROM part""",
)
def _strings(t: Tables):
    n, b = col("p_name"), col("p_brand")
    return t.part.select(
        "p_partkey",
        F.concat(n, F.lit("/"), b).alias("s_concat"),
        F.trim(F.concat(F.lit("  "), n, F.lit(" "))).alias("s_trim"),
        F.ltrim(F.concat(F.lit("  "), n)).alias("s_ltrim"),
        F.rtrim(F.concat(n, F.lit("xyx")), F.lit("xy")).alias("s_rtrim_set"),
        F.upper(n).alias("s_upper"),
        F.lower("p_type").alias("s_lower"),
        F.left(n, F.lit(4)).alias("s_left"),
        F.right(n, F.lit(3)).alias("s_right"),
        F.substring(n, 2, 5).alias("s_substr"),
        F.substring(n, -3, 2).alias("s_from_end"),
        F.length(n).alias("s_length"),
        F.replace(n, F.lit("e"), F.lit("#")).alias("s_replace"),
        F.lpad(n, 12, "*").alias("s_lpad"),
        F.rpad(n, 6, "*").alias("s_rpad"),
        F.repeat(F.lit("ab"), 2).alias("s_repeat"),
        F.instr(n, " ").alias("s_strpos"),
        F.get(F.split(n, " "), F.lit(0)).alias("s_split"),
        F.when(n.rlike("^(red|blue)"), 1).otherwise(0).alias("s_rlike"),
        X.digits_only(b).alias("s_regexp_replace"),
        F.regexp_extract(b, "#([0-9]+)", 1).alias("s_regexp_extract"),
        X.zero_pad(col("p_size"), 6).alias("s_format"),
        col("p_size").cast("string").alias("s_string"),
        X.card_alias(n).alias("s_sha256_base64"),
    )


@query(
    "s26_s55_date_functions",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS d_date, strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%H:%M:%S') AS d_time, CAST(DATE '2001-07-15' AS VARCHAR) AS d_run_date,
 CAST(CAST(o_orderdate AS DATE) + 10 AS VARCHAR) AS d_add, CAST(CAST(o_orderdate AS DATE) - 3 AS VARCHAR) AS d_sub, CAST(CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS VARCHAR) AS d_add_month,
 CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2001-07-15') AS BIGINT) AS d_diff, CAST(CAST(date_trunc('month', o_orderdate) AS DATE) AS VARCHAR) AS d_trunc_month, CAST(CAST(date_trunc('quarter', o_orderdate) AS DATE) AS VARCHAR) AS d_trunc_quarter,
 CAST(o_orderdate + INTERVAL 90 MINUTE AS VARCHAR) AS d_ts_add, CAST(o_orderdate - INTERVAL 5 SECOND AS VARCHAR) AS d_ts_sub, CAST(date_trunc('hour', o_orderdate + to_seconds(o_orderkey % 86400)) AS VARCHAR) AS d_ts_trunc,
 year(o_orderdate) AS d_year, month(o_orderdate) AS d_month, dayofweek(o_orderdate) + 1 AS d_dow, CAST(hour(o_orderdate + to_seconds(o_orderkey % 86400)) AS BIGINT) AS d_hour, CAST(last_day(CAST(o_orderdate AS DATE)) AS VARCHAR) AS d_last_day,
 len(generate_series(CAST(o_orderdate AS DATE), CAST(o_orderdate AS DATE) + 6, INTERVAL 2 DAY)) AS d_series, strftime(o_orderdate, '%d-%m-%Y') AS d_format, strftime(o_orderdate, '%Y%m%dT%H%M%S') AS d_format_ts,
 CAST(CAST(strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y') AS DATE) AS VARCHAR) AS d_parse, CAST(CAST(try_strptime(CASE WHEN o_orderkey % 2 = 0 THEN 'x' ELSE '20010203' END, '%Y%m%d') AS DATE) AS VARCHAR) AS d_safe_parse,
 date_diff('minute', o_orderdate, o_orderdate + to_seconds(o_orderkey % 86400)) AS d_minutes FROM orders""",
)
def _dates(t: Tables):
    at = D.plus_seconds(col("o_orderdate"), col("o_orderkey") % 86400)
    rows = t.orders.select("o_orderkey", "o_orderdate", col("o_orderdate").cast("date").alias("d"), at.alias("at"))
    d, o, a = col("d"), col("o_orderdate"), col("at")
    run = F.lit(RUN_DATE)
    return rows.select(
        "o_orderkey",
        d.alias("d_date"),
        D.time_text(a).alias("d_time"),
        run.alias("d_run_date"),
        F.date_add(d, 10).alias("d_add"),
        F.date_sub(d, 3).alias("d_sub"),
        F.add_months(d, 1).alias("d_add_month"),
        F.datediff(run, d).alias("d_diff"),
        D.month_start(d).alias("d_trunc_month"),
        F.trunc(d, "quarter").alias("d_trunc_quarter"),
        D.plus_minutes(o, F.lit(90)).alias("d_ts_add"),
        D.plus_seconds(o, F.lit(-5)).alias("d_ts_sub"),
        F.date_trunc("hour", a).cast("timestamp_ntz").alias("d_ts_trunc"),
        F.year(d).alias("d_year"),
        F.month(d).alias("d_month"),
        F.dayofweek(d).alias("d_dow"),
        F.hour(a).alias("d_hour"),
        F.last_day(d).alias("d_last_day"),
        F.size(F.sequence(d, F.date_add(d, 6), F.expr("interval 2 day"))).alias("d_series"),
        F.date_format(d, "dd-MM-yyyy").alias("d_format"),
        D.compact_stamp(o).alias("d_format_ts"),
        F.to_date(F.date_format(d, "dd/MM/yyyy"), "dd/MM/yyyy").alias("d_parse"),
        F.try_to_timestamp(F.when(col("o_orderkey") % 2 == 0, "x").otherwise("20010203"), F.lit("yyyyMMdd")).cast("date").alias("d_safe_parse"),
        F.floor(D.seconds_of_day(a) / 60).alias("d_minutes"),
    )


@query(
    "s56_s62_math_functions",
    """SELECT l_orderkey, l_linenumber, CAST(round(CAST(cents AS DECIMAL(18,2)) / 8, 0) AS DOUBLE) AS m_round, abs(50 - l_quantity) AS m_abs, floor(l_extendedprice) AS m_floor, CAST(l_quantity AS BIGINT) % 7 AS m_mod,
 round(acos(l_discount), 9) AS m_acos, round(cos(l_tax), 9) AS m_cos, round(sin(l_tax), 9) AS m_sin FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem)""",
)
def _math(t: Tables):
    cents = F.round(col("l_extendedprice") * 100).cast("long")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.round(cents.cast("double") / 8, 0).alias("m_round"),
        F.abs(50 - col("l_quantity")).alias("m_abs"),
        F.floor("l_extendedprice").cast("double").alias("m_floor"),
        (col("l_quantity").cast("long") % 7).alias("m_mod"),
        F.round(F.acos("l_discount"), 9).alias("m_acos"),
        F.round(F.cos("l_tax"), 9).alias("m_cos"),
        F.round(F.sin("l_tax"), 9).alias("m_sin"),
    )


@query(
    "s63_s68_conditional_functions",
    """SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS f_cast, TRY_CAST(l_returnflag AS BIGINT) AS f_safe_cast, if(l_tax > 0.04, 'hi', 'lo') AS f_if, coalesce(nullif(l_returnflag, 'N'), 'none') AS f_ifnull,
 coalesce(nullif(l_returnflag, 'N'), nullif(l_linestatus, 'O'), 'x') AS f_coalesce, nullif(l_linestatus, 'F') AS f_nullif FROM lineitem""",
)
def _conditional(t: Tables):
    r, s = col("l_returnflag"), col("l_linestatus")
    return t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        col("l_quantity").cast("long").alias("f_cast"),
        r.try_cast("long").alias("f_safe_cast"),
        F.when(col("l_tax") > 0.04, "hi").otherwise("lo").alias("f_if"),
        F.ifnull(F.nullif(r, F.lit("N")), F.lit("none")).alias("f_ifnull"),
        F.coalesce(F.nullif(r, F.lit("N")), F.nullif(s, F.lit("O")), F.lit("x")).alias("f_coalesce"),
        F.nullif(s, F.lit("F")).alias("f_nullif"),
    )


@query(
    "s69_s75_array_functions",
    """SELECT p_partkey, len(string_split(p_name, ' ')) AS a_length, array_to_string(string_split(p_name, ' '), '|') AS a_joined, string_split(p_name, ' ')[2] AS a_safe_offset, string_split(p_name, ' ')[9] AS a_beyond, w.word AS a_word, w.pos - 1 AS a_offset
 FROM part, LATERAL (SELECT unnest(string_split(p_name, ' ')) AS word, generate_subscripts(string_split(p_name, ' '), 1) AS pos) w""",
)
def _arrays(t: Tables):
    words = F.split("p_name", " ")
    return t.part.select("p_partkey", words.alias("w"), F.posexplode(words).alias("a_offset", "a_word")).select(
        "p_partkey", F.size("w").alias("a_length"), F.array_join("w", "|").alias("a_joined"), F.get("w", F.lit(1)).alias("a_safe_offset"), F.get("w", F.lit(8)).alias("a_beyond"), "a_word", "a_offset"
    )


@query(
    "h50_mask_pan",
    """SELECT tran_uid, transaction_total, CASE WHEN length(trim(masked_pan)) < 10 THEN masked_pan ELSE left(masked_pan, 6) || '******' || right(masked_pan, 4) END AS listing_pan,
 CASE WHEN length(trim(masked_pan)) < 10 THEN masked_pan ELSE left(masked_pan, 6) || repeat('*', length(masked_pan) - 9) || right(masked_pan, 3) END AS partner_pan FROM switch_txn""",
)
def _h50(t: Tables):
    return t.switch_txn.select("tran_uid", "transaction_total", X.mask_pan(col("masked_pan")).alias("listing_pan"), X.mask_pan_keep_length(col("masked_pan")).alias("partner_pan"))


@query("h51_card_alias", "SELECT c_custkey, to_base64(unhex(sha256('SCDR|' || c_name))) AS pan_alias FROM customer")
def _h51(t: Tables):
    return t.customer.select("c_custkey", X.card_alias(K.card_id(token=col("c_name"))).alias("pan_alias"))


@query("h52_zero_pad", "SELECT o_orderkey, printf('%06d', o_orderkey) AS padded, printf('%02d', o_orderkey) AS never_cut FROM orders")
def _h52(t: Tables):
    return t.orders.select("o_orderkey", X.zero_pad(col("o_orderkey"), 6).alias("padded"), X.zero_pad(col("o_orderkey"), 2).alias("never_cut"))


@query("h53_fixed_decimals", "SELECT l_orderkey, l_linenumber, CAST(CAST(CAST(round(l_discount * 100) AS BIGINT) AS DECIMAL(18,4)) AS VARCHAR) AS pct4 FROM lineitem")
def _h53(t: Tables):
    return t.lineitem.select("l_orderkey", "l_linenumber", X.fixed_decimals(F.round(col("l_discount") * 100), 4).alias("pct4"))


@query("h54_thousands", "SELECT o_orderkey, format('{:,.2f}', o_totalprice) AS shown, regexp_replace(format('{:,.2f}', o_totalprice), '[^0-9]', '', 'g') AS digits FROM orders")
def _h54(t: Tables):
    shown = X.thousands(col("o_totalprice"))
    return t.orders.select("o_orderkey", shown.alias("shown"), X.digits_only(shown).alias("digits"))


@query("h55_timestamp_from_int", "SELECT tran_uid, CAST(try_strptime(rpad(CAST(CASE WHEN tran_uid % 10 = 0 THEN transaction_timestamp // 1000000 ELSE transaction_timestamp END AS VARCHAR), 14, '0'), '%Y%m%d%H%M%S') AS VARCHAR) AS ts FROM acquirer_txn")
def _h55(t: Tables):
    n = F.when(col("tran_uid") % 10 == 0, F.floor(col("transaction_timestamp") / 1000000)).otherwise(col("transaction_timestamp"))
    return t.acquirer_txn.select("tran_uid", D.timestamp_from_int(n).alias("ts"))


@query("h56_date_time_or_default", "SELECT reference_number, batch_number, card_number, coalesce(CAST(transaction_date AS VARCHAR), '1900-01-01') || ' ' || coalesce(transaction_time, '00:00:00') AS ts FROM gift_txn")
def _h56(t: Tables):
    return t.gift_txn.select("reference_number", "batch_number", "card_number", D.date_time_or_default(col("transaction_date"), col("transaction_time")).alias("ts"))


@query("h57_iso_year", "SELECT o_orderkey, strftime(o_orderdate, '%d%m') || lpad(CAST(isoyear(o_orderdate) % 100 AS VARCHAR), 2, '0') AS reference_day FROM orders")
def _h57(t: Tables):
    return t.orders.select("o_orderkey", D.day_month_iso_year(col("o_orderdate").cast("date")).alias("reference_day"))


@query("h58_monday_week", "SELECT o_orderkey, CAST(CAST(date_trunc('week', o_orderdate) AS DATE) AS VARCHAR) AS week_start, CAST(CAST(date_trunc('week', o_orderdate) AS DATE) + 6 AS VARCHAR) AS week_end FROM orders")
def _h58(t: Tables):
    d = col("o_orderdate").cast("date")
    return t.orders.select("o_orderkey", D.monday_week_start(d).alias("week_start"), D.monday_week_end(d).alias("week_end"))


@query("h59_sunday_week", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - CAST(dayofweek(o_orderdate) AS INT) AS VARCHAR) AS week_start, CAST(strftime(o_orderdate, '%U') AS BIGINT) AS week_no FROM orders")
def _h59(t: Tables):
    d = col("o_orderdate").cast("date")
    return t.orders.select("o_orderkey", D.sunday_week_start(d).alias("week_start"), D.sunday_week_number(d).alias("week_no"))


@query("h60_month_keys", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month_key, strftime(o_orderdate - INTERVAL 1 MONTH, '%Y-%m') AS previous_key FROM orders")
def _h60(t: Tables):
    d = col("o_orderdate").cast("date")
    return t.orders.select("o_orderkey", D.month_text(d).alias("month_key"), D.month_text(D.previous_month(d)).alias("previous_key"))


@query("h61_thursday_week", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) - CAST((isodow(o_orderdate) + 3) % 7 AS INT) AS VARCHAR) AS cycle_start FROM orders WHERE o_orderdate < TIMESTAMP '2001-07-12'")
def _h61(t: Tables):
    _, end = D.last_complete_week(RUN_DATE)
    d = col("o_orderdate").cast("date")
    return t.orders.where(col("o_orderdate") < F.lit(end + dt.timedelta(days=1)).cast("timestamp_ntz")).select("o_orderkey", D.week_of_cycle(d).alias("cycle_start"))


@query(
    "h62_payout_date",
    """SELECT o_orderkey, CAST(CASE WHEN days <> 'Weekdays' THEN d + sched WHEN dow = 0 THEN d + wk WHEN dow = 6 THEN d + wk + 1 WHEN dayofweek(d + sched) = 0 THEN d + sched + 1 WHEN dayofweek(d + sched) = 6 THEN d + sched + 2 ELSE d + sched END AS VARCHAR) AS payout
 FROM (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, dayofweek(o_orderdate) AS dow, CASE WHEN o_custkey % 3 = 0 THEN 'All' ELSE 'Weekdays' END AS days, CAST(o_custkey % 4 AS INT) AS sched,
 CAST(CASE WHEN o_custkey % 2 = 0 THEN 1 ELSE 3 END AS INT) AS wk FROM orders)""",
)
def _h62(t: Tables):
    plan = F.when(col("o_custkey") % 3 == 0, "All").otherwise("Weekdays")
    weekend = F.when(col("o_custkey") % 2 == 0, "Monday").otherwise("Wednesday")
    return t.orders.select("o_orderkey", D.payout_date(col("o_orderdate").cast("date"), plan, (col("o_custkey") % 4).cast("int"), weekend).alias("payout"))


@query("h63_cutoff_shift", "SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN 0 ELSE 1440 - (18 * 60 + 30) END AS shift, CAST(o_orderdate + to_minutes(CASE WHEN o_custkey % 2 = 0 THEN 0 ELSE 330 END) AS VARCHAR) AS shifted FROM orders")
def _h63(t: Tables):
    shift = D.cutoff_shift_minutes(F.when(col("o_custkey") % 2 == 0, 0).otherwise(1830))
    return t.orders.select("o_orderkey", shift.alias("shift"), D.plus_minutes(col("o_orderdate"), shift).alias("shifted"))


@query("h64_time_zones", "SELECT event_id, CAST(timezone('Australia/Sydney', timezone('UTC', date_trunc('second', ts))) AS VARCHAR) AS local_ts, CAST(timezone('UTC', timezone('Australia/Sydney', date_trunc('second', ts))) AS VARCHAR) AS utc_ts FROM events")
def _h64(t: Tables):
    ts = F.date_trunc("second", "ts").cast("timestamp_ntz")
    return t.events.select("event_id", D.local_from_utc(ts, "Australia/Sydney").alias("local_ts"), D.utc_from_local(ts, "Australia/Sydney").alias("utc_ts"))


@query(
    "h65_great_circle",
    """SELECT e.request_id, round(acos(greatest(-1, least(1, sin(radians(e.latitude)) * sin(radians(s.latitude)) + cos(radians(e.latitude)) * cos(radians(s.latitude)) * cos(radians(s.longitude) - radians(e.longitude))))) * 6371.0, 3) AS km
 FROM ecom_order e JOIN store s ON s.store_id = e.store_id""",
)
def _h65(t: Tables):
    s = t.store.select("store_id", col("latitude").alias("lat2"), col("longitude").alias("lon2"))
    km = G.great_circle_km(col("latitude"), col("longitude"), col("lat2"), col("lon2"))
    return t.ecom_order.join(s, "store_id").select("request_id", F.round(km, 3).alias("km"))


@query("h66_text_between", "SELECT page_id, regexp_extract(url, '://([^/]*)/', 1) AS host FROM pages WHERE regexp_matches(url, '://[^/]*/')")
def _h66(t: Tables):
    return t.pages.select("page_id", X.text_between(col("url"), "://", "/").alias("host")).where(col("host").isNotNull())


@query("h67_contact_text", "SELECT request_id, upper(address || ' ' || merchant_id) AS address_line, lower(email) AS email, lower(split_part(email, '@', 2)) AS domain FROM ecom_order")
def _h67(t: Tables):
    return t.ecom_order.select("request_id", X.address_line(col("address"), col("merchant_id")).alias("address_line"), F.lower("email").alias("email"), X.email_domain(col("email")).alias("domain"))


@query("h68_count_char", "SELECT doc_id, length(text) - length(replace(text, 'e', '')) AS n_e FROM documents")
def _h68(t: Tables):
    return t.documents.select("doc_id", X.count_char(col("text"), "e").alias("n_e"))


@query("h69_strip_quotes", "SELECT event_id, replace(replace(props, '\"', ''), '''', '') AS plain FROM events")
def _h69(t: Tables):
    return t.events.select("event_id", X.strip_quotes(col("props")).alias("plain"))


@query("h70_file_name_parts", "SELECT page_id, regexp_extract(url, '([^/]*)$', 1) AS base_name, substr(regexp_extract(url, '([^/]*)$', 1), 1, 3) AS head FROM pages")
def _h70(t: Tables):
    base = X.file_base_name(col("url"))
    return t.pages.select("page_id", base.alias("base_name"), X.name_slice(base, 0, 3).alias("head"))


@query(
    "h71_list_test",
    "SELECT a.tran_uid, CASE WHEN strpos(coalesce(upper(m.exclude_issuers), ''), CASE a.scheme WHEN 'MASTERCARD' THEN 'MC' ELSE a.scheme END) > 0 THEN 1 ELSE 0 END AS excluded FROM acquirer_txn a JOIN sap_map m ON m.store_number = substr(a.terminal_id, 1, 10)",
)
def _h71(t: Tables):
    m = t.sap_map.select(col("store_number").alias("s"), "exclude_issuers")
    issuer = F.when(col("scheme") == "MASTERCARD", "MC").otherwise(col("scheme"))
    rows = t.acquirer_txn.join(m, F.left("terminal_id", F.lit(10)) == col("s"))
    return rows.select("tran_uid", F.when(X.list_has_text(col("exclude_issuers"), issuer), 1).otherwise(0).alias("excluded"))


@query(
    "k_tran_uid",
    """SELECT coalesce(trim(invoice_number), 'Null') AS invoice, line_no, amount_cents, 'QP_' || coalesce(trim(invoice_number), 'Null') || '_' || CASE WHEN length(card_number) < 10 THEN card_number ELSE left(card_number, 6) || repeat('*', length(card_number) - 9) || right(card_number, 3) END
 || '_' || transaction_type || '_' || coalesce(strftime(transaction_date, '%Y%m%dT%H%M%S'), '19000101T000000') AS tran_uid FROM partner_txn""",
)
def _k_uid(t: Tables):
    uid = K.partner_uid(col("invoice_number"), col("card_number"), col("transaction_type"), col("transaction_date"))
    return t.partner_txn.select(F.coalesce("invoice_number", F.lit("Null")).alias("invoice"), "line_no", "amount_cents", uid.alias("tran_uid"))


@query("k_wallet_uid", "SELECT req_tx_ref, 'LK_' || CAST(req_tx_ref AS VARCHAR) || '_' || strftime(req_date, '%Y%m%d') || 'T' || replace(req_time, ':', '') AS tran_uid FROM apm_txn")
def _k_wallet(t: Tables):
    return t.apm_txn.select("req_tx_ref", K.wallet_uid(col("req_tx_ref"), col("req_date"), col("req_time")).alias("tran_uid"))


@query("k_scheme_and_kind", "SELECT tran_uid, kind, scheme, amount_cents FROM billing")
def _k_scheme(t: Tables):
    abbr = t.tran_type.select(col("dn_tran_code").cast("int").alias("c"), "abbr")
    rows = t.switch_txn.join(abbr, col("tran_type_id").cast("int") == col("c"))
    return rows.select(
        "tran_uid", K.calc_tran_type(col("proc_id_iss_b"), col("abbr"), col("mti")).alias("kind"), K.scheme_of(col("proc_id_iss_b"), col("inst_id_recon_iss")).alias("scheme"), col("transaction_total").alias("amount_cents")
    )


@query(
    "k_service_fee",
    """SELECT s.tran_uid, s.settlement_cents, CASE WHEN f.flag = 'N' THEN 0 ELSE CAST(round(CAST(s.settlement_cents AS DECIMAL(18,0)) * f.bp + f.fx * 1000000) AS DOUBLE) / 1000000 END AS fee FROM (SELECT *, CASE WHEN transaction_type LIKE '%REVERSAL%' THEN 'Y' WHEN transaction_type LIKE '%REFUND%' THEN 'N' ELSE 'Y' END AS flag FROM settlement_std) s
 JOIN (SELECT store_number, CAST(round(coalesce(CAST(commission_percent AS DOUBLE), 0) * 100) AS BIGINT) AS bp, CAST(coalesce(CAST(commission_fixed AS DOUBLE), 0) AS DECIMAL(9,2)) AS fx FROM sap_map) m ON m.store_number = s.store_id
 CROSS JOIN LATERAL (SELECT s.flag AS flag, m.bp AS bp, m.fx AS fx) f""",
)
def _k_fee(t: Tables):
    m = t.sap_map.select(col("store_number").alias("store_id"), "commission_percent", "commission_fixed")
    flag = M.commission_flag(F.lit("S1"), col("transaction_type"))
    # six decimals: cents times basis points is exact
    pct = F.coalesce(col("commission_percent").try_cast("decimal(9,2)"), F.lit(0).cast("decimal(9,2)"))
    fix = F.coalesce(col("commission_fixed").try_cast("decimal(9,2)"), F.lit(0).cast("decimal(9,2)"))
    exact = M.minor_to_major(col("settlement_cents")).cast("decimal(18,2)") * pct / F.lit(100).cast("decimal(3,0)") + fix
    return t.settlement_std.join(m, "store_id").select("tran_uid", "settlement_cents", F.when(flag == "N", 0).otherwise(exact).cast("decimal(24,6)").alias("fee"))


@query(
    "k_settlement_window",
    """SELECT s.tran_uid, s.settlement_cents FROM settlement_std s JOIN store d ON d.store_id = s.store_id JOIN settlement_window w ON w.division = d.division
 WHERE s.transaction_timestamp > CASE WHEN w.last_execution_time IS NULL THEN TIMESTAMP '1900-01-01' ELSE CAST(CAST(w.last_execution_time AS DATE) + w.days_lookback AS TIMESTAMP) END
 AND s.transaction_timestamp >= CAST(w.earliest_date AS TIMESTAMP) AND s.transaction_timestamp <= CAST(DATE '2001-07-15' + w.day_lag AS TIMESTAMP) + to_minutes(CAST(w.settlement_cutoff // 100 * 60 + w.settlement_cutoff % 100 AS INT))""",
)
def _k_window(t: Tables):
    rows = t.settlement_std.join(t.store.select("store_id", "division"), "store_id").join(t.settlement_window, "division")
    inside = K.in_settlement_window(col("transaction_timestamp"), col("last_execution_time"), col("days_lookback"), col("earliest_date"), F.lit(RUN_DATE), col("day_lag"), col("settlement_cutoff"))
    return rows.where(inside).select("tran_uid", "settlement_cents")


@query("k_due_pay_date", "SELECT o_orderkey, CAST(d + CAST(CASE WHEN (5 - dayofweek(d) + 7) % 7 = 0 THEN 7 ELSE (5 - dayofweek(d) + 7) % 7 END AS INT) AS VARCHAR) AS due FROM (SELECT o_orderkey, last_day(CAST(o_orderdate AS DATE)) AS d FROM orders)")
def _k_due(t: Tables):
    return t.orders.select("o_orderkey", K.due_pay_date(F.last_day("o_orderdate"), "FRI").alias("due"))


@query("k_card_id", "SELECT order_id, 'customerRef|' || customer_ref || '|containerId|' || container_id || '|itemId|' || item_id AS card_id FROM wallet_txn")
def _k_card(t: Tables):
    return t.wallet_txn.select("order_id", K.card_id(customer_ref=col("customer_ref"), container_id=col("container_id"), item_id=col("item_id")).alias("card_id"))


@query("k_gift_store", "SELECT reference_number, batch_number, card_number, left(upper(CASE WHEN batch_number = 3 THEN 'ISS' || outlet_code ELSE outlet_code END), 10) AS store_id FROM gift_txn")
def _k_gift(t: Tables):
    first = F.when(col("batch_number") == 3, F.concat(F.lit("iss"), col("outlet_code"))).otherwise("  ")
    return t.gift_txn.select("reference_number", "batch_number", "card_number", K.gift_store(first, col("outlet_code"), width=10).alias("store_id"))


@query("k_layout_columns", "SELECT store_id, division AS merchant FROM store")
def _k_layout(t: Tables):
    shown = t.store.withColumnRenamed("division", "merchant")
    return shown.select(*[c for c in K.layout_columns("v1") if c in shown.columns])


