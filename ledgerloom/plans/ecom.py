"""E-commerce order facts: flattening of nested reports, completeness, profiles, funnels."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import dates as D
from ledgerloom.functions import geo as G
from ledgerloom.functions import nested as N
from ledgerloom.functions import text as X
from ledgerloom.operators import joins as J
from ledgerloom.operators import recon as Q
from ledgerloom.operators import rollup as R
from ledgerloom.operators import windows as W
from ledgerloom.sources import ingest as I


def new_reports(reports: DataFrame, target: DataFrame, org: str) -> DataFrame:
    """J-02: reports past their organisation's newest loaded file date."""
    return I.above_group_high_water(reports.withColumn("organization_id", F.col(org)), target, "organization_id")


def flatten_decisions(reports: DataFrame, fields: Mapping[str, str], like_fields: Mapping[str, str], provider: str, provider_fields: Mapping[str, str]) -> DataFrame:
    """C-14..C-16, E-22: one row per request.

    Struct paths, named fields and one provider's fields are read in the same pass, so there
    is nothing to join back (Q17).  A report without providers keeps its row.
    """
    order = "Report.Transaction.Order"
    named = reports.withColumn("__m", N.name_value_map(F.col("Report.Transaction.MerchantDefinedData.Field")))
    one = F.get(F.filter("Report.Transaction.Providers.Provider", lambda p: p["name"] == provider), F.lit(0))
    named = named.withColumn("__p", N.name_value_map(one["Field"]))
    return named.select(
        "file_date",
        "organization_id",
        F.col(f"{order}.RequestID").alias("request_id"),
        F.col(f"{order}.MerchantID").alias("merchant_id"),
        F.col(f"{order}.LineItem").alias("line_items"),
        *[F.try_element_at("__m", F.lit(n)).alias(out) for out, n in fields.items()],
        *[N.name_like_value(F.col("Report.Transaction.MerchantDefinedData.Field"), p).alias(out) for out, p in like_fields.items()],
        *[F.try_element_at("__p", F.lit(n)).alias(out) for out, n in provider_fields.items()],
    )


def flatten_conversions(reports: DataFrame) -> DataFrame:
    """E-22: one row per conversion; a report without conversions keeps one empty row."""
    rows = J.unnest(reports.select("file_date", F.col("Report.MerchantID").alias("merchant_id"), F.col("Report.Conversion").alias("c")), F.col("c"), "x", outer=True)
    return rows.select("file_date", "merchant_id", "x.RequestID", "x.NewDecision", "x.Reviewer", "x.ConversionDate")


def merchant_label(merchant: Column, labels: Mapping[str, str]) -> Column:
    """C-09: label of the first matching part of a merchant id."""
    out: Column | None = None
    for part, name in labels.items():
        out = F.when(merchant.contains(part), name) if out is None else out.when(merchant.contains(part), name)
    assert out is not None
    return out


def completeness(orders: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """I-09: counts per merchant and day over exploded line items, and the days missing before."""
    rows = orders.withColumn("merchant", merchant_label(F.col("merchant_id"), labels)).withColumn("day", F.col("order_time").cast("date"))
    items = J.unnest(rows, F.col("line_items"), "li")
    aggs = {
        "total_orders": F.count("*"),
        "total_customers": F.count("customer_id"),
        "unique_customers": F.countDistinct("customer_id"),
        "unique_products": F.countDistinct("li.ProductSKU"),
        "total_products": F.count("li.ProductSKU"),
        "total_price": F.sum(F.col("li.Price") * F.col("li.Quantity")),
    }
    return Q.completeness(items, ["merchant"], "day", aggs)


def line_items(orders: DataFrame, articles: DataFrame, labels: Mapping[str, str], since: dt.date | None = None, only: DataFrame | None = None) -> DataFrame:
    """E-22, E-08, C-09: line items by product category, optionally only of given requests."""
    rows = orders if since is None else orders.where(F.col("order_time") >= F.lit(since).cast("timestamp_ntz"))
    if only is not None:
        rows = J.left_semi(rows, only, ["request_id"])
    rows = rows.withColumn("merchant", merchant_label(F.col("merchant_id"), labels))
    items = J.unnest(rows, F.col("line_items"), "li").select("request_id", "merchant", F.col("order_time").cast("date").alias("order_date"), "li.ProductSKU", "li.Price", "li.Quantity")
    items = J.lookup(items, articles, {"sku": "ProductSKU"}, ["category"])
    items = items.withColumn("category", F.coalesce(X.blank_to_null(F.col("category")), F.lit("No Product Category")))
    return items.groupBy("request_id", "merchant", "order_date", "category", F.col("ProductSKU").alias("sku")).agg(
        F.sum("Price").alias("price"), F.sum("Quantity").alias("quantity"), F.sum(F.col("Price") * F.col("Quantity")).alias("total_price")
    )


def order_fact(orders: DataFrame, conversions: DataFrame, reviewers: DataFrame, store: DataFrame, zone: str = "Australia/Sydney", open_hour: int = 9, close_hour: int = 19) -> DataFrame:
    """Order fact: review result, reviewer, local time, trading-hours flag, distance band.

    ``close_hour`` itself is in hours (Q8); coordinates are degrees on both sides (Q13).
    """
    latest = W.keep_first(conversions, ["request_id"], [F.col("conversion_time").desc(), F.col("reviewer_id")])
    rows = orders.join(latest.select("request_id", "new_decision", "conversion_time", "reviewer_id"), "request_id", "left")
    people = W.keep_first(reviewers.withColumn("__r", F.upper(X.strip_quotes(F.col("reviewer_key")))), ["__r"], [F.col("shift").desc(), F.col("name")])
    rows = J.lookup(rows, people, {"__r": F.upper("reviewer_id")}, {"name": "reviewer_name", "shift": "shift"})
    place = store.select("store_id", F.col("latitude").alias("__lat"), F.col("longitude").alias("__lon"))
    rows = rows.join(place, "store_id", "left")
    local = D.local_from_utc(F.col("order_time"), zone)
    hour = F.hour(local)
    km = F.round(G.great_circle_km(F.col("latitude"), F.col("longitude"), F.col("__lat"), F.col("__lon")), 3)
    review = F.coalesce("review_decision", "new_decision")
    return rows.select(
        "request_id",
        "merchant_id",
        local.cast("date").alias("order_date"),
        D.month_start(local.cast("date")).alias("order_month"),
        hour.alias("order_hour"),
        "decision",
        review.alias("review_decision"),
        F.coalesce("reviewer_name", "reviewer_id", F.lit("NA")).alias("reviewer"),
        F.coalesce(X.blank_to_null(F.nullif("shift", F.lit("-"))), F.lit("Unknown")).alias("shift"),
        F.when((hour > close_hour) | (hour < open_hour), 1).otherwise(0).alias("after_hours"),
        km.alias("distance_km"),
        G.band(km, [10, 50, 100]).alias("distance_band"),
        X.email_domain(F.col("email")).alias("email_domain"),
        "card_bin",
        "amount_cents",
    )


def customer_profile(orders: DataFrame, attributes: Sequence[str] = ("address", "email", "phone"), min_orders: int = 3, across_customers: bool = False) -> DataFrame:
    """F-11, F-12: how steady a customer's contact details are, order by order.

    Per attribute: the order's number among orders with the same value, whether the value is
    new, and whether it counts as consistent.  Row numbers and running counts are two-level, so
    a single customer may hold any share of the orders.  ``across_customers`` reproduces the
    running count over the whole table (Q3).
    """
    order = [F.col("order_time"), F.col("request_id")]
    day = F.col("order_time").cast("date")
    base = orders.select("customer_id", "order_time", "request_id", *attributes)
    rows = W.sequence_in_group(base, ["customer_id"], order, day, "order_no", base)
    for a in attributes:
        rows = W.sequence_in_group(rows, ["customer_id", a], order, day, f"{a}_no", base)
        rows = rows.withColumn(f"is_new_{a}", F.when(F.col(f"{a}_no") == 1, 1).otherwise(0).cast("long"))
        # what the running count adds up per bucket: the first order of every value
        first = base.groupBy("customer_id", a).agg(F.min(F.struct("order_time", "request_id")).alias("f"))
        ones = first.select("customer_id", "f.order_time", "f.request_id", F.lit(1).cast("long").alias("one"))
        marks = base.select("customer_id", "order_time", "request_id", F.lit(0).cast("long").alias("one")).unionByName(ones)
        new = F.col(f"is_new_{a}")
        if across_customers:
            spread = [F.struct("customer_id", day), W.range_bucket(orders, "customer_id")]
            rows = W.running_sum(rows, [], [F.col("customer_id"), *order], new, spread, f"{a}_seen", marks, F.col("one"))
        else:
            rows = W.running_sum(rows, ["customer_id"], order, new, day, f"{a}_seen", marks, F.col("one"))
    totals = base.groupBy("customer_id").agg(F.count("*").alias("total_orders"), *[F.countDistinct(a).alias(f"total_{a}") for a in attributes])
    rows = rows.join(totals, "customer_id")
    steady = F.col("total_orders") >= min_orders
    out = rows.withColumn("is_order_consistent", F.when(steady, 1).otherwise(0))
    for a in attributes:
        moved = (F.col(f"{a}_seen") > 1) & (F.col(f"{a}_no") < 3)
        ok = ~moved | (F.col("order_no") == F.col(f"{a}_no"))
        out = out.withColumn(f"is_{a}_consistent", F.when(ok, 1).otherwise(0))
        steady = steady & (F.col(f"is_{a}_consistent") == 1)
    keep = ["customer_id", "request_id", "order_no", "total_orders", "is_order_consistent"]
    for a in attributes:
        keep += [f"{a}_no", f"total_{a}", f"is_new_{a}", f"is_{a}_consistent"]
    return out.withColumn("is_customer_consistent", F.when(steady, 1).otherwise(0)).select(*keep, "is_customer_consistent")


def order_chargebacks(orders: DataFrame, chargebacks: DataFrame) -> DataFrame:
    """E-08, F-01: orders that became chargebacks, one row per order with its first chargeback."""
    first = W.keep_first(chargebacks, ["order_id"], [F.col("received_dt"), F.col("id")])
    return orders.join(first.select("order_id", F.col("received_dt").alias("chargeback_received"), F.col("amount_cents").alias("chargeback_cents")), "order_id")


def _funnel(orders: DataFrame) -> DataFrame:
    """D-08 first step: distinct requests and amounts at the fine grain."""
    fine = ["merchant_id", "card_bin", "order_month", "decision", "review_decision"]
    return orders.groupBy(*fine).agg(F.countDistinct("request_id").alias("n"), F.sum("amount_cents").alias("cents"))


def insight(orders: DataFrame, keys: Sequence[str], months: int | None = None, newest: Column | None = None) -> DataFrame:
    """D-08, C-10: decision funnel counts and amounts.  The distinct counts are taken at the fine
    grain and then added up; they are not a distinct count of the coarse grain."""
    rows = orders.withColumn("order_month", D.month_start(F.col("order_time").cast("date")))
    if months is not None:
        edge = newest if newest is not None else rows.agg(F.max("order_month")).scalar()
        rows = rows.where(F.col("order_month") >= F.add_months(edge, -months))
    step = _funnel(rows)
    d, r = F.col("decision"), F.col("review_decision")
    n, c = F.col("n"), F.col("cents")
    return step.groupBy(*keys).agg(
        F.sum(n).alias("total_transactions"),
        F.sum(c).alias("total_cents"),
        R.sum_if(d == "ACCEPT", n).alias("systems_accept"),
        R.sum_if(d == "ACCEPT", c).alias("systems_accept_cents"),
        R.sum_if(d == "REJECT", n).alias("systems_reject"),
        R.sum_if(d == "REJECT", c).alias("systems_reject_cents"),
        R.sum_if(d == "REVIEW", n).alias("review"),
        R.sum_if(r == "ACCEPT", n).alias("reviewer_accept"),
        R.sum_if(r == "REJECT", n).alias("reviewer_reject"),
        (R.sum_if(r == "REJECT", c) + R.sum_if(d == "REJECT", c)).alias("prevented_cents"),
    )


def oversight(orders: DataFrame, chargebacks: DataFrame, months: int = 49) -> DataFrame:
    """Funnel per merchant, bank and month with the chargebacks of the same key (G-05); keys with
    chargebacks only are kept, with zeros."""
    keys = ["merchant_id", "card_bin", "order_month"]
    funnel = insight(orders, keys, months)
    hits = order_chargebacks(orders, chargebacks).withColumn("order_month", D.month_start(F.col("order_time").cast("date")))
    back = hits.groupBy(*keys).agg(F.count("*").alias("chargebacks"), F.sum("chargeback_cents").alias("chargeback_cents"))
    return funnel.join(back, keys, "full").fillna(0, [c for c in (*funnel.columns, *back.columns) if c not in keys])
