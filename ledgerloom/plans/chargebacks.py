"""Chargeback report, detail, fact and day view."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import dates as D
from ledgerloom.functions import text as X
from ledgerloom.operators import joins as J
from ledgerloom.operators import windows as W
from ledgerloom.sinks import tables as T

# fixed values: days a bank gives for a response, other banks as "other"
CLOSE_DAYS = {"MASTERCARD": 45, "VISA": 45, "other": 14}
LIABILITY_DAYS = {"MASTERCARD": 45, "VISA": 45, "other": 12}


def _has(name: str) -> Column:
    return F.col(name).isNotNull()


def final_status() -> Column:
    """Where the case stands, from the request, response and charge dates."""
    closed = F.when(_has("charged_dt"), "Closed and Unsuccessful").otherwise("Closed and Successful")
    sent, answered = _has("rr_sent_dttm_utc"), _has("response_dttm_utc")
    opened = (
        F.when(~sent & ~answered, "Received into slipper not sent to store")
        .when(sent & ~answered, "Sent to store waiting on response")
        .when(sent & answered & _has("charged_dt"), "Charged and Open")
        .otherwise("Waiting on Scheme")
    )
    state = F.lower("status_open")
    return F.when(state == "t", opened).when(state == "f", closed)


def days_left(table: Mapping[str, int]) -> Column:
    """Days from the file date to the bank's deadline."""
    bank = F.upper("bank")
    allowed = F.lit(table["other"])
    for name, days in table.items():
        if name != "other":
            allowed = F.when(bank == name, days).otherwise(allowed)
    return F.datediff(F.date_add(F.col("received_dt").cast("date"), allowed), F.col("file_date"))


def liability() -> Column:
    charged_only = _has("charged_dt") & ~_has("chgbk_rev_dt")
    both_or_none = _has("charged_dt") == _has("chgbk_rev_dt")
    closed = F.when(charged_only, "Charged Liability and Closed").otherwise("Successfully Contested")
    opened = F.when(charged_only, "Charged Liability and Open").when((days_left(LIABILITY_DAYS) > 0) | both_or_none, "Potential Liability - Open").otherwise("")
    state = F.lower("status_open")
    return F.when(state == "f", closed).when(state == "t", opened).otherwise(" ")


def presence(is_online: str = "is_online", signature: str = "signature") -> Column:
    return F.when((F.upper(is_online) == "ONLINE") | (F.upper(signature) == "CNP"), "CNP").otherwise("CP")


def report(chargebacks: DataFrame, store: DataFrame) -> DataFrame:
    """Chargeback report: status, ages, liability, store attributes."""
    rows = J.lookup(chargebacks, store.withColumn("__id", F.upper("store_id")), {"__id": F.upper("store_id")}, ["site_name", "division", "company", "is_online"], "inner")
    return rows.select(
        "id",
        "bank_ref_no",
        "store_id",
        F.col("file_date").alias("processing_date"),
        final_status().alias("final_status"),
        F.datediff(F.col("file_date"), F.col("received_dt").cast("date")).alias("days_since_raised"),
        days_left(CLOSE_DAYS).alias("days_to_close"),
        liability().alias("chargeback_status"),
        presence().alias("cp_indicator"),
        "site_name",
        "division",
        "company",
    )


def activity_stage(request: Column, response: Column, challenged: Column, reversal: Column, is_open: Column) -> Column:
    """Stage of a case from its five flags."""
    waiting = F.when(response, "Unworked").when(request, "Merchant Response Awaited").otherwise("Request to be send to merchant")
    unchallenged = F.when(is_open, waiting).otherwise(F.when(reversal, "Withdrawn by Issuer").otherwise("Accepted Liability (Unchallenged)"))
    disputed = F.when(is_open, F.when(reversal, "Pending-Credit Received").otherwise("Pending-Credit Not Received")).otherwise(F.when(reversal, "Won").otherwise("Loss"))
    return F.when(~challenged, unchallenged).when(response, disputed)


def outcome(challenged: Column, reversal: Column, is_open: Column) -> Column:
    """Short outcome of a case; a case withdrawn unchallenged has none."""
    return (
        F.when(~challenged & is_open, "Needs action")
        .when(~challenged & ~reversal, "Accepted")
        .when(challenged & is_open, "Contested - in review")
        .when(challenged & reversal, "Contested - won")
        .when(challenged, "Contested - lost")
    )


def detail(current: DataFrame, history: DataFrame, store: DataFrame, since: dt.date, until: dt.date) -> DataFrame:
    """Current cases plus history rows whose reference is not current, one row per case (F-04, E-06)."""
    one = W.keep_first(current, ["bank_ref_no"], [F.col("file_date").desc(), F.col("id").desc()])
    older = history.withColumn("bank_ref_no", X.null_text_to_null(F.col("bank_ref_no")))
    older = J.not_in(older, one.select("bank_ref_no"), "bank_ref_no")
    older = W.keep_first(older, ["bank_ref_no"], [F.col("file_date").desc(), F.col("id").desc()])
    rows = one.unionByName(older, allowMissingColumns=True)
    received = F.col("received_dt")
    rows = rows.where((received >= F.lit(since).cast("timestamp_ntz")) & (received < F.lit(until).cast("timestamp_ntz")))
    rows = J.lookup(rows, store, {"store_id": F.upper("store_id")}, ["site_name", "is_online", "state"])
    request, response, challenged, reversal = (_has(c) for c in ("rr_sent_dttm_utc", "response_dttm_utc", "chgbk_challenge_dt", "chgbk_rev_dt"))
    is_open = F.lower("status_open") == "t"
    yn = lambda c: F.when(c, "Y").otherwise("N")
    day = received.cast("date")
    return rows.select(
        "id",
        "bank_ref_no",
        D.month_text(day).alias("chargeback_month"),
        D.sunday_week_start(day).alias("chargeback_week_start"),
        F.date_add(D.sunday_week_start(day), 6).alias("chargeback_week_end"),
        D.sunday_week_number(F.date_add(D.sunday_week_start(day), 6)).alias("week_no"),
        yn(request).alias("request_send_flag"),
        yn(response).alias("response_received_flag"),
        yn(challenged).alias("challenged_flag"),
        yn(reversal).alias("reversal_flag"),
        F.when(is_open, "open").otherwise("closed").alias("status_flag"),
        activity_stage(request, response, challenged, reversal, is_open).alias("activity_stage"),
        outcome(challenged, reversal, is_open).alias("outcome"),
        final_status().alias("final_status"),
        liability().alias("chargeback_status"),
        presence().alias("cp_indicator"),
        F.concat("store_id", F.lit(" | "), "site_name").alias("store_label"),
    )


def fact(source: DataFrame, existing: DataFrame, labels: Mapping[str, str], keys: Sequence[str], effective: dt.date) -> DataFrame:
    """E-07, F-01, J-20: cleaned, de-duplicated, only rows the fact lacks, validity columns.

    ``labels`` maps a pattern of the store name to a merchant; other stores are not loaded.
    """
    merchant: Column | None = None
    for pattern, name in labels.items():
        merchant = F.when(F.col("store_name").like(pattern), name) if merchant is None else merchant.when(F.col("store_name").like(pattern), name)
    rows = source.where(F.col("store_name").isNotNull()).withColumn("merchant_id", merchant).where(F.col("merchant_id").isNotNull())
    charged = F.col("charged_dt").cast("date")
    bought = F.col("txn_dttm_local").cast("date")
    when = F.when(charged.isNull() | (F.year(charged) == 1900), bought).otherwise(charged)
    rows = rows.withColumn("order_date", when).withColumn("days_for_chargeback", F.abs(F.datediff(bought, when)))
    first = W.keep_first(rows, keys, [F.col("txn_dttm_local"), F.col("id")])
    return T.with_validity(J.left_anti(first, existing, keys), effective)


def by_day(fact_rows: DataFrame) -> DataFrame:
    """B-11: chargebacks per merchant and day with the month beside it."""
    per = fact_rows.groupBy("merchant_id", F.col("order_date").alias("day")).agg(F.count("*").alias("chargebacks"), F.sum("amount_cents").alias("amount_cents"))
    return per.withColumn("month", D.month_text(F.col("day")))
