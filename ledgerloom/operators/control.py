"""Control table and run state (J-12..J-18, C-22)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import dates as D
from ledgerloom.functions import text as X
from ledgerloom.operators import rollup as R
from ledgerloom.sinks import tables as S
from ledgerloom.sources.tables import local_table

CONTROL_SCHEMA = (
    "batch_number string, processing_date date, merchant_name string, etl_complete boolean, "
    "extract_wf_complete boolean, extract_start timestamp_ntz, extract_end timestamp_ntz, "
    "file_date timestamp_ntz, remarks string"
)


def file_landed(df: DataFrame, day: dt.date) -> bool:
    """C-22, G-03: guard of the scheduled rules; reads one row of one file date."""
    return not df.where(F.col("file_date") == F.lit(day)).select("file_date").limit(1).isEmpty()


def window_due(windows: DataFrame, hour: int, partner: bool = False) -> bool:
    """C-22: is any active window scheduled for this hour."""
    kind = F.col("division_type") == "PARTNER"
    due = windows.where((F.col("is_active") == "Y") & (F.col("settlement_cycle") == hour) & (kind if partner else ~kind))
    return not due.limit(1).isEmpty()


def next_batch(batches: DataFrame, lookup: str) -> DataFrame:
    """J-12: next batch text of one process; the prefix and the width of the number are kept.

    ``batches`` has one row per process: lookup, last_batch such as FTLF000000041.
    """
    digits = F.regexp_extract("last_batch", r"(\d+)$", 1)
    prefix = F.regexp_extract("last_batch", r"^(.*?)\d+$", 1)
    number = (digits.cast("long") + 1).cast("string")
    return batches.where(F.col("lookup") == lookup).select(
        "lookup", F.concat(prefix, F.when(F.length(number) >= F.length(digits), number).otherwise(F.lpad(number, F.length(digits), F.lit("0")))).alias("batch_number")
    )


def control_rows(
    detail: DataFrame, names: DataFrame, name: str, ts: str, batch: str, run_ts: dt.datetime
) -> DataFrame:
    """J-13: one row per output with its first and last transaction time, run time when empty."""
    spans = detail.groupBy(name).agg(F.min(ts).alias("__lo"), F.max(ts).alias("__hi"))
    now = D.at(run_ts)
    return names.select(name).distinct().join(spans, name, "left").select(
        F.lit(batch).alias("batch_number"),
        F.lit(run_ts.date()).alias("processing_date"),
        F.col(name).alias("merchant_name"),
        F.lit(True).alias("etl_complete"),
        F.lit(None).cast("boolean").alias("extract_wf_complete"),
        F.coalesce("__lo", now).alias("extract_start"),
        F.coalesce("__hi", now).alias("extract_end"),
        now.alias("file_date"),
        F.lit(None).cast("string").alias("remarks"),
    )


def weekly_due(day: dt.date, weekday: int = 0) -> bool:
    """C-22: weekly runs, Monday unless told otherwise."""
    return day.weekday() == weekday


def export_control(spark: SparkSession, name: str, batch: str, run_ts: dt.datetime, first: dt.datetime | None = None, last: dt.datetime | None = None) -> DataFrame:
    """A-19, J-13: control row of an output that is exported as it is (reference maps, weekly files)."""
    row = (batch, run_ts.date(), name, True, None, first or run_ts, last or run_ts, run_ts, None)
    return local_table(spark, CONTROL_SCHEMA, [row])


def pending(control: DataFrame) -> DataFrame:
    """J-14: computed, not yet exported."""
    return control.where(F.col("etl_complete") & F.col("extract_wf_complete").isNull())


def closed(control: DataFrame, exported: DataFrame, ok: bool = True, remarks: str | None = None) -> DataFrame:
    """J-14: control table after an export of the given batches."""
    done = exported.select("batch_number", "merchant_name").distinct().withColumn("extract_wf_complete", F.lit(ok)).withColumn("remarks", F.lit(remarks).cast("string"))
    return S.updated_from(control, done, ["batch_number", "merchant_name"], ["extract_wf_complete", "remarks"])


def audit_batch(detail: DataFrame, keys: list[str], ts: str, amount: str, discount: str, cutoff_start: Column, cutoff_end: Column, batch: str) -> DataFrame:
    """J-15."""
    return detail.groupBy(*keys).agg(
        F.lit(batch).alias("batch_number"),
        F.min(cutoff_start).alias("cutoff_start"),
        F.max(cutoff_end).alias("cutoff_end"),
        F.min(ts).alias("first_trans_time"),
        F.max(ts).alias("last_trans_time"),
        F.count("*").alias("no_trans_posted"),
        F.round(F.sum(amount), 2).alias("amount_posted"),
        F.sum(F.coalesce(F.col(discount), F.lit(0))).alias("discount_amount"),
    )


def mark_processed(settlement: DataFrame, posted: DataFrame, run_ts: dt.datetime) -> DataFrame:
    """J-16: settled rows get their result file; ``posted`` is (tran_uid, result_file)."""
    stamped = posted.groupBy("tran_uid").agg(F.max("result_file").alias("setlmnt_result_file")).withColumn(
        "posting_date", F.lit(run_ts.date())
    )
    return S.updated_from(settlement, stamped, ["tran_uid"], ["setlmnt_result_file", "posting_date"])


def advance_watermark(windows: DataFrame, facts: DataFrame, key: str, ts: str) -> DataFrame:
    """J-17, D-17: last execution is the least of the sources' newest times, per store or division."""
    source = facts.withColumn("__source", F.left("tran_uid", F.lit(2)))
    high = R.two_level_high_water(source, "__source", key, ts, "last_execution_time")
    return S.updated_from(windows, high, [key], ["last_execution_time"])


def file_sequence(history: DataFrame, day: dt.date) -> DataFrame:
    """J-18: next sequence of the day, one on a new day; one row."""
    today = F.lit(day)
    return history.agg(
        F.coalesce(F.max(F.when(F.col("file_transmission_date") == today, F.col("file_sequence_number"))) + 1, F.lit(1)).alias("file_sequence_number")
    ).withColumn("file_transmission_date", today)


def usable_batch(batch: str | None) -> bool:
    """C-22: a process stops when it got no batch number."""
    return bool(batch) and batch not in ("NOContRec", "UpdFailed")


def validated_swap(new: DataFrame, table: str, duplicates: DataFrame, drift: DataFrame) -> bool:
    """I-08: replace the dimension only when both findings are empty."""
    if not duplicates.limit(1).isEmpty() or not drift.limit(1).isEmpty():
        return False
    S.replace_table(new, table)
    return True


def missing_store_checks(store_col: str = "site_name") -> list[tuple[str, Column]]:
    """I-07 findings in reporting order."""
    return [
        ("Store not found in store details", F.col(store_col).isNull()),
        ("Store has no customer mapping", F.col("map_active").isNull()),
        ("Customer mapping is inactive", X.norm_key(F.col("map_active")) == "N"),
        ("Company code is blank", ~X.non_blank(F.col("company_code"))),
        ("Duplicate transaction", F.col("copies") > 1),
    ]
