"""Typed landing of raw feeds (A-10..A-15, J-01..J-04)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import dates as D
from ledgerloom.sources.tables import local_table

AUDIT = ["file_date", "file_name", "load_time", "payload_id"]

# fixed values: default text formats per type
DEFAULT_FORMATS = {"date": "dd/MM/yyyy", "timestamp": "yyyy/MM/dd HH:mm:ss", "time": "HH:mm:ss"}


@dataclass(frozen=True)
class FeedFormat:
    """A-11: how one feed writes its dates; a column may override its type's format."""

    date: str = DEFAULT_FORMATS["date"]
    timestamp: str = "yyyy-MM-dd HH:mm:ss"
    time: str = DEFAULT_FORMATS["time"]
    columns: Mapping[str, str] = field(default_factory=dict)


# fixed values: date and timestamp layouts of the curated feeds
COMPACT = FeedFormat(date="yyyyMMdd", timestamp="yyyyMMddHHmmss")
FEEDS = {
    "switch": COMPACT,
    "switch_history": COMPACT,
    "switch_extended": COMPACT,
    "switch_extended_history": COMPACT,
    "scheme_visa": COMPACT,
    "scheme_eftpos": COMPACT,
    "scheme_eftpos_settlement": COMPACT,
    "merchant_fee": FeedFormat(date="yyyyMMdd"),
    "wallet": FeedFormat(date="yyyyMMdd", timestamp="MM/dd/yyyy HH:mm:ss"),
    "gift_item_report": FeedFormat(date="yyyyMMdd"),
    "gift_sales_report": FeedFormat(date="yyyyMMdd", timestamp="dd/MM/yyyy hh:mm:ss a"),
    "gift_partner_summary": FeedFormat(timestamp="dd/MM/yyyy HH:mm:ss"),
    "gift_partner_detail": FeedFormat(timestamp="dd/MM/yyyy HH:mm:ss"),
    "gift_detail": FeedFormat(date="dd/MM/yyyy"),
    "gift_detail_hourly": FeedFormat(date="dd/MM/yyyy"),
    "gift_order_summary": FeedFormat(timestamp="dd-MM-yyyy HH:mm:ss"),
    "gift_order_detail": FeedFormat(date="yyyyMMdd"),
    "apm_wallet": FeedFormat(date="yyyy-MM-dd", timestamp="yyyy-MM-dd HH:mm:ss[.SSSSSS]", time="HH:mm:ss[.SSSSSS]"),
    "apm_settlement": FeedFormat(timestamp="yyyy-MM-dd HH:mm:ss[.SSSSSS]"),
    "apm_transaction": FeedFormat(timestamp="yyyy-MM-dd HH:mm:ss[.SSSSSS]"),
    "chargebacks": FeedFormat(),
    "ecom_chargebacks": FeedFormat(date="dd-MMM-yy", timestamp="dd/MM/yyyy HH:mm"),
    "terminal_authorisations": FeedFormat(date="yyyyMMdd", timestamp="yyyyMMddHHmmss"),
    "terminal_chargebacks": FeedFormat(date="yyyyMMdd"),
    "terminal_accounts": FeedFormat(date="yyyyMMdd"),
    "terminal_postings": FeedFormat(date="yyyyMMdd"),
    "terminal_transactions": FeedFormat(date="yyyyMMdd", timestamp="yyyyMMddHH:mm:ss"),
    "ecom_sku": FeedFormat(timestamp="yyyy-MM-dd'T'HH:mm:ssXXX"),
    "ecom_sku_other": FeedFormat(timestamp="yyyy-MM-dd'T'HH:mm:ssXXX"),
    "ecom_transactions": FeedFormat(),
}


def typed_column(f: T.StructField, fmt: FeedFormat) -> Column:
    """A-10, C-12: text to the target type, null when it does not parse.

    A column documented as ``time`` in its metadata stays HH:mm:ss text.
    """
    c = F.col(f.name)
    own = fmt.columns.get(f.name)
    kind = f.dataType
    if f.metadata.get("time"):
        parsed = F.try_to_timestamp(F.concat(F.lit("1970-01-01 "), c), F.lit("yyyy-MM-dd " + (own or fmt.time)))
        out = F.date_format(parsed, "HH:mm:ss")
    elif isinstance(kind, T.DateType):
        out = F.try_to_timestamp(c, F.lit(own or fmt.date)).cast("date")
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        out = F.try_to_timestamp(c, F.lit(own or fmt.timestamp)).cast(kind)
    elif isinstance(kind, T.StringType):
        out = c
    else:
        out = F.trim(c).try_cast(kind)
    return out.alias(f.name)


def typed_projection(df: DataFrame, target: T.StructType, fmt: FeedFormat | None = None) -> DataFrame:
    """A-10: audit columns first, then one cast per target column."""
    use = fmt or FeedFormat(timestamp=DEFAULT_FORMATS["timestamp"])
    audit = [c for c in AUDIT if c in df.columns]
    return df.select(*audit, *[typed_column(f, use) for f in target.fields if f.name not in AUDIT])


def curate(df: DataFrame, feed: str, target: T.StructType) -> DataFrame:
    """A-11: typed projection with the formats of a named feed."""
    return typed_projection(df, target, FEEDS[feed])


def with_audit(df: DataFrame, file_date: Column, load_time: dt.datetime, payload_id: str) -> DataFrame:
    """A-12: the four audit columns lead."""
    rest = [c for c in df.columns if c not in AUDIT]
    return df.select(
        file_date.cast("date").alias("file_date"),
        "file_name",
        D.at(load_time).alias("load_time"),
        F.lit(payload_id).alias("payload_id"),
        *rest,
    )


# fixed values: where each family of file names carries its date, as (pattern, date format)
FILE_DATES = {
    "gift": (r"(\d{4}_\d{2}_\d{2})_\d{8}\.[^/]*$", "yyyy_MM_dd"),
    "merchant_fee": (r"(\d{8})_?\d{6,7}\.[^/]*$", "yyyyMMdd"),
    "acquirer": (r"(\d{8})\d{2}\.[^/]*$", "yyyyMMdd"),
    "store_feed": (r"\.D(\d{6})\.[^/]*$", "yyMMdd"),
    "wallet": (r"(\d{8})\d{6}\.[^/]*$", "yyyyMMdd"),
    "sales_report": (r"(\d{8})_?\d{4,5}\.[^/]*$", "yyyyMMdd"),
    "scheme": (r"\.D(\d{6})(?:\.|$)", "yyMMdd"),
    "default": (r"(\d{8})\.[^/]*$", "yyyyMMdd"),
}


def file_date_from_name(name: Column, family: str = "default") -> Column:
    """A-13: date part of a file name; null when the name has none."""
    pattern, fmt = FILE_DATES[family]
    text = F.nullif(F.regexp_extract(name, pattern, 1), F.lit(""))
    return F.try_to_timestamp(text, F.lit(fmt)).cast("date")


def not_loaded(df: DataFrame, target: DataFrame) -> DataFrame:
    """A-14: lines of files the target has not seen; the target side is one row per file."""
    return df.join(target.select("file_name").distinct(), "file_name", "left_anti")


def empty_file_audit(files: DataFrame, rows: DataFrame) -> DataFrame:
    """A-15: which of the listed files brought no rows (``files`` has path names)."""
    counted = rows.groupBy("file_name").agg(F.count("*").alias("rows"))
    return files.join(counted, "file_name", "left").select(
        "file_name", F.coalesce("rows", F.lit(0)).alias("rows"), F.col("rows").isNull().alias("is_empty")
    )


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """File names and sizes from the folder's listing; empty files are listed too."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = [(f.getPath().getName(), f.getLen()) for f in fs.listStatus(folder) if f.isFile()]
    return local_table(spark, "file_name string, bytes long", found)


def next_date_files(files: DataFrame, loaded: DataFrame) -> DataFrame:
    """J-01: files dated one day after the newest loaded date; the first of all when none is loaded."""
    newest = loaded.agg(F.max("file_date")).scalar()
    oldest = files.agg(F.min("file_date")).scalar()
    return files.where(F.col("file_date") == F.coalesce(F.date_add(newest, 1), oldest))


def above_group_high_water(src: DataFrame, target: DataFrame, group: str, mark: str = "file_date") -> DataFrame:
    """J-02: rows beyond their group's newest mark; groups not seen before pass whole.

    Groups are few (organisations, feeds) and hold most rows each, so their marks go to the rows:
    dealt by group, each group would be one task.
    """
    high = target.groupBy(group).agg(F.max(mark).alias("__high"))
    joined = src.join(F.broadcast(high), group, "left")
    return joined.where(F.col("__high").isNull() | (F.col(mark) > F.col("__high"))).drop("__high")


def overlap_unseen(src: DataFrame, target: DataFrame, stamp: str, days: int = 3) -> DataFrame:
    """J-03: re-read some days before the newest stamp, keep stamps the target lacks.

    An empty target takes the whole source.
    """
    newest = target.agg(F.max(stamp)).scalar()
    recent = src.where(newest.isNull() | (F.col(stamp) >= newest - F.make_dt_interval(days=F.lit(days))))
    return recent.join(target.select(stamp).distinct(), stamp, "left_anti")
