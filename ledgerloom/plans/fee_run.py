"""The fee-listing run: days to catch up, listing, history and control rows in one commit, one view a prefix.

State lives in ``VersionedTables``: listing (the last run's), history (by day) and control.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import dates as D
from ledgerloom.functions import text as X
from ledgerloom.operators import control as O
from ledgerloom.operators import joins as J
from ledgerloom.plans import fees as P
from ledgerloom.sinks import files as S
from ledgerloom.sinks import tables as T
from ledgerloom.sinks.versions import VersionedTables, Write
from ledgerloom.sources.tables import local_table

_MARK = "_feelist_"

# fixed values: columns of the views, by layout version
LISTING_LAYOUTS = {
    "V1": ["record_type", "terminal_id", "transaction_amt", "transaction_timestamp", "pan", "stan", "mti", "scheme", "card_type", "interchange_fee", "processing_fee"],
    "V2": ["record_type", "terminal_id", "transaction_amt", "transaction_timestamp", "pan", "stan", "mti", "scheme", "card_type", "interchange_fee", "processing_fee", "file_prefix", "tran_date"],
}


def listing_names(config: DataFrame) -> DataFrame:
    """Distinct (name, prefix, version, seq) of current and old prefixes; ``seq`` is a name's place in their order.

    ``config`` has file_prefix, version, file_prefix_old and version_old, a few rows a merchant.
    """
    now = config.select(F.col("file_prefix").alias("prefix"), "version")
    old = config.select(F.col("file_prefix_old").alias("prefix"), F.col("version_old").alias("version"))
    every = now.unionByName(old).where(X.non_blank(F.col("prefix")) & X.non_blank(F.col("version"))).distinct()
    every = every.withColumn("name", F.concat("prefix", F.lit(_MARK), "version"))
    return J.lookup(every, S.entity_sequence(every, "name", "seq"), {"name": "name"}, ["seq"], "inner")


def view_name(prefix: str, version: str) -> str:
    return re.sub(r"\W", "_", f"vw_{prefix}_fee_listing_{version}".lower())


def create_listing_views(listing: DataFrame, config: DataFrame, layouts: Mapping[str, Sequence[str]] | None = None, replace: bool = False) -> list[str]:
    """B-11: one view for each prefix and version found in ``config``, with the columns of its layout.

    Views that exist stay as they are, unless ``replace``.  An unknown version fails, and so do
    prefixes whose views would have one name.  The names of the views made.
    """
    layouts = LISTING_LAYOUTS if layouts is None else layouts
    spark, made, seen = listing.sparkSession, [], set()
    for r in listing_names(config).orderBy("seq").collect():  # a view is metadata: one row of the config each
        if r["version"] not in layouts:
            raise ValueError(f"{r['name']}: no layout {r['version']}")
        name = view_name(r["prefix"], r["version"])
        if name in seen:
            raise ValueError(f"two prefixes give one view {name}")
        seen.add(name)
        if replace or not spark.catalog.tableExists(name):
            T.create_view(listing.where(F.col("file_prefix") == r["prefix"]), name, layouts[r["version"]])
            made.append(name)
    return made


def catch_up_days(control: DataFrame, run_date: dt.date) -> list[dt.date]:
    """The day the run lists, or after missed runs every day since the last one's; by the newest batch in the control table."""
    mine = control.where(F.col("merchant_name").contains(_MARK))
    newest = mine.agg(F.max(F.struct("batch_number", "file_date")).alias("last")).first()["last"]
    return P.listing_days(run_date, newest["file_date"].date() if newest else None)


def control_gaps(control: DataFrame, config: DataFrame, first: dt.date, last: dt.date) -> DataFrame:
    """Names and days (both ends in) for which the control table has no row: name, day."""
    spine = listing_names(config).select("name", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("day"))
    known = control.select(F.col("merchant_name").alias("name"), F.col("extract_start").cast("date").alias("day"))
    return J.left_anti(spine, known, ["name", "day"])


def listing_control(config: DataFrame, days: Sequence[dt.date], batch: str, run_ts: dt.datetime) -> DataFrame:
    """J-13: one control row for each name and day; times are a name's place in seconds after midnight and after the run."""
    rows = listing_names(config).withColumn("day", F.explode(F.array(*[F.lit(d) for d in days])))
    at = D.plus_seconds(F.col("day").cast("timestamp_ntz"), F.col("seq"))
    return rows.select(
        F.lit(batch).alias("batch_number"), F.lit(run_ts.date()).alias("processing_date"), F.col("name").alias("merchant_name"), F.lit(True).alias("etl_complete"), F.lit(None).cast("boolean").alias("extract_wf_complete"),
        at.alias("extract_start"), at.alias("extract_end"), D.plus_seconds(D.at(run_ts), F.col("seq")).alias("file_date"), F.lit(None).cast("string").alias("remarks"),
    )


def next_batch(control: DataFrame, lookup: str = "FTLF") -> str:
    """J-12: the batch after the newest one of the listings, the first if there is none."""
    last = control.where(F.col("merchant_name").contains(_MARK)).agg(F.coalesce(F.max("batch_number"), F.lit(f"{lookup}000000000")).alias("last_batch"))
    return O.next_batch(last.withColumn("lookup", F.lit(lookup)), lookup).first()["batch_number"]


def run(
    tables: VersionedTables, fee_tables: Sequence[DataFrame], store: DataFrame, windows: DataFrame, config: DataFrame, run_ts: dt.datetime, width: int = 5,
    key: str | None = None, after_write: Callable[[str], None] | None = None,
) -> list[dt.date]:
    """One run; the days it listed.  None if the run (``key``, else its date) is committed already."""
    key = key or f"fees-{run_ts.date()}"
    if tables.holds(key):
        return []
    spark: SparkSession = config.sparkSession
    control = tables.read("control") if "control" in tables.tables() else local_table(spark, O.CONTROL_SCHEMA, [])
    days = catch_up_days(control, run_ts.date())
    listing = P.fee_listing(fee_tables, store, windows, days, width)
    history = lambda written: written("listing").where(F.col("record_type") != "T").withColumn("processing_date", F.lit(run_ts.date()))
    writes = {"listing": Write(listing), "history": Write(history, "append", "tran_date"), "control": Write(listing_control(config, days, next_batch(control), run_ts), "append")}
    tables.commit(key, writes, after_write)
    return days
