"""File arrival and near-real-time tail (L-01..L-05)."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import dates as D
from ledgerloom.sources import ingest


def arriving_lines(spark: SparkSession, path: str, max_files: int = 1000) -> DataFrame:
    """L-02: text files as they land, in any folder below ``path``, with their path below it as the name:
    files of one name in two folders are two files."""
    lines = spark.readStream.option("maxFilesPerTrigger", max_files).option("recursiveFileLookup", "true").text(path)
    root = re.sub(r"^\w+:/*", "/", path).rstrip("/")
    below = F.regexp_replace(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), "^.*?" + re.escape(root) + "/", "")
    return lines.select("value", below.alias("file_name"))


def arriving_rows(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", max_files: int = 1000) -> DataFrame:
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", max_files).load(path)


def file_ledger(target: str) -> str:
    """Where the names of landed files are kept: one small row per file, not the data itself."""
    return f"{target.rstrip('/')}__files"


def record_files(names: DataFrame, target: str, batch_id: int) -> None:
    """Note files as landed; batch loads call this too, with a negative batch id."""
    one = names.select("file_name").distinct().withColumn("batch_id", F.lit(batch_id).cast("long"))
    one.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(file_ledger(target))


def ingest_arrivals(
    lines: DataFrame, parse: Callable[[DataFrame], DataFrame], target: str, checkpoint: str
) -> None:
    """L-02: land every new file once.

    The file source's checkpoint remembers files; the anti join against the ledger of names
    additionally covers files that came in through a batch load.  Re-running a batch after a
    failure rewrites the same ``batch_id`` folders, so a replay does not double rows.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        typed = parse(batch)
        try:
            seen = spark.read.schema("file_name string, batch_id long").parquet(file_ledger(target))
            typed = ingest.not_loaded(typed, seen.where(F.col("batch_id") != batch_id))
        except AnalysisException as exc:  # the first batch finds no ledger yet
            if exc.getCondition() != "PATH_NOT_FOUND":
                raise
        out = typed.withColumn("batch_id", F.lit(batch_id).cast("long"))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(target)
        record_files(batch, target, batch_id)

    query = lines.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def nrt_tail(
    batch_fact: DataFrame, live: DataFrame, store: str, ts: str, now: dt.datetime, floor_days: int | None = None
) -> DataFrame:
    """L-01: batch rows plus the live rows newer than their store's newest batch time.

    Stores without batch rows take all their live rows; times in the future are left out;
    ``floor_days`` bounds how far back the live part reaches.
    """
    newest = batch_fact.groupBy(store).agg(F.max(ts).alias("__newest"))
    tail = live.join(newest, store, "left").where(F.col("__newest").isNull() | (F.col(ts) > F.col("__newest"))).drop("__newest")
    tail = tail.where(F.col(ts) <= D.at(now))
    if floor_days is not None:
        tail = tail.where(F.col(ts) >= D.at(now - dt.timedelta(days=floor_days)))
    return batch_fact.withColumn("src_type", F.lit("BATCH")).unionByName(
        tail.withColumn("src_type", F.lit("NRT")), allowMissingColumns=True
    )


def unique_stream(stream: DataFrame, keys: Sequence[str], ts: str, late: str) -> DataFrame:
    """L-04: first copy of a transaction within the lateness bound; the batch load stays the authority."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


def windowed_totals(stream: DataFrame, ts: str, dims: Sequence[str], value: Column, length: str, late: str) -> DataFrame:
    """L-05 for fixed lengths; calendar periods are truncated dates (see rollup.timeframes)."""
    return (
        stream.withWatermark(ts, late)
        .groupBy(F.window(ts, length), *dims)
        .agg(F.count("*").alias("rows"), F.sum(value).alias("total"))
        .select(F.col("window.start").alias("period_start"), *dims, "rows", "total")
    )


def calendar_totals(stream: DataFrame, ts: str, calendar: DataFrame, period: Sequence[str], ends: str, dims: Sequence[str], value: Column, late: str) -> DataFrame:
    """L-05 for periods of a calendar: fiscal weeks, periods and years have no fixed length.

    Each row gets its day's ``period`` columns from ``calendar`` (one row a ``calendar_date``); ``ends``
    is the period's last day.  The end of that day is the event time, so the state of a period is
    kept until a row of a period that ends ``late`` after it arrives.  A day that the calendar lacks fails.
    """
    days = calendar.select(F.col("calendar_date").alias("__day"), *period, F.date_add(ends, 1).cast("timestamp").alias("period_end"))
    dated = stream.withColumn("__day", F.col(ts).cast("date")).join(days, "__day", "left")
    end = F.coalesce("period_end", F.raise_error(F.concat(F.lit("no calendar day "), F.col("__day").cast("string"))).cast("timestamp"))
    dated = dated.withColumn("period_end", end).withWatermark("period_end", late)
    return dated.groupBy("period_end", *period, *dims).agg(F.count("*").alias("rows"), F.sum(value).alias("total"))
