"""Table sinks and table state (B-01..B-06, B-11, J-04..J-10, J-20, J-21)."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import dates as D


def recover_table(spark: SparkSession, table: str) -> bool:
    """Put a table back whose swap stopped between its two renames; was there anything to do?

    The version that was renamed away is the table again.  Where the table stands nothing is
    touched: what is left beside it may belong to a run that is still at work.
    """
    database, _, name = table.rpartition(".")
    prefix = f"{name}__old_".lower()
    here = f"{database}." if database else ""
    left = sorted(t.name for t in spark.catalog.listTables(database or None) if t.name.lower().startswith(prefix) and not t.isTemporary)
    lost = bool(left) and not spark.catalog.tableExists(table)
    if lost:
        if len(left) > 1:
            raise ValueError(f"{table} is gone and {left} are left: one of them is it")
        spark.sql(f"ALTER TABLE {here}{left.pop()} RENAME TO {table}")
    return lost


def replace_table(df: DataFrame, table: str) -> None:
    """B-01, B-02, J-04: full reload.

    The new version is written beside the old one and swapped in by renaming, so a job may
    read the table it replaces and a failed write leaves the old version in place.  The names in
    between are the run's own, so two runs don't drop each other's tables.  A run that stops
    between the renames leaves no table under its name; the next one, or a reader that calls
    ``recover_table``, puts it back.
    """
    spark = df.sparkSession
    own = uuid.uuid4().hex
    nxt, old = f"{table}__next_{own}", f"{table}__old_{own}"
    recover_table(spark, table)
    df.write.format("parquet").saveAsTable(nxt)
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} RENAME TO {old}")
    spark.sql(f"ALTER TABLE {nxt} RENAME TO {table}")
    spark.sql(f"DROP TABLE IF EXISTS {old}")


def conform(df: DataFrame, target: DataFrame) -> DataFrame:
    """B-03: columns in the target's order and types, absent ones null."""
    have = set(df.columns)
    return df.select(
        *[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.schema.fields]
    )


def append(df: DataFrame, table: str) -> None:
    """B-03, B-05."""
    spark = df.sparkSession
    if spark.catalog.tableExists(table):
        conform(df, spark.table(table)).write.mode("append").insertInto(table)
    else:
        df.write.format("parquet").saveAsTable(table)


def append_partitioned(df: DataFrame, path: str, by: str, files_per_value: int = 1) -> None:
    """B-04: Parquet append by date.  Rows of one date go to ``files_per_value`` tasks, so a
    busy date does not sit in a single task and a quiet one does not leave many small files."""
    spread = df
    if files_per_value > 1:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(files_per_value))
        spread = df.repartition(F.col(by), salt)
    spread.write.mode("append").partitionBy(by).parquet(path)


def history_append(df: DataFrame, table: str, run_ts: dt.datetime) -> None:
    """B-06: current output plus its run time, appended to the history."""
    append(df.select(D.at(run_ts).alias("run_ts"), "*"), table)


def replace_partitions(df: DataFrame, path: str, by: str) -> None:
    """J-05: the dates in ``df`` are replaced, other dates stay; the job commits all or nothing."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(path)


def create_view(df: DataFrame, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """B-11: named query, optionally with a column list chosen at run time."""
    out = df.select(*columns) if columns else df
    out.createOrReplaceTempView(name)
    return out


def only_new(df: DataFrame, target: DataFrame, keys: Sequence[str]) -> DataFrame:
    """J-06, J-09: rows whose key the target lacks; append the result."""
    return df.join(target.select(*keys), list(keys), "left_anti")


def updated_from(target: DataFrame, updates: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """J-07: matched rows take the new values (nulls included), the rest stay.

    ``updates`` must be one row per key.
    """
    new = updates.select(*keys, *[F.col(v).alias(f"__n_{v}") for v in values], F.lit(True).alias("__hit"))
    joined = target.join(new, list(keys), "left")
    return joined.select(
        *[F.when(F.col("__hit"), F.col(f"__n_{c}")).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in target.columns]
    )


def updated_where(target: DataFrame, cond: Column, values: Mapping[str, Column]) -> DataFrame:
    """J-08: all new values are taken from the row as it was."""
    hit = F.coalesce(cond, F.lit(False))
    return target.select(*[F.when(hit, values[c]).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in target.columns])


def without(target: DataFrame, cond: Column) -> DataFrame:
    """J-10: rows where the condition is not true stay."""
    return target.where(~F.coalesce(cond, F.lit(False)))


def with_validity(df: DataFrame, effective: dt.date) -> DataFrame:
    """J-20: effective from the given day, open end, current."""
    return (
        df.withColumn("effective_date", F.lit(effective))
        .withColumn("expiry_date", F.lit(None).cast("date"))
        .withColumn("is_current", F.lit(1))
    )


def audit_event(
    spark: SparkSession, job: str, status: str, started: dt.datetime, ended: dt.datetime, file_name: str | None = None, file_bytes: int | None = None
) -> DataFrame:
    """J-21: one event row of a run."""
    from ledgerloom.sources.tables import local_table

    millis = int((ended - started).total_seconds() * 1000)
    return local_table(
        spark,
        "job string, status string, started timestamp_ntz, ended timestamp_ntz, duration_ms long, file_name string, file_bytes long",
        [(job, status, started, ended, millis, file_name, file_bytes)],
    )
