"""Reconciliation and data-quality operators (I-01..I-10, I-24)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import dates as D
from ledgerloom.operators import joins as J
from ledgerloom.operators import windows as W
from ledgerloom.sources.tables import local_table


def totals(df: DataFrame, keys: Sequence[str], sums: Mapping[str, Column]) -> DataFrame:
    """I-04 first half: one row per key, so a later join cannot fan out and hot keys shrink."""
    return df.groupBy(*keys).agg(*[v.alias(n) for n, v in sums.items()])


def reconcile(
    left: DataFrame, right: DataFrame, keys: Sequence[str], left_name: str, right_name: str, flag: str = "flag"
) -> DataFrame:
    """I-01: full outer join of two sides that are one row per key, with a missing flag."""
    lhs = left.withColumn("__in_left", F.lit(True))
    rhs = right.withColumn("__in_right", F.lit(True))
    both = J.full_outer(lhs, rhs, keys)
    text = (
        F.when(F.col("__in_left").isNull(), f"Missing in {left_name}")
        .when(F.col("__in_right").isNull(), f"Missing in {right_name}")
        .otherwise("Not Missing")
    )
    return both.withColumn(flag, text).drop("__in_left", "__in_right")


def match_flag(a: Column, b: Column, tolerance: object = 0, null_as_zero: bool = True) -> Column:
    """I-02: 'Matched' when both amounts agree within the tolerance."""
    if null_as_zero:
        a, b = F.coalesce(a, F.lit(0)), F.coalesce(b, F.lit(0))
    same = F.abs(a - b) <= F.lit(tolerance) if tolerance else a == b
    return F.when(same, "Matched").otherwise("Mismatched")


def three_way(
    first: DataFrame, second: DataFrame, third: DataFrame, key: str, third_name: str, pair_name: str, flag: str = "flag"
) -> DataFrame:
    """I-03: first and second form one side (key of whichever has it), third is the other."""
    pair = J.full_outer(first, second, [key]).withColumn("__pair", F.lit(True))
    both = J.full_outer(pair, third.withColumn("__third", F.lit(True)), [key])
    text = (
        F.when(F.col("__third").isNull(), f"Missing in {third_name}")
        .when(F.col("__pair").isNull(), f"Missing in {pair_name}")
        .otherwise("Not Missing")
    )
    return both.withColumn(flag, text).drop("__pair", "__third")


def duplicate_keys(df: DataFrame, keys: Sequence[str], out: str = "copies") -> DataFrame:
    """I-05, D-10."""
    return df.groupBy(*keys).agg(F.count("*").alias(out)).where(F.col(out) > 1)


def columns_of(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A-16: a schema as rows (ordinal_position, column_name, data_type)."""
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(schema.fields)]
    return local_table(spark, "ordinal_position int, column_name string, data_type string", rows)


def schema_drift(spark: SparkSession, actual: T.StructType, expected: T.StructType) -> DataFrame:
    """I-06: positions whose name or type differs, or that only one side has."""
    a = columns_of(spark, actual).select(
        "ordinal_position", F.col("column_name").alias("actual_name"), F.col("data_type").alias("actual_type")
    )
    e = columns_of(spark, expected).select(
        "ordinal_position", F.col("column_name").alias("expected_name"), F.col("data_type").alias("expected_type")
    )
    both = a.join(e, "ordinal_position", "full")
    same = F.col("actual_name").eqNullSafe(F.col("expected_name")) & F.col("actual_type").eqNullSafe(F.col("expected_type"))
    return both.where(~same)


def missing_reference(df: DataFrame, checks: Sequence[tuple[str, Column]], out: str = "message") -> DataFrame:
    """I-07: rows with at least one finding; the first finding in list order is the message."""
    message: Column | None = None
    for text, cond in checks:
        message = F.when(cond, text) if message is None else message.when(cond, text)
    assert message is not None
    return df.withColumn(out, message).where(F.col(out).isNotNull())


def completeness(df: DataFrame, keys: Sequence[str], day: str, aggs: Mapping[str, Column]) -> DataFrame:
    """I-09: counts per key and day plus the gap to the key's previous day."""
    per_day = df.groupBy(*keys, day).agg(*[v.alias(n) for n, v in aggs.items()])
    return W.lag_gap(per_day, keys, day, "previous_day", "gap_days")


def load_reconciliation(
    loads: Mapping[str, DataFrame], spine: DataFrame, day: str = "file_date", name: str = "file_name"
) -> DataFrame:
    """I-10: every table crossed with every day of the spine, files and rows found or zero.

    ``loads`` maps a table name to its frame; the list is the catalog's, so the union has as
    many branches as tables.  Each branch reads two columns and aggregates before the union.
    """
    parts = None
    for table, df in loads.items():
        part = df.groupBy(day, name).agg(F.count("*").alias("rows")).select(F.lit(table).alias("table_name"), day, name, "rows")
        parts = part if parts is None else parts.unionByName(part)
    assert parts is not None
    every = spine.select(F.col(day), F.explode(F.array(*[F.lit(t) for t in loads])).alias("table_name"))
    found = every.join(parts, ["table_name", day], "left")
    return found.groupBy("table_name", day).agg(
        F.count(name).alias("files"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")
    )


def catalog_scan(spark: SparkSession, databases: Sequence[str]) -> DataFrame:
    """A-16: columns of all tables of some databases, views left out: database, table_name, ordinal_position, column_name, data_type."""
    found = []
    for database in databases:
        for table in sorted(spark.catalog.listTables(database), key=lambda t: t.name):
            if table.isTemporary or table.tableType == "VIEW":
                continue
            for i, c in enumerate(spark.catalog.listColumns(f"`{database}`.`{table.name}`"), 1):
                found.append((database, table.name, i, c.name, c.dataType))
    return local_table(spark, "database string, table_name string, ordinal_position int, column_name string, data_type string", found)


def catalog_reconciliation(spark: SparkSession, databases: Sequence[str], run_date: dt.date, days: int = 7, load_time: str = "load_time") -> DataFrame:
    """I-10: files and rows of every table of the catalog on each of the last ``days`` days before the run.

    One plan: tables with ``file_date`` are counted by date, file and load time, those that know only
    ``load_dttm`` by its date, under a blank file name; each reads these columns of the last days and
    aggregates before the union.  Every table meets every day; one without a file has no name and 0 rows.
    Tables with neither column are left out, as views are.
    """
    columns: dict[tuple[str, str], set[str]] = {}
    for r in catalog_scan(spark, databases).collect():
        columns.setdefault((r["database"], r["table_name"]), set()).add(r["column_name"])
    first, last = run_date - dt.timedelta(days=days), run_date - dt.timedelta(days=1)
    parts, tables = None, []
    for (database, table), have in sorted(columns.items()):
        rows = spark.table(f"`{database}`.`{table}`")
        if "file_date" in have:
            on, name, loaded = F.col("file_date").cast("date"), F.col("file_name") if "file_name" in have else F.lit(" "), F.col(load_time) if load_time in have else F.lit(None)
        elif "load_dttm" in have:
            on, name, loaded = F.col("load_dttm").cast("date"), F.lit(" "), F.lit(None)
            # the bound on the column itself reaches the scan
            rows = rows.where((F.col("load_dttm") >= D.at(dt.datetime.combine(first, dt.time()))) & (F.col("load_dttm") < D.at(dt.datetime.combine(run_date, dt.time()))))
        else:
            continue
        tables.append((database, table))
        kept = rows.select(on.alias("file_date"), name.cast("string").alias("file_name"), loaded.cast("timestamp_ntz").alias("load_time")).where(F.col("file_date").between(F.lit(first), F.lit(last)))
        counted = kept.groupBy("file_date", "file_name", "load_time").agg(F.count("*").alias("rows"))
        part = counted.select(F.lit(database).alias("database"), F.lit(table).alias("table_name"), "file_date", "file_name", "load_time", "rows")
        parts = part if parts is None else parts.unionByName(part)
    every = local_table(spark, "database string, table_name string", tables).withColumn("file_date", F.explode(F.sequence(F.lit(first), F.lit(last))))
    if parts is None:
        return every.select("*", F.lit(None).cast("string").alias("file_name"), F.lit(None).cast("timestamp_ntz").alias("load_time"), F.lit(0).cast("long").alias("rows"))
    return every.join(parts, ["database", "table_name", "file_date"], "left").withColumn("rows", F.coalesce("rows", F.lit(0)))


def alert_level(metric: Column, baseline: Column, low: Column, high: Column) -> Column:
    """I-24: how far a month lies above its baseline."""
    share = F.when(baseline != 0, metric.cast("double") / baseline.cast("double"))
    return F.when(share >= high, "high").when(share >= low, "low").otherwise("none")

