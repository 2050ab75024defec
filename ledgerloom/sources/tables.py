"""Table sources: Parquet, spines, literal rows, catalog (A-07, A-16..A-19)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import dates as D


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A-07: explicit schema, so no footer is opened for inference."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def local_table(spark: SparkSession, ddl: str, rows: Sequence[tuple]) -> DataFrame:
    """A-19: literal rows as a local relation, so that Spark knows how small it is."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = T._parse_datatype_string(ddl)
    assert isinstance(schema, T.StructType)
    arrow = to_arrow_schema(schema)
    columns = [pa.array([r[i] for r in rows], type=arrow.field(i).type) for i in range(len(schema.fields))]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema=schema)


def date_spine(spark: SparkSession, start: dt.date, end: dt.date, out: str = "day", step: str = "1 day") -> DataFrame:
    """A-18: one row per step; the dates are generated inside Spark."""
    days = F.sequence(F.lit(start), F.lit(end), F.expr(f"interval {step}"))
    return spark.range(1).select(F.explode(days).alias(out))


def fiscal_calendar(days: DataFrame, day: str = "day") -> DataFrame:
    """One row a day: its fiscal week, period and year with their first and last days."""
    start = D.fiscal_year_start(F.col(day))
    rows = days.select(F.col(day).alias("calendar_date"), start.alias("fy_start_date"), D.fiscal_week(F.col(day)).alias("wofy"))
    rows = rows.withColumn("pofy", D.fiscal_period(F.col("wofy")))
    next_year = D.fiscal_year_start(F.date_add("fy_start_date", 380))
    following = F.when(F.col("pofy") == 12, next_year).otherwise(D.fiscal_period_start(F.col("fy_start_date"), F.col("pofy") + 1))
    return rows.select(
        "calendar_date",
        F.date_add("fy_start_date", (F.col("wofy") - 1) * 7).alias("fw_start_date"),
        F.date_add("fy_start_date", F.col("wofy") * 7 - 1).alias("fw_end_date"),
        "wofy",
        D.fiscal_period_start(F.col("fy_start_date"), F.col("pofy")).alias("fp_start_date"),
        F.date_sub(following, 1).alias("fp_end_date"),
        "pofy",
        F.concat(F.lit("F"), F.year(F.date_add("fy_start_date", 300)).cast("string")).alias("fy"),
        "fy_start_date",
    )


def catalog_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """A-16: tables of a schema as rows."""
    rows = [(t.name, t.tableType, bool(t.isTemporary)) for t in spark.catalog.listTables(database)]
    return local_table(spark, "table_name string, table_type string, is_temporary boolean", rows)


def catalog_columns(spark: SparkSession, tables: Sequence[str]) -> DataFrame:
    """A-16: columns of the given tables as rows."""
    rows = [
        (t, i + 1, f.name, f.dataType.simpleString())
        for t in tables
        for i, f in enumerate(spark.table(t).schema.fields)
    ]
    return local_table(spark, "table_name string, ordinal_position int, column_name string, data_type string", rows)
