"""Registry of checked queries: name to Spark function and oracle text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.workload.feeds import Tables, oracle

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def portable(df: DataFrame) -> DataFrame:
    """Plain column types for a comparison across engines: decimals as doubles, dates and
    times as text, integers as 64 bit."""
    cols = []
    for f in df.schema.fields:
        kind = f.dataType
        c = F.col(f"`{f.name}`")
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType)):
            c = c.cast("string")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("long")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def query(name: str, sql: str | None = None) -> Callable:
    """Register a function of ``Tables``; ``sql`` may name feeds, they are put in front."""

    def add(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = lambda spark, path: portable(fn(Tables(spark, path)))
        if sql is not None:
            ORACLE[name] = oracle(sql)
        return fn

    return add
