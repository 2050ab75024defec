"""Folder for text the source and sink queries write and read back.

It lies under the shared folder named by ``spark.checkpoint.dir`` or set on the session; without
one there is no folder that all executors share, so nothing is written.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.session import ensure_checkpoint_dir


def new_folder(spark: SparkSession, what: str) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)
    return f"{shared.rstrip('/')}/{what}-{uuid.uuid4().hex}"


@contextmanager
def scratch_database(spark: SparkSession) -> Iterator[str]:
    """A database below the shared folder, dropped at the end with the tables it holds."""
    home = new_folder(spark, "catalog")
    database = "scratch_" + home.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{home}'")
    try:
        yield database
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def kept(df: DataFrame) -> DataFrame:
    """The rows of ``df``, written so that they outlive the tables they come from."""
    path = new_folder(df.sparkSession, "kept")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
