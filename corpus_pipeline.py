"""A training-data pipeline over ``documents``: each stage is one operator of ``ledgerloom.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm import stages
from ledgerloom.llm.store import dropped, scratch, written

STAGES = stages.STAGES

#: SQL can't express the fitted severity model of the first stage; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result is written and read again as the next one's
    input, which is deleted when the next result stands."""
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        with scratch(spark) as keep:
            made, made_at = written(stage(spark, docs, sf_dir), f"stage-{name}")
            keep(made_at)
        if path:
            dropped(spark, path)
        docs, path = made, made_at
    return docs
