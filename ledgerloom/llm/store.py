"""Intermediate tables in the folder all executors share.

A written table cuts the lineage and outlives any executor.  The folder is the one named in
``spark.checkpoint.dir``, or set on the session; without one nothing is written.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager
from contextvars import ContextVar

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.session import ensure_checkpoint_dir

_MADE: ContextVar[list[str] | None] = ContextVar("made", default=None)


def shared_folder(spark: SparkSession) -> str:
    """Fails where the cluster names no folder: a machine-local one would lose tables with its machine."""
    return (spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)).rstrip("/")


def new_path(spark: SparkSession, what: str) -> str:
    return f"{shared_folder(spark)}/{what}-{uuid.uuid4().hex}"


@contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """The session's setting ``name`` is ``value`` inside."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def shuffles_freed(spark: SparkSession) -> AbstractContextManager[None]:
    """Each query run inside deletes its shuffle files when it ends, not when the driver next collects its garbage."""
    return setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def written(df: DataFrame, what: str, **options: str) -> tuple[DataFrame, str]:
    """The rows of ``df`` as a table of the shared folder, and its path; ``options`` are the writer's."""
    spark = df.sparkSession
    path = new_path(spark, what)
    made = _MADE.get()
    if made is not None:
        made.append(path)
    with shuffles_freed(spark):
        df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[str], None]]:
    """Tables written inside are deleted at the end, but for those kept by calling what this yields with their paths.

    Kept ones belong to the scratch around this one, if there is one.
    """
    outer, made, kept = _MADE.get(), [], []
    token = _MADE.set(made)
    try:
        yield kept.append
    except BaseException:
        kept.clear()
        raise
    finally:
        _MADE.reset(token)
        for path in made:
            if path not in kept:
                dropped(spark, path)
        if outer is not None:
            outer.extend(p for p in made if p in kept)


#: type of a row's id
ROW = "struct<file:long,place:long>"


def fresh_id() -> Column:
    """An id of each row that holds within one job."""
    return F.struct(F.lit(0).cast("long").alias("file"), F.monotonically_increasing_id().alias("place"))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores more as make it no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def _one_file_scan(df: DataFrame) -> bool:
    """Is ``df`` a read of files with nothing but column choices and filters on top?"""
    node = df._jdf.queryExecution().analyzed()
    while node.nodeName() in ("Project", "Filter", "SubqueryAlias"):
        node = node.children().head()
    return node.children().isEmpty() and "_metadata" not in df.columns


def numbered(df: DataFrame, what: str) -> tuple[DataFrame, str]:
    """The rows of ``df`` with an id each that is the same in every job, and the id's column.

    Rows read straight from files are known by file and place in it.  Other rows are written to
    the shared folder with an id: ids made while reading follow the splits of that job.
    """
    name = free_name(df, "__row")
    if _one_file_scan(df):
        try:
            return df.withColumn(name, F.struct(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"))), name
        except AnalysisException:  # files whose reader doesn't count rows
            pass
    return written(df.withColumn(name, fresh_id()), what)[0], name


def dropped(spark: SparkSession, path: str) -> None:
    """Delete a table that ``written`` made and nothing reads any more."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
