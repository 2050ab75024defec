"""Partner files (B-07..B-13, D-16): header / detail / trailer rows, fixed-width lines, exports."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions import dates as D

RANK = {"H": 0, "D": 1, "T": 2}


def trailer(detail: DataFrame, file_keys: Sequence[str], amount: Column | None, count: str = "detail_count", total: str = "detail_total") -> DataFrame:
    """D-16: counts and sums detail rows only, so no header needs to be subtracted."""
    aggs = [F.count("*").alias(count)]
    if amount is not None:
        aggs.append(F.sum(amount).alias(total))
    return detail.groupBy(*file_keys).agg(*aggs)


def file_lines(header: DataFrame, detail: DataFrame, tail: DataFrame) -> DataFrame:
    """B-09: one table of H, D and T rows, columns aligned by name.

    The row order is carried as data (``line_rank`` and the sort columns); sorting happens on
    write, range-partitioned, so a big file spreads over many tasks.
    """
    parts = []
    for kind, df in (("H", header), ("D", detail), ("T", tail)):
        own = df if "record_type" in df.columns else df.withColumn("record_type", F.lit(kind))
        parts.append(own.withColumn("line_rank", F.lit(RANK[kind])))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


@dataclass(frozen=True)
class Slot:
    """One field of a fixed-width line.

    A value longer than its field ends the job, so no amount loses a digit; only fields declared
    ``cut`` (names, titles) are shortened.
    """

    value: Column
    width: int
    right: bool = False
    fill: str = " "
    cut: bool = False

    def text(self) -> Column:
        c = F.coalesce(self.value.cast("string"), F.lit(""))
        padded = F.lpad(c, self.width, self.fill) if self.right else F.rpad(c, self.width, self.fill)
        if self.cut:
            return padded
        long = F.raise_error(F.concat(F.lit(f"a value is longer than its field of {self.width} characters: "), c))
        return F.when(F.length(c) <= self.width, padded).otherwise(long.cast("string"))


def fixed_width_line(slots: Sequence[Slot]) -> Column:
    """B-10: padded fields joined to one line."""
    return F.concat(*[s.text() for s in slots])


def write_lines(lines: DataFrame, path: str, file_key: str, order: Sequence[str], line: str = "line", eol: str = "\r\n") -> None:
    """B-10: ordered text files, one folder per file key.

    Range partitioning by (file, rank, order) splits even a dominant file; part names follow
    the order, so the parts of a folder concatenate to the file.
    """
    cols = [file_key, *order]
    ordered = lines.repartitionByRange(*[F.col(c) for c in cols]).sortWithinPartitions(*cols)
    ordered.select(file_key, F.col(line).alias("value")).write.mode("overwrite").partitionBy(file_key).option("lineSep", eol).text(path)


def export_delimited(df: DataFrame, path: str, sep: str = ",", header: bool = True, extension: str | None = None, single_file: bool = False) -> None:
    """B-07: delimited export.  ``single_file`` is for aggregated outputs; it costs one task."""
    out = df.coalesce(1) if single_file else df
    writer = out.write.mode("overwrite").option("sep", sep).option("header", header).option("emptyValue", "")
    if extension:
        writer = writer.option("extension", extension)
    writer.csv(path)


def write_marker(spark: SparkSession, path: str, name: str) -> None:
    """B-08: blank marker file next to a finished export."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path, name)
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.create(target, True).close()


def for_export(df: DataFrame, drop: Sequence[str], order: Sequence[str]) -> DataFrame:
    """B-12, C-02: helper columns used for the order, then dropped."""
    return df.orderBy(*order).drop(*drop)


def entity_sequence(df: DataFrame, entity: str, out: str = "entity_seq") -> DataFrame:
    """J-19: 0-based position of each distinct entity in sorted order.

    The entities are companies or file prefixes; the distinct set is ranked, not the facts.
    """
    names = df.select(F.trim(entity).alias(entity)).where(F.trim(entity) != "").distinct()
    packed = names.agg(F.sort_array(F.collect_set(entity)).alias("__all"))
    return packed.select(F.posexplode("__all").alias(out, entity)).select(entity, out)


def stamped_name(prefix: str, run_ts: dt.datetime, seq: Column) -> Column:
    """J-19: file time is the batch end plus the entity's index in seconds."""
    ts = D.at(run_ts) + F.make_dt_interval(secs=seq.cast("decimal(18,6)"))
    return F.concat(F.lit(prefix + "_"), F.date_format(ts, "yyyyMMddHHmmss"))


def export_settings(**tokens: str) -> Mapping[str, str]:
    """C-21: named parameters of an export."""
    return dict(tokens)
