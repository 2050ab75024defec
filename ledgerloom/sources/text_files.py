"""Text sources (A-01..A-06, A-08, A-09): fixed-width, multi-part, delimited, headed files.

Everything reads a whole batch of files in one scan and carries the file name as a column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    """Half-open character range [start, end) of a line."""

    name: str
    start: int
    end: int
    strip: bool = False

    def column(self, line: Column) -> Column:
        part = F.substring(line, self.start + 1, self.end - self.start)
        return (F.trim(part) if self.strip else part).alias(self.name)


def read_lines(spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """A-09: one row per line with its file's base name.

    The text reader is UTF-8; other encodings go through the CSV reader with a separator that
    no line contains, which keeps the scan splittable.
    """
    if encoding.upper() in ("UTF-8", "UTF8"):
        lines = spark.read.text(path)
    else:
        lines = (
            spark.read.schema("value string")
            .option("sep", "\u0001").option("quote", "").option("encoding", encoding)
            .csv(path)
        )
    return lines.select("value", F.col("_metadata.file_name").alias("file_name"))


def slice_fields(lines: DataFrame, fields: Sequence[Field], keep: Sequence[str] = ("file_name",)) -> DataFrame:
    """A-01: fields of each line."""
    return lines.select(*keep, *[f.column(F.col("value")) for f in fields])


def read_fixed_width(
    spark: SparkSession, path: str, fields: Sequence[Field], record_type: str | None = None, at: int = 0
) -> DataFrame:
    """A-01: only lines whose type code stands at ``at``."""
    lines = read_lines(spark, path)
    if record_type is not None:
        lines = lines.where(F.substring("value", at + 1, len(record_type)) == record_type)
    return slice_fields(lines, fields)


def assemble_multipart(
    lines: DataFrame, parts: Mapping[str, Sequence[Field]], counter: Field, part: Field, on_duplicate: str = "join"
) -> DataFrame:
    """A-02: a record spread over several lines that share file and counter.

    ``fail``: one aggregate over (file, counter), which stops on a repeated part.  ``join``:
    an inner join per part, pairing repeats as a relational join does; only complete records
    survive either way.
    """
    keyed = lines.select(
        "file_name", counter.column(F.col("value")), part.column(F.col("value")).alias("__part"), "value"
    ).where(F.col("__part").isin(list(parts)))
    keys = ["file_name", counter.name]
    if on_duplicate == "join":
        out: DataFrame | None = None
        for code, fields in parts.items():
            side = keyed.where(F.col("__part") == code).select(*keys, *[f.column(F.col("value")) for f in fields])
            out = side if out is None else out.join(side, keys, "inner")
        assert out is not None
        return out
    aggs = []
    for code in parts:
        mine = F.col("__part") == code
        aggs += [F.max(F.when(mine, F.col("value"))).alias(f"__l{code}"), F.count_if(mine).alias(f"__n{code}")]
    one = keyed.groupBy(*keys).agg(*aggs)
    whole = F.lit(True)
    repeated = F.lit(False)
    for code in parts:
        whole = whole & (F.col(f"__n{code}") > 0)
        repeated = repeated | (F.col(f"__n{code}") > 1)
    guard = F.when(repeated, F.raise_error(F.concat(F.lit("repeated part for "), F.col(counter.name)))).otherwise(True)
    one = one.where(whole & guard)
    return one.select(*keys, *[f.column(F.col(f"__l{code}")) for code, fields in parts.items() for f in fields])


def drop_edge_lines(spark: SparkSession, path: str, head: int, tail: int) -> DataFrame:
    """A-03, A-04 by position: drop the first ``head`` and last ``tail`` lines of every file.

    A line's place is its split's start offset and its order inside the split.  Only the edge
    candidates of each split are ranked (a rank limit runs before the shuffle); the rest of
    the file streams through untouched.  A file with nothing between the edges gives no rows.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("__path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.struct(F.col("_metadata.file_block_start").alias("s"), F.monotonically_increasing_id().alias("i")).alias("__at"),
    )
    edges: DataFrame | None = None
    for n, order in ((head, F.col("__at").asc()), (tail, F.col("__at").desc())):
        if n:
            rank = F.row_number().over(Window.partitionBy("__path").orderBy(order))
            side = lines.select("__path", "__at").withColumn("__rn", rank).where(F.col("__rn") <= n)
            side = side.select("__path", "__at")
            edges = side if edges is None else edges.union(side)
    if edges is not None:
        lines = lines.join(edges.distinct(), ["__path", "__at"], "left_anti")
    return lines.select("value", "file_name")


def keep_records(lines: DataFrame, is_detail: Column) -> DataFrame:
    """A-03, A-04 by content (preferred): the record type names headers and trailers."""
    return lines.where(is_detail)


def split_columns(lines: DataFrame, names: Sequence[str], sep: str = ",", strip: bool = True) -> DataFrame:
    """A-03: delimited line to text columns."""
    parts = F.split("value", "\\Q" + sep + "\\E", -1)
    cols = [F.get(parts, F.lit(i)) for i in range(len(names))]
    return lines.select("file_name", *[(F.trim(c) if strip else c).alias(n) for c, n in zip(cols, names)])


def read_delimited_skip(
    spark: SparkSession, path: str, names: Sequence[str], head: int = 2, tail: int = 1, sep: str = ","
) -> DataFrame:
    """A-03: banner, header and footer removed by position, fields split and stripped."""
    return split_columns(drop_edge_lines(spark, path, head, tail), names, sep)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", header: bool = False, encoding: str = "UTF-8"
) -> DataFrame:
    """A-05: explicit schema, optional header row, file name carried along."""
    df = (
        spark.read.schema(schema).option("sep", sep).option("header", header).option("encoding", encoding).csv(path)
    )
    return df.select("*", F.col("_metadata.file_name").alias("file_name"))


def curate_csv(lines: DataFrame, schema: T.StructType, is_detail: Column, sep: str = ",", strip: bool = False) -> DataFrame:
    """A-06: header and trailer lines dropped by content, the rest parsed in place.

    Nothing is rewritten to an intermediate file.
    """
    row = F.from_csv(F.col("value"), F.lit(schema.simpleString()[7:-1].replace(":", " ")), {"sep": sep})
    parsed = lines.where(is_detail).select("file_name", row.alias("__r")).select("file_name", "__r.*")
    if strip:
        texts = {f.name for f in schema.fields if isinstance(f.dataType, T.StringType)}
        parsed = parsed.select(*[F.trim(c).alias(c) if c in texts else F.col(c) for c in parsed.columns])
    return parsed


def normal_names(df: DataFrame) -> DataFrame:
    """A-08: lower case, blanks to underscores."""
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def read_sheet(spark: SparkSession, path: str) -> DataFrame:
    """A-08: exported sheet, first row is the header, every column text."""
    return normal_names(spark.read.option("header", True).csv(path))
