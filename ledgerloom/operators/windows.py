"""Window operators (F-01..F-16, E-12, E-14) laid out so that no key can overload a task.

* Top-1 filters on ``row_number`` let Spark cut each group before the shuffle.
* Anything that must keep every row of a possibly huge group is done on two levels: inside
  (key, bucket) and over the bucket totals, where the bucket follows the order column.
* Rolling windows run on month aggregates, so a group has at most one row per month.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import dates as D


def keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """F-01, F-04, F-05, G-04: first row per key.  Give a total order; the rank filter is
    applied on the map side first, so a hot key ships one row per task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")


def without_repeats(df: DataFrame, keys: Sequence[str], among: DataFrame) -> DataFrame:
    """F-02: rows of ``df`` whose key occurs at most once in ``among``.

    The keys that repeat are found by a count over the key columns alone, whatever the rows'
    width, and removed by a null-safe anti join.  Repeats are few as a rule, so the join is a
    broadcast; when they are many it is an ordinary shuffled join that AQE may split.
    """
    repeated = among.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > 1)
    repeated = repeated.select(*[F.col(k).alias(f"__d{i}") for i, k in enumerate(keys)])
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__d{i}"))
    return df.join(repeated, same, "left_anti")


def reject_all_copies(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """F-02: only rows whose key is unique."""
    return without_repeats(df, keys, df)


def latest_with_ties(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """E-12, F-06: all rows at the newest time of their key.

    Maximum per key, then an equality join: partial aggregation handles a hot key and the
    join can be split on skew, which a rank window cannot.
    """
    newest = df.groupBy(*keys).agg(F.max(ts).alias(ts))
    return df.join(newest, [*keys, ts], "left_semi")


def rolling_previous(
    df: DataFrame,
    keys: Sequence[str],
    month: str,
    measures: Mapping[str, tuple[Column, Column]],
    baseline_from: object | None = None,
    months: int = 3,
    empty: float | None = None,
    null_keys_match: bool = False,
) -> DataFrame:
    """F-08, F-09, F-10, E-10: quotient of sums over the previous calendar months.

    ``measures`` maps an output name to (numerator, denominator) columns of the month table.
    Missing months are gaps because the frame ranges over the month number, not over rows.
    One window serves all measures.  As in a self join, a row with a null key has no history
    unless ``null_keys_match`` is set.
    """
    w = Window.partitionBy(*keys).orderBy(D.month_index(F.col(month))).rangeBetween(-months, -1)
    matched = F.lit(True)
    if not null_keys_match:
        for k in keys:
            matched = matched & F.col(k).isNotNull()
    out = {}
    for name, (num, den) in measures.items():
        total = F.sum(num).over(w).cast("double")
        weight = F.sum(den).over(w).cast("double")
        value = F.when(matched & (weight != 0), total / weight)
        if empty is not None:
            value = F.coalesce(value, F.lit(float(empty)))
        if baseline_from is not None:
            value = F.when(F.col(month) >= F.lit(baseline_from), value)
        out[name] = value
    return df.withColumns(out)


def nonzero(value: Column, weight: Column | int = 1) -> Column:
    """F-08 divisor: the weight of months whose value is there and not zero."""
    w = F.lit(weight) if isinstance(weight, int) else weight
    return F.when(F.coalesce(value, F.lit(0)) != 0, w).otherwise(0)


def rolling_nonzero(value: Column, weight: Column | int = 1) -> tuple[Column, Column]:
    """F-08 (weight 1) and F-09 (weight = days in month) measure pair."""
    return F.coalesce(value, F.lit(0)), nonzero(value, weight)


def prior_period(
    df: DataFrame, keys: Sequence[str], index: Column, values: Mapping[str, Column], back: int
) -> DataFrame:
    """E-11: values of exactly ``back`` periods earlier on a table with one row per period.

    A one-period range frame replaces the self join and does not mistake a gap for the
    previous period.
    """
    w = Window.partitionBy(*keys).orderBy(index).rangeBetween(-back, -back)
    return df.select("*", *[F.max(v).over(w).alias(n) for n, v in values.items()])


def month_presence(df: DataFrame, keys: Sequence[str], month: str, out: str, months: int = 2) -> DataFrame:
    """F-15: whether the key was active in the previous months (one row per key and month)."""
    w = Window.partitionBy(*keys).orderBy(D.month_index(F.col(month))).rangeBetween(-months, -1)
    return df.withColumn(out, F.count("*").over(w) > 0)


def lag_gap(df: DataFrame, keys: Sequence[str], day: str, previous: str, gap: str) -> DataFrame:
    """F-07: previous day of the key and whole days between, on one row per key and day."""
    w = Window.partitionBy(*keys).orderBy(day)
    return df.withColumn(previous, F.lag(day).over(w)).withColumn(gap, F.datediff(F.col(day), F.col(previous)) - 1)


def active_periods_before(df: DataFrame, key: str, month: str, out: str, at_least: int = 1) -> DataFrame:
    """E-14, F-16: per calendar month and key, how many distinct months were active earlier.

    The k-th active month of a key fixes the count for the calendar months after it up to
    and including the next active month, so each step only expands to that stretch; no
    month is paired with the whole history.
    """
    active = df.select(key, F.trunc(month, "month").alias("__a")).distinct()
    calendar = active.select(F.col("__a").alias(month)).distinct()
    last = calendar.agg(F.max(month)).scalar()
    w = Window.partitionBy(key).orderBy("__a")
    steps = active.select(
        key,
        F.row_number().over(w).alias(out),
        F.add_months("__a", 1).alias("__from"),
        F.lead("__a").over(w).alias("__next"),
    ).where(F.col(out) >= at_least)
    steps = steps.withColumn("__to", F.coalesce("__next", last)).where(F.col("__from") <= F.col("__to"))
    months = F.sequence("__from", "__to", F.expr("interval 1 month"))
    spread = steps.select(key, F.col(out).cast("long").alias(out), F.explode(months).alias(month))
    return spread.join(calendar, month, "left_semi").select(month, key, out)


def period_rank(df: DataFrame, period: str, out: str) -> DataFrame:
    """F-13: rank of the distinct periods, newest first.  The window sees distinct periods only
    (a calendar's worth of rows); the fact joins the result."""
    periods = df.select(period).where(F.col(period).isNotNull()).distinct()
    ranked = periods.withColumn(out, F.dense_rank().over(Window.partitionBy(F.lit(0)).orderBy(F.col(period).desc())))
    return df.join(ranked, period, "left")


def running_sum(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    value: Column,
    bucket: Column | Sequence[Column],
    out: str,
    source: DataFrame | None = None,
    source_value: Column | None = None,
) -> DataFrame:
    """F-11: running total in a given order, exact for groups of any size.

    ``bucket`` must never decrease along the order (a day of the time column, a range of the
    leading key).  Level one adds up inside (keys, bucket); level two adds the totals of
    earlier buckets, a table with one row per key and bucket.  A list of buckets, fine to
    coarse, adds levels: a total over the whole table (no keys) takes a coarse bucket with a
    bounded number of values last, so that its top level is small whatever the table's size.

    The bucket totals are taken from ``source`` (default: ``df`` itself).  When several running
    columns are stacked, pass the common input here, or the earlier steps run once more for
    every step on top of them.  It must hold every (keys, bucket) of ``df``.
    """
    buckets = [bucket] if isinstance(bucket, Column) else list(bucket)
    fine, coarser = buckets[0], buckets[1:]

    def placed(rows: DataFrame, v: Column) -> DataFrame:
        rows = rows.withColumn("__g", F.struct(F.lit(0), *[F.col(k) for k in keys]))
        place = F.struct(F.col("__g"), fine.alias("b"), *[c.alias(f"c{i}") for i, c in enumerate(coarser)])
        return rows.withColumn("__kb", place).withColumn("__v", v)

    base = placed(df, value)
    local = Window.partitionBy("__kb").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    counted = base if source is None else placed(source, value if source_value is None else source_value)
    totals = counted.groupBy("__kb").agg(F.sum("__v").alias("__t"))
    if coarser:
        upper = totals.select(F.col("__kb").alias("__id"), F.col("__kb.__g").alias("__h"), "__t")
        rest = [F.col(f"__id.c{i}") for i in range(len(coarser))]
        upper = running_sum(upper, ["__h"], [F.col("__id.b")], F.col("__t"), rest, "__upto")
        offsets = upper.select(F.col("__id").alias("__kb"), (F.col("__upto") - F.col("__t")).alias("__off"))
    else:
        earlier = Window.partitionBy("__kb.__g").orderBy("__kb.b").rowsBetween(Window.unboundedPreceding, -1)
        offsets = totals.select("__kb", F.coalesce(F.sum("__t").over(earlier), F.lit(0)).alias("__off"))
    inside = base.withColumn("__in", F.sum("__v").over(local))
    return (
        inside.join(offsets, "__kb")
        .withColumn(out, F.col("__in") + F.col("__off"))
        .drop("__kb", "__g", "__v", "__in", "__off")
    )


def running_sum_by_range(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], value: Column, out: str, folder: str, parts: int | None = None
) -> DataFrame:
    """F-11, F-12: running total in a given order, exact and spread evenly whatever share of the rows a key,
    or one key on one day, holds.

    Rows are dealt to ``parts`` ranges of (keys, order), cut where the data lies, and written to
    ``folder`` with their range, so every later step sees the same ranges.  A range adds up by
    itself; the totals before it are one row for each key and range, of which a key has at most
    ``parts``.  Only rows that are equal in keys and order stay together; they count in any order.
    """
    spark = df.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = df.withColumn("__g", F.struct(F.lit(0), *[F.col(k) for k in keys])).withColumn("__v", value)
    dealt = given.repartitionByRange(n, *[F.col(k) for k in keys], *order).withColumn("__part", F.spark_partition_id())
    dealt.write.parquet(folder)
    rows = spark.read.schema(dealt.schema).parquet(folder)
    totals = rows.groupBy("__g", "__part").agg(F.sum("__v").alias("__t"))
    earlier = Window.partitionBy("__g").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("__g", "__part", F.coalesce(F.sum("__t").over(earlier), F.lit(0)).alias("__off"))
    inside = Window.partitionBy("__g", "__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("__in", F.sum("__v").over(inside)).join(before, ["__g", "__part"])
    return placed.withColumn(out, F.col("__in") + F.col("__off")).select(*df.columns, out)


def range_bucket(df: DataFrame, c: str, parts: int = 1000) -> Column:
    """Order-preserving bucket of a numeric column with at most ``parts`` + 2 values.

    Equal widths between the column's least and greatest value, both scalar subqueries.
    """
    low, high = df.agg(F.min(c)).scalar(), df.agg(F.max(c)).scalar()
    return F.coalesce(F.width_bucket(F.col(c).cast("double"), low.cast("double"), high.cast("double"), F.lit(parts)), F.lit(0))


def sequence_in_group(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], bucket: Column | Sequence[Column], out: str, source: DataFrame | None = None
) -> DataFrame:
    """F-03, F-12, F-14: row number per key that keeps every row, exact for groups of any size.

    ``source`` as in ``running_sum``: the input that a stack of sequences has in common.
    """
    return running_sum(df, keys, order, F.lit(1).cast("long"), bucket, out, source)


def flag_duplicates(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], bucket: Column, message: str, out: str
) -> DataFrame:
    """F-03: every row kept, copies after the first carry a message."""
    seq = sequence_in_group(df, keys, order, bucket, "__seq")
    return seq.withColumn(out, F.when(F.col("__seq") > 1, message)).drop("__seq")


def suffix_ids(df: DataFrame, key: str, order: Sequence[Column], bucket: Column, mark: str, out: str) -> DataFrame:
    """F-14: id plus mark plus running number."""
    seq = sequence_in_group(df, [key], order, bucket, "__seq")
    return seq.withColumn(out, F.concat(F.col(key).cast("string"), F.lit(mark), F.col("__seq").cast("string"))).drop("__seq")
