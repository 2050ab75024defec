"""Aggregation operators (D-01..D-21, G-08, G-09)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import dates as D


def net(kind: Column, plus: Sequence[str], minus: Sequence[str], value: Column | int = 1, when: Column | None = None) -> Column:
    """D-07: sum over the plus kinds less sum over the minus kinds, in one aggregate."""
    v = F.lit(value) if isinstance(value, int) else value
    sign = F.when(kind.isin(*plus), v).when(kind.isin(*minus), -v).otherwise(F.lit(0))
    return F.sum(sign if when is None else F.when(when, sign).otherwise(F.lit(0)))


def sum_if(cond: Column, value: Column | int = 1) -> Column:
    """D-06."""
    return F.sum(F.when(cond, F.lit(value) if isinstance(value, int) else value).otherwise(F.lit(0)))


def levels(
    df: DataFrame,
    keys: Sequence[str],
    sets: Sequence[Sequence[str]],
    sums: Mapping[str, Column],
    label: str = "All",
    grouped: bool = False,
) -> DataFrame:
    """D-19: the same sums at several grains, rolled-up keys shown as ``label``.

    The facts are summed once at the finest grain and only that small result is expanded to
    the grouping sets.  ``grouping`` tells a rolled-up key from a real null.  A key that is in
    every set keeps its type, the others become text.  ``grouped``: ``df`` has one row for each
    combination of keys already, with columns named as the sums.
    """
    fine = df.select(*keys, *sums) if grouped else df.groupBy(*keys).agg(*[v.alias(n) for n, v in sums.items()])
    out = fine.groupingSets([[F.col(k) for k in s] for s in sets], *keys).agg(
        *[F.sum(n).alias(n) for n in sums], *[F.grouping(k).alias(f"__g_{k}") for k in keys]
    )
    kept = {k for k in keys if all(k in s for s in sets)}
    shown = [F.col(k) if k in kept else F.when(F.col(f"__g_{k}") == 1, label).otherwise(F.col(k).cast("string")).alias(k) for k in keys]
    return out.select(*shown, *sums)


# D-20: name of a timeframe to the start of the period a day falls in
FRAMES = {
    "Day": lambda d: d,
    "Week": D.monday_week_start,
    "Month": D.month_start,
    "Year": lambda d: F.trunc(d, "year"),
}


#: frames that a fiscal calendar gives, and its columns for them
FISCAL = {"Week": "fw_start_date", "Period": "fp_start_date", "Year": "fy_start_date"}


def timeframes(
    df: DataFrame,
    day: str,
    dims: Sequence[str],
    sums: Mapping[str, Column],
    frames: Sequence[str] = ("Day", "Week", "Month", "Year"),
    calendar: DataFrame | None = None,
    by: str | None = None,
    parts: int | None = None,
    more: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """D-20: daily, weekly, monthly and yearly sums in one table.

    Sums per day first; the frames multiply day rows, not transactions.  With a fiscal ``calendar``
    (one row a day, see ``sources.tables.fiscal_calendar``) weeks and years are the fiscal ones and
    "Period" is a frame; days outside the calendar have null periods.

    ``by``, one of ``dims`` with many values, sends the day rows to its values' partitions, where they
    are multiplied and summed: frames, and later steps whose keys hold it, move no rows again.  With
    ``parts``, their number, which is to follow the rows', no task holds more groups when rows get more.

    ``more`` adds dimensions that follow from those of ``dims`` the rows have, such as a store's attributes:
    to the day rows, where they are multiplied, so the rows themselves need no join and a value with many
    rows no large task.
    """
    if by is not None and parts is not None:
        df = df.repartition(parts, by, day)
    daily = df.groupBy(*[d for d in dims if more is None or d in df.columns], day).agg(*[v.alias(n) for n, v in sums.items()])
    if by is not None:
        daily = daily.repartition(by) if parts is None else daily.repartition(parts, by)
    if more is not None:
        daily = more(daily)
    starts = {f: FRAMES[f](F.col(day)) for f in frames if f in FRAMES}
    if calendar is not None:
        starts |= {f: F.col(c) for f, c in FISCAL.items() if f in frames}
        days = calendar.select(F.col("calendar_date").alias(day), *dict.fromkeys(FISCAL.values()))
        daily = daily.join(days, day, "left")
    entry = F.array(*[F.struct(F.lit(f).alias("timeframe"), starts[f].alias("period_start")) for f in frames])
    daily = daily.select(*dims, day, *sums, entry.alias("__e"))
    entry = F.col("__e")
    spread = daily.withColumn("__f", F.explode(entry)).select("*", "__f.*").drop("__f", "__e", day)
    return spread.groupBy("timeframe", "period_start", *dims).agg(*[F.sum(n).alias(n) for n in sums])


def edge_period(df: DataFrame, period: str, label: str, out: str, text: Column | None = None) -> DataFrame:
    """D-21: the newest period shown as 'month to date' and the like.  The edge is a scalar."""
    newest = df.agg(F.max(period)).scalar()
    shown = text if text is not None else F.col(period).cast("string")
    return df.withColumn(out, F.when(F.col(period) == newest, label).otherwise(shown))


def two_level_high_water(df: DataFrame, source: str, key: str, ts: str, out: str) -> DataFrame:
    """D-17: newest time per source, then the least of them: all sources are complete up to it."""
    per_source = df.groupBy(source, key).agg(F.max(ts).alias("__m"))
    return per_source.groupBy(key).agg(F.min("__m").alias(out))


def distinct_then_sum(
    df: DataFrame, fine: Sequence[str], coarse: Sequence[str], group: str, ident: str, labels: Mapping[str, str]
) -> DataFrame:
    """D-08: distinct ids per fine group and label, then added up.  Not a global distinct."""
    step = df.groupBy(*fine, group).agg(F.countDistinct(ident).alias("__n"), F.count("*").alias("__rows"))
    sums = [sum_if(F.col(group) == g, F.col("__n")).alias(n) for g, n in labels.items()]
    return step.groupBy(*coarse).agg(*sums, F.sum("__rows").alias("rows"))


def lenses(df: DataFrame, keep: Sequence[str], lens: str, value: str, columns: Mapping[str, Column]) -> DataFrame:
    """G-08: one row per lens from one scan."""
    entry = F.array(*[F.struct(F.lit(n).alias(lens), c.alias(value)) for n, c in columns.items()])
    return df.withColumn("__l", F.explode(entry)).select(*keep, f"__l.{lens}", f"__l.{value}")


def ledger_lines(df: DataFrame, keep: Sequence[str], lines: Sequence[Mapping[str, Column]]) -> DataFrame:
    """G-09: several ledger lines (activation, discount) per aggregated row."""
    entry = F.array(*[F.struct(*[c.alias(n) for n, c in line.items()]) for line in lines])
    return df.withColumn("__l", F.explode(entry)).select(*keep, "__l.*")


def joined_set(df: DataFrame, keys: Sequence[str], item: str, out: str, sep: str = ",") -> DataFrame:
    """D-13, D-14: distinct items of a low-cardinality column as one ordered text.

    Distinct (key, item) pairs are formed by a distributed aggregate first, so what is
    gathered per key is bounded by the column's domain.  Bodies of files are not built this
    way: they are written as ordered rows.
    """
    pairs = df.select(*keys, item).where(F.col(item).isNotNull()).distinct()
    return pairs.groupBy(*keys).agg(
        F.array_join(F.sort_array(F.collect_set(item)), sep).alias(out), F.count("*").alias(f"{out}_size")
    )
