"""Join operators (E-01..E-22).

No broadcast hints: Spark turns a side into a broadcast only when its measured size is
under ``autoBroadcastJoinThreshold`` and falls back to a sort-merge join with AQE skew
splitting otherwise.  One-row sides are scalar subqueries, never cross joins.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import text as X

FAR_DATE = "2999-12-31"


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, Column | str],
    take: Sequence[str] | Mapping[str, str],
    how: str = "left",
) -> DataFrame:
    """E-01, E-02, E-16..E-18: join a dimension on derived keys.

    ``on`` maps a dimension column to a fact expression; the expression is computed once as
    a key column so the join is a plain equality.  Only ``take`` survives from the dimension.
    """
    names = take if isinstance(take, Mapping) else {t: t for t in take}
    keyed = fact.withColumns({f"__k{i}": F.col(e) if isinstance(e, str) else e for i, e in enumerate(on.values())})
    right = dim.select(
        *[F.col(d).alias(f"__k{i}") for i, d in enumerate(on)], *[F.col(s).alias(t) for s, t in names.items()]
    )
    keys = [f"__k{i}" for i in range(len(on))]
    return keyed.join(right, keys, how).drop(*keys)


def unique_or_fail(dim: DataFrame, keys: Sequence[str], what: str = "lookup") -> DataFrame:
    """One row per key; a duplicated key stops the job instead of fanning the fact out."""
    rest = [c for c in dim.columns if c not in keys]
    one = dim.groupBy(*keys).agg(F.count("*").alias("__n"), F.any_value(F.struct(*rest)).alias("__r"))
    checked = F.when(
        F.col("__n") > 1,
        F.raise_error(F.concat_ws(" ", F.lit(f"duplicate key in {what}:"), *[F.col(k).cast("string") for k in keys])),
    ).otherwise(F.col("__r"))
    return one.withColumn("__r", checked).select(*keys, "__r.*")


def left_anti(df: DataFrame, seen: DataFrame, on: Sequence[str]) -> DataFrame:
    """E-05, E-07: rows without a match.  A null key never matches, so it counts as new."""
    return df.join(seen.select(*on), list(on), "left_anti")


def left_semi(df: DataFrame, wanted: DataFrame, on: Sequence[str]) -> DataFrame:
    """E-08, E-09."""
    return df.join(wanted.select(*on), list(on), "left_semi")


def not_in(df: DataFrame, values: DataFrame, key: str) -> DataFrame:
    """E-06: NOT IN with its null rules, without the nested-loop plan Spark picks for it.

    An empty list keeps every row; one null in the list keeps none; otherwise rows with a
    null key are dropped.  The two counts are scalar subqueries over the list.
    """
    total = values.agg(F.count("*")).scalar()
    nulls = values.agg(F.count_if(F.col(key).isNull())).scalar()
    unmatched = df.join(values.select(key).where(F.col(key).isNotNull()), key, "left_anti")
    return unmatched.where((total == 0) | ((nulls == 0) & F.col(key).isNotNull()))


def threshold(
    df: DataFrame,
    control: DataFrame,
    merchant: Column,
    rule_id: float,
    attribute: str,
    default_attribute: str | None = None,
    constant: float | None = None,
    scale: float = 0.01,
    out: str = "threshold",
    report_as: str | None = None,
) -> DataFrame:
    """E-20: the merchant's own limit, else the default row's, else a constant.

    The control table carries (rule_id, attribute, merchant, merchant_to_report, value).
    """
    rule = control.where((F.col("rule_id") == rule_id) & (F.trim("attribute") == attribute))
    own = unique_or_fail(
        rule.select(F.trim("merchant").alias("__m"), F.col("value").alias("__own"), F.col("merchant_to_report").alias("__to")),
        ["__m"],
        f"rule {rule_id} {attribute}",
    )
    joined = df.withColumn("__m", F.trim(merchant)).join(own, "__m", "left")
    options = [F.col("__own").cast("double")]
    if default_attribute:
        default = control.where(
            (F.col("rule_id") == rule_id) & (F.trim("attribute") == default_attribute) & (F.col("merchant") == "*")
        ).select(F.col("value").cast("double"))
        options.append(default.scalar())
    value = F.coalesce(*options) * scale
    if constant is not None:
        value = F.coalesce(value, F.lit(float(constant)))
    joined = joined.withColumn(out, value)
    if report_as:
        joined = joined.withColumn(report_as, X.blank_to_null(F.col("__to")))
    return joined.drop("__m", "__own", "__to")


def control_value(control: DataFrame, rule_id: float, attribute: str, scale: float = 1.0, merchant: str | None = None) -> Column:
    """E-19: one control value as a scalar; Spark fails the query if it is not unique."""
    rows = control.where((F.col("rule_id") == rule_id) & (F.trim("attribute") == attribute))
    if merchant is not None:
        rows = rows.where(F.col("merchant") == merchant)
    return rows.select(F.col("value").cast("double") * scale).scalar()


def range_lookup(
    fact: DataFrame,
    rates: DataFrame,
    on: Mapping[str, Column | str],
    at: Column,
    start: str,
    end: str,
    take: Sequence[str],
    how: str = "left",
    by_month: bool = False,
) -> DataFrame:
    """E-13: effective-dated lookup, both ends inclusive, an open end meaning for ever.

    With ``by_month`` each rate row is repeated for the months it covers (no further than the
    last fact date), so the month joins the equality keys; use it when one key carries a long
    rate history and the rates are too big to broadcast.
    """
    keyed = fact.withColumn("__at", at)
    names = []
    for i, expr in enumerate(on.values()):
        keyed = keyed.withColumn(f"__k{i}", F.col(expr) if isinstance(expr, str) else expr)
        names.append(f"__k{i}")
    right = rates.select(
        *[F.col(d).alias(f"__k{i}") for i, d in enumerate(on)],
        F.col(start).alias("__from"),
        F.coalesce(F.col(end), F.lit(FAR_DATE).cast("date")).alias("__to"),
        *take,
    )
    cond = [F.col(f"f.{k}") == F.col(f"r.{k}") for k in names]
    if by_month:
        last = keyed.agg(F.max("__at")).scalar()
        right = right.withColumn("__stop", F.least(F.col("__to"), last)).where(F.col("__from") <= F.col("__stop"))
        right = right.withColumn(
            "__month", F.explode(F.sequence(F.trunc("__from", "month"), F.trunc("__stop", "month"), F.expr("interval 1 month")))
        ).drop("__stop")
        keyed = keyed.withColumn("__month", F.trunc("__at", "month"))
        cond.append(F.col("f.__month") == F.col("r.__month"))
    cond.append(F.col("f.__at").between(F.col("r.__from"), F.col("r.__to")))
    joined = keyed.alias("f").join(right.alias("r"), _all(cond), how)
    return joined.select(*[F.col(f"f.{c}") for c in fact.columns], *[F.col(f"r.{t}") for t in take])


def cascade_match(
    fact: DataFrame,
    steps: Sequence[tuple[DataFrame, Mapping[str, Column | str]]],
    value: str,
    out: str | None = None,
    step_out: str | None = None,
) -> DataFrame:
    """E-15: first match wins over an ordered list of lookups, each already one row per key."""
    joined = fact
    for i, (dim, on) in enumerate(steps):
        joined = lookup(joined, dim, on, {value: f"__v{i}"})
    cols = [F.col(f"__v{i}") for i in range(len(steps))]
    joined = joined.withColumn(out or value, F.coalesce(*cols))
    if step_out:
        step = F.lit(None).cast("int")
        for i in reversed(range(len(steps))):
            step = F.when(cols[i].isNotNull(), i + 1).otherwise(step)
        joined = joined.withColumn(step_out, step)
    return joined.drop(*[f"__v{i}" for i in range(len(steps))])


def bridge(fact: DataFrame, key_value: DataFrame, attribute: str, key: Column, out: str) -> DataFrame:
    """E-21: translate a key through the generic (attribute, key, value) table."""
    side = key_value.where(F.col("attribute") == attribute).select(
        X.norm_key(F.col("key")).alias("key"), F.col("value")
    )
    return lookup(fact, unique_or_fail(side, ["key"], attribute), {"key": X.norm_key(key)}, {"value": out})


def full_outer(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """E-03 on aggregated sides, one row per key as a rule.  Keys come out as left, else right.

    Rows with a null key can never match; they bypass the join so that they do not all land
    in one task.
    """
    lcols = [c for c in left.columns if c not in on]
    rcols = [c for c in right.columns if c not in on]
    whole = _all([F.col(k).isNotNull() for k in on])
    joined = left.where(whole).join(right.where(whole), list(on), "full")
    joined = joined.select(*on, *lcols, *rcols)
    lone_left = left.where(~whole)
    lone_right = right.where(~whole)
    return joined.unionByName(lone_left, allowMissingColumns=True).unionByName(lone_right, allowMissingColumns=True)


def unnest(df: DataFrame, array: Column, out: str, outer: bool = False, offset: str | None = None) -> DataFrame:
    """E-22, A-17: array elements as rows, optionally with their 0-based offset."""
    if offset:
        fn = F.posexplode_outer if outer else F.posexplode
        return df.select("*", fn(array).alias(offset, out))
    fn1 = F.explode_outer if outer else F.explode
    return df.withColumn(out, fn1(array))


def _all(conds: Sequence[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out
