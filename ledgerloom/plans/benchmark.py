"""Merchant against market benchmark, cohorts and stable stores."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import cards as K
from ledgerloom.functions import dates as D
from ledgerloom.functions import money as M
from ledgerloom.operators import rollup as R
from ledgerloom.operators import windows as W


def latest_area(area: DataFrame, value: str, sentinel: int = 99999) -> DataFrame:
    """E-12, C-20: rows of the newest file per area, industry and month; the sentinel is null."""
    newest = W.latest_with_ties(area, ["area", "industry_code", "period"], "file_date")
    return newest.withColumn(value, F.nullif(F.col(value), F.lit(sentinel)))


def area_growth(area: DataFrame, value: str) -> DataFrame:
    """E-11, D-09: one value per area, industry and month against last month and last year."""
    keys = ["area", "industry_code"]
    per = area.groupBy(*keys, "period").agg(F.max(value).alias(value))
    index = D.month_index(F.col("period"))
    per = W.prior_period(per, keys, index, {f"{value}_lm": F.col(value)}, 1)
    per = W.prior_period(per, keys, index, {f"{value}_ly": F.col(value)}, 12)

    def growth(prev: str) -> Column:
        return M.ratio(F.col(value) - F.col(prev), F.col(prev))

    return per.select("*", growth(f"{value}_lm").alias("growth_mom"), growth(f"{value}_ly").alias("growth_yoy"))


def stable_stores(daily: DataFrame, store: str, day: str, months: int = 13) -> DataFrame:
    """F-16: stores with at least ``months`` active months before a calendar month."""
    return W.active_periods_before(daily.select(store, F.col(day).alias("month")), store, "month", "active_months", months)


def _card_months(billing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Net count and amount per group, card and month: the cards are the unit, not the sales."""
    rows = billing.where((F.col("approval") == "A") & F.col("card_id").isNotNull() & F.col("kind").isin(*K.PURCHASE_PLUS, *K.AMOUNT_MINUS))
    return rows.groupBy(*keys, "card_id", D.month_start(F.col("tran_date")).alias("month")).agg(
        R.net(F.col("kind"), K.PURCHASE_PLUS, K.PURCHASE_MINUS).alias("n"), R.net(F.col("kind"), K.PURCHASE_PLUS, K.AMOUNT_MINUS, F.col("amount_cents")).alias("cents")
    )


def customer_cohorts(billing: DataFrame, group: str) -> DataFrame:
    """F-15: once-off, repeat, new and returning cards per group and month, from one window."""
    rows = W.month_presence(_card_months(billing, [group]), [group, "card_id"], "month", "seen")
    n, c, seen = F.col("n"), F.col("cents"), F.col("seen")
    kinds = {"once_off": n == 1, "repeat": n > 1, "new": (n > 0) & ~seen, "returning": (n > 0) & seen}
    aggs = []
    for name, cond in kinds.items():
        aggs += [F.count_if(cond).alias(f"{name}_cust"), R.sum_if(cond, n).alias(f"{name}_count"), R.sum_if(cond, c).alias(f"{name}_cents")]
    return rows.groupBy(group, "month").agg(*aggs).withColumn("cust_total", F.col("once_off_cust") + F.col("repeat_cust"))


def channel_cohorts(billing: DataFrame, group: str, online: Column) -> DataFrame:
    """F-15: cards that bought only online, only in store, or both, per group and month."""
    rows = _card_months(billing.withColumn("__online", online), [group, "__online"]).where(F.col("n") > 0)
    on = F.col("__online")
    per = rows.groupBy(group, "month", "card_id").agg(
        F.count_if(on).alias("on"), F.count_if(~on).alias("off"), F.sum("n").alias("n"), F.sum("cents").alias("cents")
    )
    kinds = {"online": (F.col("on") > 0) & (F.col("off") == 0), "in_store": (F.col("on") == 0) & (F.col("off") > 0), "cross": (F.col("on") > 0) & (F.col("off") > 0)}
    aggs = []
    for name, cond in kinds.items():
        aggs += [F.count_if(cond).alias(f"{name}_cust"), R.sum_if(cond, F.col("n")).alias(f"{name}_count"), R.sum_if(cond, F.col("cents")).alias(f"{name}_cents")]
    return per.groupBy(group, "month").agg(*aggs)


def performance_levels(billing: DataFrame, store: DataFrame, parts: int | None = None) -> DataFrame:
    """D-19: monthly sales per store, state and country level by scheme and card type, one pass.

    A store's levels are summed in the partition its rows were sent to (``parts``: the partitions'
    number, which is to follow the rows'); those of states and countries start from sums over stores.
    """
    dims = ["country", "state", "store_id", "scheme", "card_type", "month"]
    rows = billing.join(store.select("store_id", "state", F.lit("AU").alias("country")), "store_id").withColumn("month", D.month_start(F.col("tran_date")))
    kept = rows.where(F.col("approval") == "A")
    kept = kept.repartition("store_id") if parts is None else kept.repartition(parts, "store_id")
    cuts = [["scheme", "card_type"], ["scheme"], ["card_type"], []]
    sums = {"sales_count": R.net(F.col("kind"), K.PURCHASE_PLUS, K.PURCHASE_MINUS), "sales_cents": R.net(F.col("kind"), K.PURCHASE_PLUS, K.AMOUNT_MINUS, F.col("amount_cents"))}
    again = [F.sum(n).alias(n) for n in sums]
    fine = kept.groupBy(*dims).agg(*[v.alias(n) for n, v in sums.items()])
    views = F.array(*[F.struct(F.lit(i).alias("cut"), *[(F.col(d).cast("string") if d in cut else F.lit("All")).alias(d) for d in dims[3:5]]) for i, cut in enumerate(cuts)])
    place = [*dims[:3], "month"]
    stores = fine.select(*place, *sums, F.explode(views).alias("__l")).groupBy(*place, "__l").agg(*again)
    stores = stores.select(*dims[:3], *[F.col(f"__l.{d}").alias(d) for d in dims[3:5]], "month", *sums)
    keys = [d for d in dims if d != "store_id"]
    wide = fine.groupBy(*keys).agg(*again)
    wide = R.levels(wide, keys, [[*p, *c, "month"] for p in (["country", "state"], ["country"]) for c in cuts], sums, grouped=True)
    return stores.unionByName(wide.withColumn("store_id", F.lit("All")))


def against_market(levels: DataFrame, own: Sequence[str], market: Sequence[str], value: str) -> DataFrame:
    """Merchant level next to its market level and last month's own value."""
    index = D.month_index(F.col("month"))
    mine = W.prior_period(levels, list(own), index, {f"{value}_lm": F.col(value)}, 1)
    per = levels.groupBy(*market, "month").agg(F.sum(value).alias("market_value"))
    return mine.join(per, [*market, "month"], "left").withColumn("market_share", M.ratio(F.col(value), F.col("market_value")))
