"""The log of transactions that can't be settled yet: stores without a usable mapping, and repeated ids (I-07)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import cards as K
from ledgerloom.functions import dates as D
from ledgerloom.functions import text as X
from ledgerloom.operators import joins as J
from ledgerloom.operators import windows as W
from ledgerloom.plans.settlement import OWN_SIGN

# fixed values: sources by the prefix of their ids that settle only with stores of a usable mapping, not for
# partners, and only where the store has a window if its division settles by store
MAPPED_ONLY, NOT_PARTNERS, OWN_WINDOW = ("QC",), ("QC", "TC"), ("TC",)


def due(trans: DataFrame, store: DataFrame, windows: DataFrame, by_store: DataFrame, sap_map: DataFrame, factors: DataFrame, settled: DataFrame, run_date: dt.date) -> DataFrame:
    """Unsettled rows of all sources inside their store's or division's settlement window, with division,
    data_source and the store's mapping as it is."""
    source = F.left("tran_uid", F.lit(2))
    # no window reaches outside these two: rows beyond them go before any join
    both = windows.select("earliest_date", "day_lag", "settlement_cutoff").unionByName(by_store.select("earliest_date", "day_lag", "settlement_cutoff"))
    first = both.agg(F.min(F.col("earliest_date").cast("timestamp_ntz"))).scalar()
    last = both.agg(F.max(D.cutoff_on(F.date_add(F.lit(run_date), F.col("day_lag")), F.col("settlement_cutoff")))).scalar()
    trans = trans.where((F.col("transaction_time") >= first) & (F.col("transaction_time") <= last))
    rows = J.lookup(trans, store.where(~F.col("is_closed")), {"store_id": "store_id"}, ["division"], "inner")
    take = ["division_type", "settle_by_store", "last_execution_time", "days_lookback", "earliest_date", "day_lag", "settlement_cutoff"]
    rows = rows.withColumns({"division": X.norm_key(F.col("division")), "data_source": source})
    rows = J.lookup(rows, windows.where(F.col("is_active") == "Y"), {"division": "division"}, take, "inner")
    own = {"store_id": "s_store", **{c: f"s_{c}" for c in take[2:]}}
    rows = J.lookup(rows, by_store.where(F.col("is_active") == "Y"), {"store_id": "store_id"}, own)
    qualifier = F.when(source == "QC", F.col("division_type")).otherwise(F.col("qualifier"))
    rows = J.lookup(rows, factors.where(F.col("settlement_factor") != 0), {"transaction_type": "kind", "tran_qualifier": qualifier}, ["settlement_factor"])
    rows = rows.where(source.isin(*OWN_SIGN) | F.col("settlement_factor").isNotNull())
    rows = rows.where(~source.isin(*NOT_PARTNERS) | (F.col("division_type") != "PARTNER"))
    rows = rows.where(~source.isin(*OWN_WINDOW) | (F.col("settle_by_store") == "N") | F.col("s_store").isNotNull())

    of_division = F.col("s_store").isNull() | (F.col("settle_by_store") == "N")
    pick = lambda c: F.when(of_division, F.col(c)).otherwise(F.col(f"s_{c}"))
    inside = K.in_settlement_window(F.col("transaction_time"), *[pick(c) for c in ("last_execution_time", "days_lookback", "earliest_date")], F.lit(run_date), pick("day_lag"), pick("settlement_cutoff"))
    rows = J.left_anti(rows.where(inside), settled, ["tran_uid"])
    rows = J.lookup(rows, sap_map, {"store_number": "store_id"}, {"store_number": "mapped_store", "active_flag": "map_active", "company_code": "company_code"})
    usable = (X.norm_key(F.coalesce("map_active", F.lit("N"))) != "N") & X.non_blank(F.col("company_code"))
    return rows.where(~source.isin(*MAPPED_ONLY) | usable)


def findings() -> Column:
    """What is wrong with a row's mapping, blank if nothing is."""
    return (
        F.when(F.col("mapped_store").isNull(), "Store is missing in settlement mapping")
        .when(X.norm_key(F.coalesce("map_active", F.lit("N"))) == "N", "Store not active in settlement mapping")
        .when(~X.non_blank(F.col("company_code")), "Company code is missing in settlement mapping")
        .otherwise("")
    )


def report(
    trans: DataFrame, store: DataFrame, windows: DataFrame, by_store: DataFrame, sap_map: DataFrame, factors: DataFrame, flags: DataFrame, settled: DataFrame, batch: str, run_ts: dt.datetime,
    keep: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """One distinct row a transaction with a finding; copies of an id after the first are findings too.

    ``trans`` is all sources on the settlement's shape; ``flags`` (division, data_source) names the
    sources that are logged.  An id may have any number of copies: they are counted on two levels,
    so the rows are needed twice; ``keep`` writes them, or all sources are worked out once more.
    """
    rows = keep(due(trans, store, windows, by_store, sap_map, factors, settled, run_ts.date()))
    rows = J.left_semi(rows, flags, ["division", "data_source"])
    order = [F.col(c) for c in ("transaction_time", "store_id", "kind", "amount_cents")]
    rows = W.sequence_in_group(rows, ["tran_uid"], order, F.col("transaction_time").cast("date"), "copy")
    twice = F.when(F.col("copy") > 1, F.concat(F.lit("Duplicate transaction "), F.col("tran_uid"), F.lit(" "))).otherwise("")
    return (
        rows.withColumn("message", F.concat(twice, findings()))
        .where(F.col("message") != "")
        .select(F.lit(batch).alias("batch_number"), "store_id", F.col("transaction_time").cast("date").alias("tran_date"), "message", "data_source", "division", "transaction_time", D.at(run_ts).alias("created"))
        .distinct()
    )
