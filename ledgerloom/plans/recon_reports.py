"""Reconciliation reports between feeds (I-01..I-04)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import money as M
from ledgerloom.functions import text as X
from ledgerloom.operators import joins as J
from ledgerloom.operators import recon as Q
from ledgerloom.operators import rollup as R

CUTOFF = "18:00:00"


def _apm_orders(apm: DataFrame, cutoff: str) -> DataFrame:
    """Requests per order with the amounts before and after the cut-off (the second itself is before)."""
    kept = apm.where(X.norm_key(F.col("req_type")).isin("N", "N-", "R", "P"))
    early = F.col("req_time") <= cutoff
    return kept.groupBy(F.col("req_tx_ref").alias("order_no"), "req_store", "req_date", "req_type").agg(
        R.sum_if(early, F.col("amount_cents")).alias("before_cutoff"), R.sum_if(~early, F.col("amount_cents")).alias("after_cutoff")
    )


def _apm_settled(settlement: DataFrame, keys: Sequence[str]) -> DataFrame:
    return settlement.groupBy(F.col("transaction_id").alias("order_no"), *keys).agg(F.sum("amount_cents").alias("settled_cents"))


def apm_missing(apm: DataFrame, settlement: DataFrame, cutoff: str = CUTOFF) -> DataFrame:
    """I-01: requests against settlement lines, missing on either side."""
    left = _apm_orders(apm, cutoff)
    right = _apm_settled(settlement, ["store_id", "payment_date"])
    both = J.full_outer(left.withColumn("__l", F.lit(True)), right.withColumn("__r", F.lit(True)), ["order_no"])
    flag = F.when(F.col("__l").isNull(), "Missing in requests").when(F.col("__r").isNull(), "Missing in settlement").otherwise("Not Missing")
    return both.withColumn("flag", flag).drop("__l", "__r")


def apm_tran_level(apm: DataFrame, settlement: DataFrame, cutoff: str = CUTOFF) -> DataFrame:
    """I-02: request total against settled total per order, nulls as zero."""
    left, right = _apm_orders(apm, cutoff), _apm_settled(settlement, [])
    both = left.join(right, "order_no", "left")
    return both.withColumn("flag", Q.match_flag(F.col("settled_cents"), F.coalesce("before_cutoff", F.lit(0)) + F.coalesce("after_cutoff", F.lit(0))))


def apm_store_level(apm: DataFrame, settlement: DataFrame, cutoff: str = CUTOFF) -> DataFrame:
    """I-02 without null handling: an order without settlement is a mismatch."""
    left, right = _apm_orders(apm, cutoff), _apm_settled(settlement, ["store_id"])
    both = J.lookup(left, right, {"order_no": "order_no", "store_id": "req_store"}, ["settled_cents"])
    flag = Q.match_flag(F.col("settled_cents"), F.col("before_cutoff") + F.col("after_cutoff"), null_as_zero=False)
    return both.select("req_store", "req_date", "req_type", "settled_cents", "before_cutoff", "after_cutoff", flag.alias("flag")).distinct()


def clearing(settlement: DataFrame, store: DataFrame, sap_map: DataFrame) -> DataFrame:
    """D-01, E-02: clearing totals per order, day and store with two dimensions."""
    per = settlement.groupBy("transaction_id", "payment_date", "store_id").agg(F.count("*").alias("transaction_count"), F.sum("amount_cents").alias("cents"))
    rows = J.lookup(per, store.withColumn("__id", X.norm_key(F.col("store_id"))), {"__id": X.norm_key(F.col("store_id"))}, ["division", "brand", "company"])
    rows = J.lookup(rows, sap_map, {"store_number": X.norm_key(F.col("store_id"))}, ["merchant_organisation_id"])
    return rows.withColumn("amount", M.minor_to_major(F.col("cents"))).drop("cents")


def _signed(c: Column, kind: Column) -> Column:
    return M.signed(c, kind, ["REFUND"])


def wallet_orders(wallet: DataFrame) -> DataFrame:
    """Signed wallet amounts per order, split by gateway."""
    cents = _signed(F.col("amount_cents"), F.col("transaction_type"))
    return wallet.groupBy("order_id").agg(
        R.sum_if(F.col("gateway") == "WEX", cents).alias("wallet_wex"), R.sum_if(F.col("gateway") == "QC", cents).alias("wallet_gift"), F.min("txn_time").alias("wallet_time")
    )


def switch_orders(switch: DataFrame, cutoff: str = CUTOFF) -> DataFrame:
    """Switch amounts per order before and after the cut-off."""
    early = F.date_format("tstamp_local", "HH:mm:ss") <= cutoff
    total = F.col("transaction_total")
    return switch.groupBy(F.col("order_number").cast("long").alias("order_id")).agg(R.sum_if(early, total).alias("switch_before"), R.sum_if(~early, total).alias("switch_after"))


def pos_orders(pos: DataFrame) -> DataFrame:
    return pos.groupBy(F.col("reference_number").alias("order_id")).agg(F.sum("tender_cents").alias("pos_cents"), F.min("site_number").alias("site_number"))


def three_source_missing(switch: DataFrame, wallet: DataFrame, pos: DataFrame) -> DataFrame:
    """I-03: switch with wallet, their orders against the point of sale."""
    return Q.three_way(switch_orders(switch), wallet_orders(wallet), pos_orders(pos), "order_id", "POS", "SWITCH/WALLET")


def three_source_match(switch: DataFrame, wallet: DataFrame, pos: DataFrame) -> DataFrame:
    """I-02, I-03 at transaction level."""
    rows = pos_orders(pos).join(switch_orders(switch), "order_id", "left").join(wallet_orders(wallet).drop("wallet_time"), "order_id", "left")
    parts = [F.coalesce(c, F.lit(0)) for c in ("switch_before", "switch_after", "wallet_wex", "wallet_gift")]
    return rows.withColumn("flag", Q.match_flag(F.col("pos_cents"), parts[0] + parts[1] + parts[2] + parts[3]))


def three_source_store(switch: DataFrame, wallet: DataFrame, pos: DataFrame) -> DataFrame:
    """I-04: store and day totals of the three sources; each is one row per order before it joins."""
    per = pos.groupBy(F.col("reference_number").alias("order_id"), "site_number", F.col("business_date").alias("day")).agg(F.sum("tender_cents").alias("pos_cents"))
    switched = switch.groupBy(F.col("order_number").cast("long").alias("order_id"), F.left("net_term_id", F.lit(10)).alias("site_number")).agg(F.sum("transaction_total").alias("switch_cents"))
    walleted = wallet_orders(wallet).select("order_id", (F.col("wallet_wex") + F.col("wallet_gift")).alias("wallet_cents"))
    rows = per.join(switched, ["order_id", "site_number"], "left").join(walleted, "order_id", "left")
    zero = lambda c: F.sum(F.coalesce(c, F.lit(0))).alias(c)
    out = rows.groupBy("site_number", "day").agg(zero("pos_cents"), zero("switch_cents"), zero("wallet_cents"))
    return out.withColumn("flag", Q.match_flag(F.col("pos_cents"), F.col("switch_cents") + F.col("wallet_cents")))


def gift_pos_transactions(gift: DataFrame, pos: DataFrame) -> DataFrame:
    """I-02: gift-card orders against tenders and activations of the same store."""
    g = gift.groupBy(F.col("reference_number").cast("long").alias("order_id"), F.col("outlet_code").alias("site_number"), "merchant").agg(F.sum("amount_cents").alias("gift_cents"))
    both = pos.groupBy(F.col("reference_number").alias("order_id"), "site_number").agg(
        F.sum(F.when(F.col("tender_type") == "REDEEM", F.col("tender_cents"))).alias("redeem_cents"), F.sum(F.when(F.col("tender_type") == "ACTIVATE", F.col("tender_cents"))).alias("activate_cents")
    )
    rows = g.join(both, ["order_id", "site_number"], "left")
    paid = F.coalesce("redeem_cents", F.lit(0)) + F.coalesce("activate_cents", F.lit(0))
    return rows.withColumn("flag", Q.match_flag(F.col("gift_cents"), paid))


def gift_pos_stores(gift: DataFrame, pos: DataFrame) -> DataFrame:
    """I-04, C-19: the same per store and merchant."""
    rows = gift_pos_transactions(gift, pos)
    return rows.groupBy("site_number", "merchant").agg(
        F.count("*").alias("orders"), F.sum("gift_cents").alias("gift_cents"), F.sum("redeem_cents").alias("redeem_cents"), F.sum("activate_cents").alias("activate_cents")
    )


def gift_online(gift: DataFrame, wallet: DataFrame) -> DataFrame:
    """E-01, G-05: gift-card orders joined to wallet redemptions and activations."""
    g = gift.groupBy(F.col("reference_number").cast("long").alias("order_id"), "transaction_type", "transaction_status").agg(F.sum("amount_cents").alias("gift_cents"))
    paid = wallet.where(F.col("transaction_type") == "PURCHASE").groupBy("order_id").agg(F.sum("amount_cents").alias("wallet_cents"))
    redeem = paid.withColumn("wallet_kind", F.lit("GIFT CARD REDEEM"))
    back = wallet.where(F.col("transaction_type") == "REFUND").groupBy("order_id").agg(F.sum("amount_cents").alias("wallet_cents")).withColumn("wallet_kind", F.lit("GIFT CARD ACTIVATE"))
    return g.join(redeem.unionByName(back), "order_id")


def gift_online_missing(gift: DataFrame, wallet: DataFrame) -> DataFrame:
    """I-01 for online gift cards."""
    g = gift.where(F.col("transaction_status") == "SUCCESS").groupBy(F.col("reference_number").cast("long").alias("order_id")).agg(F.sum("amount_cents").alias("gift_cents"))
    w = wallet.where(F.col("gateway") == "QC").groupBy("order_id").agg(F.sum("amount_cents").alias("wallet_cents"))
    return Q.reconcile(g, w, ["order_id"], "gift cards", "wallet")
