"""Gift cards: who sold a card, what became of it, and what its redemptions earn (D-07, E-18, F-04, F-13).

A card goes through activations, cancelled activations, reissues, redemptions and cancelled
redemptions.  Net counts and amounts are signed sums, its state the last of its events, so a card
with any number of events is combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import cards as K
from ledgerloom.functions import dates as D
from ledgerloom.functions import money as M
from ledgerloom.operators import joins as J
from ledgerloom.operators import windows as W

ACTIVATE, CANCEL_ACTIVATE, REISSUE = "GIFT CARD ACTIVATE", "GIFT CARD CANCEL ACTIVATE", "GIFT CARD REISSUE"
REDEEM, CANCEL_REDEEM, RELOAD = "GIFT CARD REDEEM", "GIFT CARD CANCEL REDEEM", "GIFT CARD RELOAD"
SOLD, USED = (ACTIVATE, REISSUE, CANCEL_ACTIVATE), (REDEEM, CANCEL_REDEEM, RELOAD)
#: an amount that is missing counts as this many minor units
ASSUMED = 100_000
#: place of the order number in the notes of a card sold through the order book
ORDER_AT, ORDER_LENGTH = 9, 8


def _kind() -> Column:
    return F.col("transaction_type")


def _amount(assumed: int) -> Column:
    return F.coalesce("amount_cents", F.lit(assumed).cast("long"))


def net_sales_count() -> Column:
    return F.when(_kind() == ACTIVATE, 1).when(_kind() == CANCEL_ACTIVATE, -1).cast("long")


def net_sales_cents() -> Column:
    """A reissued card is worth its balance."""
    change = F.coalesce("adjustment_cents", F.lit(0).cast("long"))
    return F.when(_kind() == ACTIVATE, _amount(ASSUMED) + change).when(_kind() == REISSUE, F.coalesce("balance_cents", F.lit(0).cast("long"))).when(_kind() == CANCEL_ACTIVATE, _amount(-ASSUMED) + change)


def net_redemptions_count() -> Column:
    return F.when(_kind().isin(REDEEM, RELOAD), 1).when(_kind() == CANCEL_REDEEM, -1).cast("long")


def net_redemptions_cents() -> Column:
    """Redemptions come as negative amounts."""
    return -F.when(_kind() == REDEEM, _amount(-ASSUMED)).when(_kind().isin(CANCEL_REDEEM, RELOAD), _amount(ASSUMED))


def sales_orders(events: DataFrame, orders: DataFrame, partner: DataFrame, outlets: Mapping[str, str], other: str) -> DataFrame:
    """Cards with their activation, the order they were sold in and the discount a card.

    One row for each card, merchant, amount, notes, invoice, place, program and design, with the
    newest activation.  An invoice's partner discounts are added up first, so a card isn't multiplied.
    """
    keys = ["card_number", "merchant", "amount_cents", "notes", "invoice_number", "activation_location", "program_group", "design_code"]
    cards = events.where(_kind().isin(ACTIVATE, REISSUE)).groupBy(*keys).agg(F.max("transaction_date").alias("activation_date"))
    fields = ["payment_method", "order_date", "b2b_unit", "user_type", "customer_id", "sales_application"]
    per = orders.groupBy("order_no", *fields).agg(F.sum("cards").alias("cards_in_order"), F.sum("discount_cents").alias("discount"))
    share = F.when(F.col("cards_in_order") != 0, M.minor_to_major(F.col("discount")) / F.col("cards_in_order").cast("decimal(12,0)"))
    per = per.withColumn("card_discount", F.round(share, 3).cast("double"))
    rows = J.lookup(cards, per, {"order_no": F.substr("notes", F.lit(ORDER_AT), F.lit(ORDER_LENGTH))}, {c: c for c in ["order_no", *fields, "card_discount"]})
    given = partner.groupBy("invoice_number").agg(F.sum("discount_cents").alias("invoice_discount"))
    rows = J.lookup(rows, given, {"invoice_number": "invoice_number"}, ["invoice_discount"])
    partner_part = M.minor_to_major(F.coalesce("invoice_discount", F.lit(0))).cast("double")
    merchant = F.coalesce(F.when(F.col("activation_location") == "SAP Hybris", F.col("b2b_unit")).otherwise(F.col("merchant")), F.lit("D2C"))
    return rows.select(
        "card_number", K.code_map(F.col("merchant"), dict(outlets), F.lit(other)).alias("sales_outlet"), "activation_date", F.col("amount_cents").alias("face_cents"), merchant.alias("sales_merchant"),
        "activation_location", "program_group", "design_code", "order_no", "payment_method", "order_date", "user_type", "customer_id", "sales_application",
        (F.coalesce("card_discount", F.lit(0.0)) - partner_part).alias("card_discount"),
    )


def card_states(events: DataFrame) -> DataFrame:
    """One row a card: its last event, net sales and redemptions, reissues, and its state.

    Cancelled: the last of its sale events took the activation back.  Reissued: it was a reissue.
    Spent: as much is redeemed as was sold.  Else active; unsold, if it was never sold.
    """
    sale = F.when(_kind().isin(*SOLD), F.struct("transaction_date", "event_no", "transaction_type"))
    per = events.groupBy("card_number").agg(
        F.max(sale).alias("last"), F.coalesce(F.sum(net_sales_count()), F.lit(0)).alias("net_sales"), F.coalesce(F.sum(net_sales_cents()), F.lit(0)).alias("sold_cents"),
        F.coalesce(F.sum(net_redemptions_count()), F.lit(0)).alias("net_redemptions"), F.coalesce(F.sum(net_redemptions_cents()), F.lit(0)).alias("redeemed_cents"), F.count_if(_kind() == REISSUE).alias("reissues"),
    )
    last = F.col("last.transaction_type")
    state = (
        F.when(last.isNull(), "UNSOLD").when(last == CANCEL_ACTIVATE, "CANCELLED").when(F.col("redeemed_cents") >= F.col("sold_cents"), "SPENT").when(last == REISSUE, "REISSUED").otherwise("ACTIVE")
    )
    return per.select("card_number", state.alias("state"), F.col("last.transaction_date").alias("last_sale_date"), "net_sales", "sold_cents", "net_redemptions", "redeemed_cents", "reissues")


def detail(events: DataFrame, sales: DataFrame, store: DataFrame, rates: DataFrame, calendar: DataFrame, outlets: Mapping[str, str], companies: Mapping[str, str], known: Sequence[str], other: str) -> DataFrame:
    """Every event with its card's newest sale, net counts and amounts, and both outlets' commission.

    A card without a sale belongs to the outlet of the store that activated it.  Outlets outside the
    ``known`` ones share the rates named Any.
    """
    order = [F.col("activation_date").desc_nulls_last(), *[F.col(c) for c in ("sales_merchant", "face_cents", "order_no", "activation_location", "design_code", "card_discount")]]
    newest = W.keep_first(sales, ["card_number"], order)
    rows = J.lookup(events, newest, {"card_number": "card_number"}, {"sales_outlet": "card_outlet", "sales_merchant": "sales_merchant", "activation_date": "activation_date", "face_cents": "face_cents", "card_discount": "card_discount"})
    rows = J.lookup(rows, store, {"store_id": "activation_store"}, {"company": "__company"})
    own = F.when(F.col("__company").isNull(), other).otherwise(K.code_map(F.col("__company"), dict(companies), F.lit("Any")))
    rows = rows.withColumns({"sales_outlet": F.coalesce("card_outlet", own), "redemption_outlet": K.code_map(F.col("merchant"), dict(outlets), F.lit(other))}).drop("__company", "card_outlet")
    rows = rows.withColumns({"net_sales_count": net_sales_count(), "net_sales_cents": net_sales_cents(), "net_redemptions_count": net_redemptions_count(), "net_redemptions_cents": net_redemptions_cents()})
    rows = J.lookup(rows, calendar, {"calendar_date": "transaction_date"}, {"fy": "retail_year", "pofy": "retail_month", "wofy": "retail_week"})
    rows = W.period_rank(rows.withColumn("month", D.month_start(F.col("transaction_date"))), "month", "__rank")
    bucket = lambda c: F.when(F.col(c).isin(*known), F.col(c)).otherwise("Any")
    rows = J.lookup(rows, rates, {"sales": bucket("sales_outlet"), "redemption": bucket("redemption_outlet")}, ["sales_rate", "redemption_rate"])
    earned = M.minor_to_major(F.col("net_redemptions_cents")).cast("double")
    flag = lambda n: F.when(F.col("__rank") <= n, "Y")
    new = {"sales_commission": earned * F.col("sales_rate"), "redemption_commission": earned * F.col("redemption_rate"), "latest_month_flag": flag(1), "last_12_months_flag": flag(12)}
    return rows.withColumns(new).drop("__rank", "sales_rate", "redemption_rate")


_BY = ["month", "sales_outlet", "redemption_outlet", "program_group", "latest_month_flag", "last_12_months_flag"]


def commissions(rows: DataFrame) -> DataFrame:
    """Monthly redemptions and commission in three scenarios; summed once, then shown by scenario."""
    used = rows.where(_kind().isin(*USED))
    per = used.groupBy(*_BY).agg(*[F.sum(c).alias(c) for c in ("net_redemptions_count", "net_redemptions_cents", "sales_commission", "redemption_commission")])
    entry = lambda name, merchant, amount: F.struct(F.lit(name).alias("scenario"), F.col(merchant).alias("merchant"), amount.alias("net_commission"))
    sold, redeemed = F.col("sales_commission"), F.col("redemption_commission")
    both = F.array(entry("Merchant activated and redeemed", "redemption_outlet", sold + redeemed))
    apart = F.array(entry("Merchant activated and partner redeemed", "sales_outlet", sold), entry("Partner activated and merchant redeemed", "redemption_outlet", redeemed))
    shown = per.withColumn("e", F.explode(F.when(F.col("sales_outlet") == F.col("redemption_outlet"), both).otherwise(apart)))
    return shown.select("e.*", *_BY, "net_redemptions_count", "net_redemptions_cents")


def sales_summary(rows: DataFrame) -> DataFrame:
    """Monthly net sales, discounts and face values of activations, reissues and cancelled activations."""
    sums = {"net_sales_count": "net_sales_count", "net_sales_cents": "net_sales_cents", "net_card_discount": "card_discount", "net_face_cents": "face_cents"}
    return rows.where(_kind().isin(*SOLD)).groupBy("month", "sales_merchant", "sales_outlet", "program_group", "latest_month_flag", "last_12_months_flag").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
