"""Card identity model and its upkeep (E-12, G-06, H-51, J-07..J-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import cards as K
from ledgerloom.functions import text as X
from ledgerloom.operators import windows as W
from ledgerloom.sinks import tables as T

MODEL = ["customer_id", "card_id", "par", "scdr_token", "masked_pan", "card_type", "customer_ref", "container_id", "item_id", "program_group"]


def model(switch: DataFrame, wallet: DataFrame, gift: DataFrame) -> DataFrame:
    """Newest attributes of every card of three sources, on one shape, without repeats.

    ``latest_with_ties`` keeps all rows of the newest time; the distinct after it makes the
    union one.
    """
    s = W.latest_with_ties(switch.where(F.col("scdr_token").isNotNull()), ["scdr_token"], "tstamp_trans")
    ident = K.card_id(token=F.col("scdr_token"))
    cards = s.select(ident.alias("customer_id"), ident.alias("card_id"), F.col("pymt_acct_ref").alias("par"), "scdr_token", "masked_pan", "card_type").distinct()
    w = W.latest_with_ties(wallet, ["customer_ref", "container_id", "item_id"], "txn_time")
    wid = K.card_id(customer_ref=F.col("customer_ref"), container_id=F.col("container_id"), item_id=F.col("item_id"))
    wallets = w.select(F.concat(F.lit("customerRef|"), "customer_ref").alias("customer_id"), wid.alias("card_id"), "customer_ref", "container_id", "item_id").distinct()
    gid = K.card_id(gift_card=F.col("card_number"))
    gifts = gift.select(gid.alias("customer_id"), gid.alias("card_id"), "program_group").distinct()
    out = cards.unionByName(wallets, allowMissingColumns=True).unionByName(gifts, allowMissingColumns=True)
    return out.where(F.col("card_id").isNotNull()).select(*MODEL)


def with_alias(rows: DataFrame) -> DataFrame:
    return rows.withColumn("pan_alias", X.card_alias(F.col("card_id")))


def upkeep(model_rows: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Known cards take a missing account reference from their token's, new cards are added.

    ``arrivals`` carries the model's columns for newly seen cards.
    """
    known = T.updated_where(model_rows, X.non_blank(F.col("scdr_token")), {"card_id": K.card_id(token=F.col("scdr_token"))})
    refs = W.keep_first(known.where(F.col("par").isNotNull() & F.col("scdr_token").isNotNull()), ["scdr_token"], [F.col("par"), F.col("card_id")])
    known = T.updated_from(known, refs.select("scdr_token", "par"), ["scdr_token"], ["par"])
    fresh = T.only_new(arrivals.where(F.col("card_id").isNotNull()).distinct(), known, ["card_id"])
    return with_alias(known.unionByName(fresh, allowMissingColumns=True))
