"""Near-real-time fact: live rows priced as they land, late rows kept, late rates corrected (L-01, L-03, E-13, J-07).

Live rows of several sources share one shape.  Each micro-batch is priced by the rates in force on
the day of the sale, gets its settlement date if it has one, and is committed under the batch's
own key, so a replay adds nothing.  A rate that comes late, or is put right, reprices the days of
the sales it covers, no others.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import cards as K
from ledgerloom.functions import dates as D
from ledgerloom.functions import money as M
from ledgerloom.functions import text as X
from ledgerloom.operators import joins as J
from ledgerloom.sinks.versions import VersionedTables, Write

LIVE = ["source", "tran_uid", "store_id", "tstamp_trans", "card_type", "kind", "approval", "amount_cents"]
_RATE = ["proc_fee_code", "proc_fee_percent", "proc_fee_fixed"]


def switch_live(billing: DataFrame, arrival: Column | None = None) -> DataFrame:
    """Switch rows on the live shape, with their time of ``arrival`` if that is given."""
    more = [] if arrival is None else [arrival.alias("arrival")]
    return billing.select(F.lit("TC").alias("source"), K.tran_uid("TC", F.col("tran_uid")).alias("tran_uid"), *LIVE[2:], *more)


def online_live(acquirer: DataFrame, key_value: DataFrame, width: int = 5) -> DataFrame:
    """Rows of the online gateway on the live shape; a missing terminal is found through the merchant map."""
    rows = J.bridge(acquirer, key_value, "merchant-terminal", F.col("merchant_id"), "__terminal")
    ts, kind = D.timestamp_from_int(F.col("transaction_timestamp")), X.norm_key(F.col("transaction_type"))
    approval = F.when(F.coalesce("transaction_approval_status", F.lit(0)) == 0, "A").otherwise("D")
    values = [F.lit("CY"), K.tran_uid("CY", F.col("tran_uid"), kind, D.compact_stamp(ts)), K.store_of_terminal(X.first_non_blank(F.col("terminal_id"), F.col("__terminal")), width)]
    values += [ts, F.col("card_type"), kind, approval, F.col("transaction_amount")]
    return rows.select(*[v.alias(n) for v, n in zip(values, LIVE)])


def priced(rows: DataFrame, store: DataFrame, rates: DataFrame) -> DataFrame:
    """Processing fee as of the day of the sale; 0 where no rate is in force.

    ``rates`` (merchant, card_type, from_date, to_date and the fee) must not overlap for one
    merchant and card type; a long history joins by month too.
    """
    own = [c for c in rows.columns if c not in ("merchant", "processing_fee")]
    rows = J.lookup(rows.select(*own), store, {"store_id": "store_id"}, {"ratecard_group": "merchant"})
    found = J.range_lookup(rows, rates, {"merchant": "merchant", "card_type": "card_type"}, F.col("tstamp_trans").cast("date"), "from_date", "to_date", _RATE)
    amount = M.minor_to_major(F.col("amount_cents")).cast("double")
    fee: Column = M.processing_fee(F.col("proc_fee_code"), amount, F.col("proc_fee_percent"), F.col("proc_fee_fixed"))
    return found.select(*own, "merchant", F.coalesce(fee, F.lit(0.0)).alias("processing_fee"))


def dated(rows: DataFrame, posted: DataFrame) -> DataFrame:
    """Settlement date of the rows that are settled; ``posted`` (tran_uid, posting_date) may repeat an id."""
    one = posted.groupBy("tran_uid").agg(F.max("posting_date").alias("posting_date"))
    return J.lookup(rows, one, {"tran_uid": "tran_uid"}, {"posting_date": "settlement_date"})


def _day(rows: DataFrame) -> DataFrame:
    return rows.withColumn("day", F.coalesce(F.date_format("tstamp_trans", "yyyy-MM-dd"), F.lit("null")))


def land(stream: DataFrame, tables: VersionedTables, store: DataFrame, rates: DataFrame, posted: DataFrame, name: str, checkpoint: str) -> None:
    """Price and keep everything that has arrived, once: a replayed micro-batch finds its key committed."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        rows = dated(priced(batch.select(*LIVE), store, rates), posted)
        tables.commit(f"{name}-{batch_id}", {"live": Write(_day(rows), "append", "day")})

    stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def reprice(tables: VersionedTables, store: DataFrame, rates: DataFrame, changed: DataFrame, batch: str, after_write: Callable[[str], None] | None = None) -> list[str]:
    """Late rates: the days with sales that ``changed`` rates cover are priced anew with all ``rates``; those days.

    ``changed`` holds the rates that came late or were wrong, with their merchant, card type and dates.
    """
    if tables.holds(batch):
        return []
    live = tables.read("live")
    spans = changed.select("merchant", "card_type", "from_date", "to_date").distinct()
    sale = live.select("merchant", "card_type", F.col("tstamp_trans").cast("date").alias("on"), "day").distinct()
    hit = J.range_lookup(sale, spans.withColumn("hit", F.lit(True)), {"merchant": "merchant", "card_type": "card_type"}, F.col("on"), "from_date", "to_date", ["hit"], how="inner")
    days = sorted(r["day"] for r in hit.select("day").distinct().collect())  # a calendar's worth
    again = priced(tables.read("live", parts=days), store, rates)
    tables.commit(batch, {"live": Write(again.select(*live.columns), "parts", "day")}, after_write)
    return days


def fact(batch: DataFrame, live: DataFrame, now: dt.datetime) -> DataFrame:
    """Batch rows, and live rows that the batch lacks: newer than their store's newest batch row (NRT),
    or older but with an id that the batch doesn't have (LATE).  No live row up to ``now`` is lost."""
    newest = batch.groupBy("store_id").agg(F.max("tstamp_trans").alias("__newest"))
    rows = live.where(F.col("tstamp_trans") <= D.at(now)).join(newest, "store_id", "left")
    new = F.col("__newest").isNull() | (F.col("tstamp_trans") > F.col("__newest"))
    fresh = rows.where(new).withColumn("src_type", F.lit("NRT"))
    late = J.left_anti(rows.where(~F.coalesce(new, F.lit(True))), batch, ["tran_uid"]).withColumn("src_type", F.lit("LATE"))
    tail = fresh.unionByName(late).drop("__newest")
    return batch.withColumn("src_type", F.lit("BATCH")).unionByName(tail.select(*batch.columns, "src_type"))
