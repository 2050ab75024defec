"""Analytics tables: authorisation rates, fees, payments, payouts, near-real-time fact."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import cards as K
from ledgerloom.functions import dates as D
from ledgerloom.functions import money as M
from ledgerloom.functions import text as X
from ledgerloom.operators import joins as J
from ledgerloom.operators import rollup as R
from ledgerloom.operators import windows as W
from ledgerloom.sinks import tables as T
from ledgerloom.streaming import arrivals as A

BUY = ["PURCHASE", "PURCHASE WITH CASHOUT", "REDEMPTION"]


def _kind() -> Column:
    return F.col("kind")


def _cents() -> Column:
    return F.col("amount_cents")


def _frame_index() -> Column:
    """Ordinal of a period inside its timeframe, so that 'previous' is always one less."""
    p = F.col("period_start")
    return (
        F.when(F.col("timeframe") == "Month", D.month_index(p))
        .when(F.col("timeframe") == "Year", F.year(p))  # fiscal years begin in June of the year before, all of them
        .when(F.col("timeframe") == "Period", F.year(D.fiscal_year_start(p)) * 12 + D.fiscal_period(D.fiscal_week(p)))
        .when(F.col("timeframe") == "Week", F.floor(F.datediff(p, F.lit(dt.date(1970, 1, 5))) / 7).cast("int"))
        .otherwise(F.datediff(p, F.lit(dt.date(1970, 1, 1))))
    )


# fixed values: lenses of the authorisation rates, beside the store and all stores
AUTH_LENSES = ((), ("scheme",), ("declined_reason",), ("scheme", "declined_reason"))


def auth_rates(billing: DataFrame, store: DataFrame, frames: Sequence[str] = ("Month", "Week", "Year"), calendar: DataFrame | None = None, lenses: Sequence[Sequence[str]] = AUTH_LENSES, parts: int | None = None) -> DataFrame:
    """D-07, D-09, D-19, D-20, E-11: approval and decline rates by timeframe and lens.

    Lenses: all, by scheme, by declined reason and by both, per store and over all stores.  The
    facts are summed once per day; timeframes and lenses only multiply that result, inside the
    partition of its store, and last period's rate is a one-period window.  With a fiscal ``calendar`` weeks and years are fiscal
    and "Period" is a frame.
    """
    approved, declined = F.col("approval") == "A", F.col("approval") == "D"
    sums = {
        "n": R.net(_kind(), K.PURCHASE_PLUS, K.PURCHASE_MINUS),
        "n_approved": R.net(_kind(), K.PURCHASE_PLUS, K.PURCHASE_MINUS, when=approved),
        "n_declined": R.net(_kind(), K.PURCHASE_PLUS, K.PURCHASE_MINUS, when=declined),
        "cents_approved": R.net(_kind(), K.PURCHASE_PLUS, K.AMOUNT_MINUS, _cents(), when=approved),
        "cents_declined": R.net(_kind(), K.PURCHASE_PLUS, K.AMOUNT_MINUS, _cents(), when=declined),
    }
    dims = ["store_id", "scheme", "declined_reason"]
    framed = R.timeframes(billing, "tran_date", dims, sums, frames, calendar, "store_id", parts)
    grain = ["timeframe", "period_start"]
    again = [F.sum(n).alias(n) for n in sums]
    views = F.array(*[F.struct(F.lit(i).alias("lens"), *[(F.col(d).cast("string") if d in lens else F.lit("All")).alias(d) for d in dims[1:]]) for i, lens in enumerate(lenses)])
    parts = []
    # a store's periods, lenses and windows stay in the partition that its days were sent to
    for place, rows in ((["store_id"], framed), ([], framed.groupBy(*grain, *dims[1:]).agg(*again))):
        seen = rows.select(*grain, *place, *sums, F.explode(views).alias("__l"))
        per = seen.groupBy(*grain, *place, "__l").agg(*again)
        store_id = F.col("store_id").cast("string") if place else F.lit("All").alias("store_id")
        per = per.select(*grain, store_id, *[F.col(f"__l.{d}").alias(d) for d in dims[1:]], *sums)
        per = per.withColumn("auth_rate", M.ratio(F.col("n_approved"), F.col("n"))).withColumn("declined_rate", M.ratio(F.col("n_declined"), F.col("n")))
        parts.append(W.prior_period(per, ["timeframe", *dims], _frame_index(), {"__prev": F.col("auth_rate")}, 1))
    out = J.lookup(parts[0].unionByName(parts[1]), store, {"store_id": "store_id"}, ["brand", "merchant_group"])
    return out.where(F.col("auth_rate") > 0).select(
        "timeframe",
        "period_start",
        *dims,
        "brand",
        "merchant_group",
        F.col("n_approved").alias("trans_count_approved"),
        F.col("n_declined").alias("trans_count_declined"),
        "auth_rate",
        "declined_rate",
        M.ratio(M.minor_to_major(F.col("cents_approved")), F.col("n_approved")).alias("avg_value_approved"),
        M.ratio(M.minor_to_major(F.col("cents_declined")), F.col("n_declined")).alias("avg_value_declined"),
        (F.col("auth_rate") - F.col("__prev")).alias("benchmark"),
    )


def fee_sums(approved: str = "A") -> dict[str, Column]:
    """D-07: net amounts and fees of approved rows."""
    ok = F.col("approval") == approved
    plus, minus = K.PAYOUT_PLUS, K.PAYOUT_MINUS
    paid = [k for k in plus if k != "REDEMPTION"]
    back = [k for k in minus if k not in ("ACTIVATION", "REDEMPTION REVERSAL")]
    charged = ~_kind().isin("PRE-AUTH", "PRE-AUTH REVERSAL")
    return {
        "transaction_count": F.count("*"),
        "transaction_cents": R.net(_kind(), plus, minus, _cents(), when=ok),
        "interchange_micros": R.net(_kind(), paid, back, F.col("interchange_fee"), when=ok),
        "interchange_count": R.net(_kind(), paid, back, when=ok & (F.col("interchange_fee") != 0)),
        "processing_cents": R.sum_if(charged, F.col("processing_fees")),
        "processing_count": F.count_if(charged & (F.col("processing_fees") != 0)),
    }


def fee_statement(billing: DataFrame, store: DataFrame, months: int = 3, calendar: DataFrame | None = None) -> DataFrame:
    """D-20, D-21: monthly, weekly and daily statement, the running period named to date; with a fiscal
    ``calendar`` also by fiscal period, named by its days."""
    newest = billing.agg(F.max("tran_date")).scalar()
    rows = billing.where(F.col("tran_date") >= F.trunc(F.add_months(newest, -months), "month"))
    rows = J.lookup(rows, store, {"store_id": "store_id"}, ["company", "merchant_group", "invoice_group"])
    rows = rows.withColumn("approval", F.when(F.col("approval") == "A", "Approved").when(F.col("approval") == "D", "Declined").otherwise(F.col("approval")))
    rows = rows.withColumn("scheme_card_type", K.scheme_card_type(F.col("scheme"), F.col("card_type")))
    dims = ["company", "merchant_group", "invoice_group", "kind", "approval", "scheme", "scheme_card_type"]
    frames = ("Day", "Week", "Month") if calendar is None else ("Day", "Week", "Month", "Period")
    framed = R.timeframes(rows, "tran_date", dims, fee_sums("Approved"), frames, calendar)
    start = F.col("period_start")
    # the newest day is among the rows, so its periods are the newest ones
    edges = {f: R.FRAMES[f](newest) for f in ("Month", "Week")}
    year, period = D.fiscal_year_start(start), D.fiscal_period(D.fiscal_week(start))
    last = F.date_sub(F.when(period == 12, D.fiscal_year_start(F.date_add(year, 380))).otherwise(D.fiscal_period_start(year, period + 1)), 1)
    label = (
        F.when((F.col("timeframe") == "Period") & (newest <= last), "Period to date")
        .when(F.col("timeframe") == "Period", F.concat(F.lit("P"), period.cast("string"), F.lit(" "), F.date_format(start, "dd MMM"), F.lit(" to "), F.date_format(last, "dd MMM")))
        .when((F.col("timeframe") == "Month") & (start == edges["Month"]), "Month to date")
        .when((F.col("timeframe") == "Week") & (start == edges["Week"]), "Week to date")
        .when(F.col("timeframe") == "Month", D.month_text(start))
        .when(F.col("timeframe") == "Week", F.concat(F.lit("Wk- "), F.date_format(start, "dd MMM"), F.lit(" to "), F.date_format(F.date_add(start, 6), "dd MMM")))
        .otherwise(start.cast("string"))
    )
    return framed.withColumn("period", label)


def fee_insights(billing: DataFrame, store: DataFrame, months: int = 13) -> DataFrame:
    """D-07, E-11: monthly fees with the same key's previous month."""
    newest = billing.agg(F.max("tran_date")).scalar()
    rows = billing.where(F.col("tran_date") >= F.trunc(F.add_months(newest, -months), "month"))
    rows = J.lookup(rows, store, {"store_id": "store_id"}, ["company", "invoice_group", "merchant_group", "is_online"])
    keys = ["approval", "scheme", "card_type", "kind", "company", "invoice_group", "merchant_group", "is_online"]
    per = rows.groupBy(*keys, D.month_start(F.col("tran_date")).alias("month")).agg(*[c.alias(n) for n, c in fee_sums().items()])
    index = D.month_index(F.col("month"))
    out = W.prior_period(per, keys, index, {f"{n}_lp": F.col(n) for n in fee_sums()}, 1)
    return out.withColumn("flag", F.when(F.col("month") == D.month_start(newest), "max_month"))


def _payment_sums() -> dict[str, Column]:
    reversed_ = K.PURCHASE_MINUS
    return {
        "purchase_count": R.net(_kind(), BUY, reversed_),
        "refund_count": R.net(_kind(), ["REFUND"], ["REFUND REVERSAL"]),
        "purchase_cents": R.net(_kind(), BUY, reversed_, _cents()),
        "refund_cents": R.net(_kind(), ["REFUND"], ["REFUND REVERSAL"], _cents()),
    }


def _sold(billing: DataFrame) -> DataFrame:
    return billing.where((F.col("approval") == "A") & _kind().isin(*BUY, *K.PURCHASE_MINUS, "REFUND", "REFUND REVERSAL"))


def _attributes(store: DataFrame) -> DataFrame:
    return store.select("store_id", "company", "brand", "is_online")


def _of_store(rows: DataFrame, store: DataFrame, key: Column | str = "store_id") -> DataFrame:
    rows = J.lookup(rows, store, {"store_id": key}, ["company", "brand", "is_online"])
    channel = F.when(F.col("is_online") == "Online", "Online").when(F.col("is_online") == "Not Online", "In store")
    return rows.withColumn("channel", channel).drop("is_online")


def _sales(billing: DataFrame, store: DataFrame) -> DataFrame:
    return _of_store(_sold(billing), store)


# dimensions of payments; company, brand and channel come with the store
_PAID_BY = ["store_id", "company", "brand", "channel", "scheme", "card_type"]


def _framed_by_store(rows: DataFrame, day: str, sums: dict[str, Column], store: DataFrame, key: str, frames: Sequence[str], calendar: DataFrame | None, parts: int | None, late: bool) -> DataFrame:
    """Rows by timeframe; the store is joined to the rows or, if ``late``, to their sums of a day, in the partitions of those.

    ``key``, which follows from a row's store id, finds the store; sums of a day are dealt by it, so the join moves none of them.
    """
    if not late:
        return R.timeframes(_of_store(rows, store, key), day, _PAID_BY, sums, frames, calendar, "store_id", parts)
    dims = dict.fromkeys([*_PAID_BY, key])
    framed = R.timeframes(rows, day, list(dims), sums, frames, calendar, key, parts, lambda daily: _of_store(daily, store, key))
    return framed.select("timeframe", "period_start", *_PAID_BY, *sums)


def _oldest_periods(rows: DataFrame, day: str, frames: Sequence[str], calendar: DataFrame | None) -> Column:
    """Each timeframe's first period with rows, as a map of one row: it is found from the days alone and looked up in place."""
    seen = R.timeframes(rows, day, [], {"n": F.count("*")}, frames, calendar)
    first = seen.groupBy("timeframe").agg(F.min("period_start").alias("o"))
    return first.agg(F.map_from_entries(F.collect_list(F.struct("timeframe", "o")))).scalar()


def payments_and_refunds(billing: DataFrame, store: DataFrame, frames: Sequence[str] = ("Day", "Week", "Month"), calendar: DataFrame | None = None, parts: int | None = None, once: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """D-07, D-20, E-11: purchases and refunds by timeframe with the previous period; fiscal ones with a ``calendar``.

    With ``once``, which writes rows and reads them back, the stores' size is known before any row is moved
    and they are joined to the sums of a day; no row is moved, and no hot store sorted, for their sake.
    """
    store = once(_attributes(store)) if once else store
    framed = _framed_by_store(_sold(billing), "tran_date", _payment_sums(), store, "store_id", frames, calendar, parts, once is not None)
    return W.prior_period(framed, ["timeframe", *_PAID_BY], _frame_index(), {f"pre_{n}": F.col(n) for n in _payment_sums()}, 1)


def payments_snapshot(billing: DataFrame, chargebacks: DataFrame, store: DataFrame, links: DataFrame, frames: Sequence[str] = ("Day", "Week", "Month"), calendar: DataFrame | None = None, parts: int | None = None, once: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """D-20, D-21, F-04, G-05: payments and disputes on one shape, the oldest period flagged; fiscal periods with a ``calendar``.

    ``once`` as in ``payments_and_refunds``.
    """
    store = once(_attributes(store)) if once else store
    sold = _sold(billing)
    pay = _framed_by_store(sold, "tran_date", _payment_sums(), store, "store_id", frames, calendar, parts, once is not None)
    # copies and links of a chargeback meet in the partition of its id
    dealt = chargebacks if parts is None else chargebacks.repartition(parts, "id")
    one = W.keep_first(dealt, ["id"], [F.col("file_date").desc(), F.col("amount_cents")])
    cases = one.join(links, "id", "left").withColumn("day", F.col("received_dt").cast("date")).withColumn("store_key", F.upper("store_id"))
    sums = {"dispute_count": F.count("*"), "dispute_cents": F.sum("amount_cents")}
    disputes = _framed_by_store(cases, "day", sums, store, "store_key", frames, calendar, parts, once is not None)
    both = pay.unionByName(disputes, allowMissingColumns=True)
    oldest = _oldest_periods(sold, "tran_date", frames, calendar)
    flag = F.when(F.col("period_start") == oldest[F.col("timeframe")], F.concat(F.lit("min_"), F.lower("timeframe")))
    return both.withColumn("min_flag", flag)


# fixed values: payment method shown for schemes outside the card types
METHOD_BY_SCHEME = {"ALIPAY": "APM", "EFTPOS": "DEBIT", "FUEL CARDS": "APM", "GIFT CARDS": "APM", "PAYPAL": "APM"}


def payment_preferences(billing: DataFrame, store: DataFrame) -> DataFrame:
    """D-07, E-11, G-08: monthly payments through the scheme and the card-type lens, last month beside."""
    dims = ["store_id", "scheme", "card_type"]
    per = _sales(billing, store).groupBy(*dims, D.month_start(F.col("tran_date")).alias("month")).agg(*[c.alias(n) for n, c in _payment_sums().items()])
    per = W.prior_period(per, dims, D.month_index(F.col("month")), {f"pre_{n}": F.col(n) for n in _payment_sums()}, 1)
    method = K.code_map(F.col("scheme"), METHOD_BY_SCHEME, F.col("card_type"))
    keep = ["store_id", "scheme", "month", *_payment_sums(), *[f"pre_{n}" for n in _payment_sums()]]
    return R.lenses(per.withColumn("card_type", method), [*keep, "card_type"], "lens", "payment_method", {"Scheme": F.col("scheme"), "Card Type": F.col("card_type")})


def customer_behaviour(cohorts: DataFrame, channels: DataFrame, group: str) -> DataFrame:
    """E-11, G-08: cohorts through the cardholder and the sales lens, last month beside."""
    both = cohorts.join(channels, [group, "month"], "left")
    values = {"Cardholders": "cust", "Sales": "cents"}
    kinds = ["once_off", "repeat", "new", "returning", "online", "in_store", "cross"]
    prior = {f"{k}_{s}_lm": F.col(f"{k}_{s}") for k in kinds for s in values.values()}
    rows = W.prior_period(both, [group], D.month_index(F.col("month")), prior, 1)
    entry = F.array(
        *[F.struct(F.lit(m).alias("metric"), *[F.col(f"{k}_{s}").alias(k) for k in kinds], *[F.col(f"{k}_{s}_lm").alias(f"{k}_lm") for k in kinds]) for m, s in values.items()]
    )
    return rows.select(group, "month", F.explode(entry).alias("e")).select(group, "month", "e.*")


def payouts(billing: DataFrame, store: DataFrame, windows: DataFrame, plans: DataFrame, sap_map: DataFrame) -> DataFrame:
    """H-62, H-63, E-22: payout day and net amounts, settled here or by a third party.

    The exclusion list is split into (store, scheme) rows once; a transaction that matches is
    the third party's.  Two scheme names are excluded everywhere.
    """
    listed = J.unnest(sap_map.select("store_number", "exclude_issuers"), F.split("exclude_issuers", ","), "issuer")
    listed = listed.select(F.col("store_number").alias("store_id"), K.code_map(F.trim("issuer"), K.SCHEME_BY_PROCESSOR, F.trim("issuer")).alias("scheme"), F.lit(True).alias("__third")).distinct()
    rows = billing.where(F.col("approval") == "A").join(listed, ["store_id", "scheme"], "left")
    third = F.coalesce("__third", F.lit(False)) | F.col("scheme").isin("PAYPAL", "ALIPAY")
    rows = J.lookup(rows, store, {"store_id": "store_id"}, ["division", "company"], "inner")
    rows = J.lookup(rows, windows, {"division": F.upper("division")}, ["settlement_cutoff"], "inner")
    rows = J.lookup(rows, plans, {"division": F.upper("division")}, ["payout_days", "payout_schedule", "weekend_payout", "payment_time"], "inner")
    shifted = D.plus_minutes(F.col("tstamp_trans"), D.cutoff_shift_minutes(F.col("settlement_cutoff")))
    rows = rows.withColumn("period", shifted.cast("date")).withColumn("method", F.when(third, "Third Party").otherwise("Own"))
    due = D.payout_date(F.col("period"), F.col("payout_days"), F.col("payout_schedule"), F.col("weekend_payout"))
    keys = ["method", "period", "division", "company", "store_id", "scheme", "card_type"]
    per = rows.groupBy(*keys, due.alias("settle_date"), F.coalesce("payment_time", F.lit("03:00")).alias("payout_time")).agg(
        R.net(_kind(), K.PAYOUT_PLUS, K.PAYOUT_MINUS, _cents()).alias("trans_cents"),
        R.net(_kind(), BUY, K.PURCHASE_MINUS, _cents()).alias("gross_sales_cents"),
        R.net(_kind(), ["REFUND REVERSAL"], ["REFUND"], _cents()).alias("refund_cents"),
        R.net(_kind(), ["CASHOUT"], ["ACTIVATION", "CASHOUT REVERSAL"], _cents()).alias("adjustment_cents"),
    )
    return per


def nrt_fact(batch: DataFrame, live: DataFrame, store: DataFrame, now: dt.datetime, floor_days: int | None = None) -> DataFrame:
    """L-01: batch rows and the live tail on one shape with the store's attributes."""
    rows = A.nrt_tail(batch, live, "store_id", "tstamp_trans", now, floor_days)
    return J.lookup(rows, store, {"store_id": "store_id"}, ["brand", "division"])


def daily_fee_summary(parts: Sequence[DataFrame], store: DataFrame, run_date: dt.date, weeks: int | None = 12) -> DataFrame:
    """G-05, D-01, D-21, H-58: daily fees of several fee tables with calendar flags."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    if weeks is not None:
        monday = (run_date - dt.timedelta(days=1)) - dt.timedelta(days=(run_date - dt.timedelta(days=1)).weekday())
        rows = rows.where(F.col("tran_date") >= F.lit(monday - dt.timedelta(weeks=weeks)))
    per = rows.groupBy("tran_date", "store_id", "scheme", "card_type", "kind", "approval").agg(
        F.count("*").alias("transaction_count"), F.sum("amount_cents").alias("amount_cents"), F.sum("interchange_fee").alias("interchange_micros"), F.sum("processing_fees").alias("processing_cents")
    )
    per = J.lookup(per, store, {"store_id": "store_id"}, ["company", "merchant_group"], "inner")
    newest = rows.agg(F.max("tran_date")).scalar()
    d = F.col("tran_date")
    yn = lambda c: F.when(c, "Y").otherwise("N")
    return per.select(
        "*",
        yn(d == newest).alias("max_date_flag"),
        yn((d >= F.date_add(newest, -14)) & (d <= F.date_add(newest, -1))).alias("fortnight_flag"),
        yn(D.monday_week_start(d) == D.monday_week_start(newest)).alias("max_week_flag"),
        yn(D.month_start(d) == D.month_start(newest)).alias("max_month_flag"),
        D.monday_week_start(d).alias("week_start"),
        D.monday_week_end(d).alias("week_end"),
        F.last_day(d).alias("month_end"),
    )


def gift_commission(gift: DataFrame, sales: DataFrame, store: DataFrame, rates: DataFrame, known_outlets: Sequence[str]) -> DataFrame:
    """F-04, F-13, E-18: monthly redemptions by sales and redemption outlet with both commissions.

    Outlets outside the known list share one rate, named Any.
    """
    sold = W.keep_first(sales, ["card_number"], [F.col("transaction_date").desc_nulls_last(), F.col("merchant"), F.col("reference_number")])
    rows = gift.where(F.col("transaction_type").isin("GIFT CARD REDEEM", "GIFT CARD RELOAD") & F.col("transaction_date").isNotNull())
    rows = rows.join(sold.select("card_number", F.col("merchant").alias("sales_outlet")), "card_number", "left")
    rows = J.lookup(rows, store, {"store_id": "outlet_code"}, {"company": "redemption_outlet"})
    month = D.month_start(F.col("transaction_date"))
    per = rows.groupBy(F.coalesce("sales_outlet", F.lit("OWN")).alias("sales_outlet"), "redemption_outlet", month.alias("month")).agg(F.count("*").alias("redemptions"), F.sum("amount_cents").alias("cents"))
    bucket = lambda c: F.when(F.col(c).isin(*known_outlets), F.col(c)).otherwise("Any")
    per = J.lookup(per, rates, {"sales": bucket("sales_outlet"), "redemption": bucket("redemption_outlet")}, ["sales_rate", "redemption_rate"])
    per = W.period_rank(per, "month", "month_rank")
    amount = M.minor_to_major(F.col("cents")).cast("double")
    return per.select(
        F.when(F.col("sales_outlet") == F.col("redemption_outlet"), "Own activated and redeemed").otherwise("Activated elsewhere").alias("scenario"),
        "sales_outlet",
        "redemption_outlet",
        "month",
        "redemptions",
        "cents",
        (amount * F.col("sales_rate")).alias("sales_commission"),
        (amount * F.col("redemption_rate")).alias("redemption_commission"),
        F.when(F.col("month_rank") <= 1, "Y").alias("latest_month_flag"),
        F.when(F.col("month_rank") <= 12, "Y").alias("last_12_months_flag"),
    )


def enrich(billing: DataFrame, chargebacks: DataFrame, sequence_of: DataFrame) -> DataFrame:
    """J-07, J-08, F-04, F-14: attempt, event and order ids, and the chargeback of the same sale.

    ``sequence_of`` gives a repeated refund its suffix id per transaction.
    """
    link = W.keep_first(chargebacks.where(X.non_blank(F.col("store_id"))), ["store_id", "txn_day", "amount_cents"], [F.col("file_date").desc(), F.col("id")])
    keyed = billing.withColumn("txn_day", F.col("tran_date"))
    rows = keyed.join(link.select("store_id", "txn_day", "amount_cents", F.col("id").alias("chargeback_id")), ["store_id", "txn_day", "amount_cents"], "left").drop("txn_day")
    rows = rows.withColumn("payment_event_id", F.concat(F.lit("tran_uid"), "tran_uid")).withColumn("order_id", F.col("order_number"))
    rows = rows.withColumn("payment_attempt_id", F.concat(F.lit("tran_uid"), "tran_uid"))
    return T.updated_from(rows, sequence_of, ["tran_uid"], ["payment_attempt_id"])
