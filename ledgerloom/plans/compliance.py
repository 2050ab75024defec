"""Monthly and daily compliance rules (I-11..I-25).

Every monthly rule is the same shape: facts joined to stores, one aggregate per merchant and
month, one range window for all three-month baselines, thresholds from the control table.
Inputs are a switch feed (see FIXTURES.md ``switch_txn``), a store dimension, reference code
tables and the control table (rule_id, attribute, merchant, merchant_to_report, value).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import cards as K
from ledgerloom.functions import dates as D
from ledgerloom.functions import money as M
from ledgerloom.functions import text as X
from ledgerloom.operators import joins as J
from ledgerloom.operators import recon as Q
from ledgerloom.operators import rollup as R
from ledgerloom.operators import windows as W
from ledgerloom.params import RunParams

SITE = ["merchant", "store_id", "site_name"]
SITE_MCC = ["merchant", "mcc_code", "store_id", "site_name"]


def in_months(df: DataFrame, ts: str, start: object, end: object | None) -> DataFrame:
    """Range on the raw time column, so the predicate reaches the scan."""
    out = df.where(F.col(ts) >= F.lit(start).cast("timestamp_ntz"))
    return out if end is None else out.where(F.col(ts) < F.lit(end).cast("timestamp_ntz"))


def with_store(txn: DataFrame, store: DataFrame, params: RunParams, terminal: str = "net_term_id") -> DataFrame:
    """Facts with a terminal, joined to stores that have a division."""
    dims = store.where(X.non_blank(F.col("division"))).withColumn("__id", X.norm_key(F.col("store_id")))
    return J.lookup(
        txn.where(X.non_blank(F.col(terminal))),
        dims,
        {"__id": K.store_of_terminal(F.col(terminal), params.store_width)},
        {"store_id": "site_store_id", "division": "division", "site_name": "site", "mcc_code": "mcc"},
        "inner",
    )


def with_merchant(df: DataFrame, control: DataFrame, site_divisions: Sequence[str], blank_null_sites: bool) -> DataFrame:
    """Merchant after merges; store and site are shown only for divisions reported per site."""
    merge = control.where((F.col("rule_id") == 0) & (F.col("attribute") == "Merge"))
    merge = J.unique_or_fail(merge.select(X.norm_key(F.col("merchant")).alias("m"), F.col("merchant_to_report").alias("to")), ["m"], "merge")
    out = J.lookup(df, merge, {"m": X.norm_key(F.col("division"))}, {"to": "__to"})
    per_site = X.norm_key(F.col("division")).isin(*site_divisions)

    def shown(c: Column) -> Column:
        v = F.when(per_site, X.norm_key(c)).otherwise("")
        return F.coalesce(v, F.lit("")) if blank_null_sites else v

    named = {
        "merchant": X.norm_key(X.first_non_blank(F.col("__to"), F.col("division"))),
        "store_id": shown(F.col("site_store_id")),
        "site_name": shown(F.col("site")),
        "mcc_code": F.coalesce("mcc", F.lit("")),
    }
    return out.withColumns(named).drop("__to")


def monthly(df: DataFrame, keys: Sequence[str], ts: str, sums: Mapping[str, Column]) -> DataFrame:
    per = df.withColumn("first_of_month", D.month_start(F.col(ts).cast("date")))
    return per.groupBy(*keys, "first_of_month").agg(*[v.alias(n) for n, v in sums.items()])


def against_baseline(
    months: DataFrame,
    keys: Sequence[str],
    measures: Mapping[str, tuple[Column, Column]],
    params: RunParams,
    thresholds: Mapping[str, Column],
    empty: float | None = None,
) -> DataFrame:
    """F-08..F-10, then the report months with thresholds and the run time."""
    out = W.rolling_previous(months, keys, "first_of_month", measures, params.baseline_from, empty=empty)
    out = out.where((F.col("first_of_month") >= F.lit(params.report_start)) & (F.col("first_of_month") < F.lit(params.window_end)))
    return out.select("*", *[c.alias(n) for n, c in thresholds.items()])


def low_high(control: DataFrame, rule: float, low: str, high: str, scale: float = 0.01, merchant: str | None = None) -> dict[str, Column]:
    return {
        "threshold1": J.control_value(control, rule, low, scale, merchant),
        "threshold2": J.control_value(control, rule, high, scale, merchant),
    }


def _store_days(txn: DataFrame, params: RunParams, sums: Mapping[str, Column]) -> DataFrame:
    kept = txn.where(X.non_blank(F.col("net_term_id")))
    return kept.groupBy(
        F.left("net_term_id", F.lit(params.store_width)).alias("store_id"), F.col("tstamp_local").cast("date").alias("transaction_date")
    ).agg(*[v.alias(n) for n, v in sums.items()])


def _with_limits(days: DataFrame, store: DataFrame, control: DataFrame, rule: int, low: str, high: str, floor: tuple[float, float]) -> DataFrame:
    dims = store.where(X.non_blank(F.col("division")))
    out = J.lookup(days, dims, {"store_id": "store_id"}, ["division", "site_name"], "inner")
    out = J.threshold(out, control, F.col("division"), rule, low, "Default_Low", floor[0], out="threshold1", report_as="__to1")
    out = J.threshold(out, control, F.col("division"), rule, high, "Default_High", floor[1], out="threshold2", report_as="__to2")
    return out.withColumn("merchant", F.coalesce("__to1", "__to2", "division")).drop("__to1", "__to2", "division")


def _present() -> Column:
    return F.col("pos_crdhldr_presnt") == "0"


def rule1(txn: DataFrame, store: DataFrame, control: DataFrame, params: RunParams) -> DataFrame:
    """I-11: card present and not present counts per store and day."""
    cp = F.coalesce(_present(), F.lit(False))
    days = _store_days(txn, params, {"card_present": F.count_if(cp), "card_not_present": F.count_if(~cp)})
    return _with_limits(days, store, control, 1, "Ratio_NotPresent To Total_Low", "Ratio_NotPresent To Total_High", (0.2, 0.3))


def rule2_1(txn: DataFrame, store: DataFrame, control: DataFrame, params: RunParams) -> DataFrame:
    """I-11: rule 1 over the report window's months."""
    return rule1(in_months(txn, "tstamp_local", params.window_start, params.window_end), store, control, params)


def rule2(txn: DataFrame, store: DataFrame, control: DataFrame, params: RunParams) -> DataFrame:
    """I-12: manual entry among card-present transactions per store and day."""
    manual = F.coalesce(F.col("pos_crd_dat_in_mod") == "6", F.lit(False))
    days = _store_days(txn.where(_present()), params, {"card_present": F.count("*"), "manual_count": F.count_if(manual)})
    return _with_limits(days, store, control, 2, "Ratio_ManualToCardPresent_Low", "Ratio_ManualToCardPresent_High", (0.01, 0.015))


def _approved(txn: DataFrame, response: DataFrame) -> DataFrame:
    ok = response.where(X.norm_key(F.col("approval_flag")) == "Y")
    return txn.join(ok.select(F.col("action_code").alias("act_code")).distinct(), "act_code", "left_semi")


def _cashouts(txn: DataFrame, store: DataFrame, response: DataFrame, control: DataFrame, params: RunParams, sites: Sequence[str]) -> DataFrame:
    base = _approved(txn.where(_present() & (F.col("cashout_total") != 0)), response)
    return with_merchant(with_store(base, store, params), control, sites, blank_null_sites=False)


def rule8(txn: DataFrame, store: DataFrame, response: DataFrame, control: DataFrame, params: RunParams, sites: Sequence[str]) -> DataFrame:
    """I-13: monthly cash-out against day-weighted and plain three-month baselines."""
    base = _cashouts(in_months(txn, "tstamp_local", params.window_start, params.window_end), store, response, control, params, sites)
    months = monthly(base, SITE, "tstamp_local", {"cashout": M.minor_to_major(F.sum("cashout_total"))})
    months = months.withColumn("days_in_month", D.days_in_month(F.col("first_of_month")))
    limits = low_high(control, 8, "Cashout_Low", "Cashout_High")
    limits["threshold3"] = J.control_value(control, 8, "Single PAN")
    measures = {
        "avg_daily_cashout_3mon": W.rolling_nonzero(F.col("cashout"), F.col("days_in_month")),
        "rolling_3mon_avg": W.rolling_nonzero(F.col("cashout")),
    }
    return against_baseline(months, SITE, measures, params, limits, empty=0.0)


def rule8_1(txn: DataFrame, store: DataFrame, response: DataFrame, control: DataFrame, params: RunParams, sites: Sequence[str]) -> DataFrame:
    """I-14: daily cash-out, cards above the single-card limit, the month's daily baseline.

    Two-level aggregate: per card and day first, so a busy merchant is spread over its cards.
    """
    base = _cashouts(in_months(txn, "tstamp_local", params.report_start, None), store, response, control, params, sites)
    base = base.withColumn("transaction_date", F.col("tstamp_local").cast("date"))
    cards = base.groupBy(*SITE, "masked_pan", "transaction_date").agg(M.minor_to_major(F.sum("cashout_total")).alias("cashout"))
    limit = J.control_value(control, 8, "Single PAN")
    days = cards.groupBy(*SITE, "transaction_date").agg(
        F.sum("cashout").alias("cashout"), F.count_if(F.col("cashout").cast("double") > limit).alias("cashout_exceeding_threshold")
    )
    days = days.withColumn("days_in_month", D.days_in_month(F.col("transaction_date")))
    days = days.withColumn("__m", D.month_start(F.col("transaction_date")))
    baseline = rule8(txn, store, response, control, params, sites).select(*SITE, F.col("first_of_month").alias("__m"), "avg_daily_cashout_3mon")
    out = days.join(baseline, [*SITE, "__m"], "left").drop("__m")
    limits = low_high(control, 8, "Cashout_Low", "Cashout_High")
    return out.select("*", *[c.alias(n) for n, c in limits.items()], limit.alias("threshold3"))


def rule10(txn: DataFrame, store: DataFrame, control: DataFrame, params: RunParams, sites: Sequence[str]) -> DataFrame:
    """I-15: card present and not present counts against their baselines."""
    base = with_merchant(with_store(in_months(txn, "tstamp_local", params.window_start, params.window_end), store, params), control, sites, True)
    cp = F.coalesce(_present(), F.lit(False))
    months = monthly(base, SITE_MCC, "tstamp_local", {"count_cp": F.count_if(cp), "count_cnp": F.count_if(~cp)})
    measures = {"rolling_avg_cp": W.rolling_nonzero(F.col("count_cp")), "rolling_avg_cnp": W.rolling_nonzero(F.col("count_cnp"))}
    return against_baseline(months, SITE_MCC, measures, params, low_high(control, 10, "Low", "High"))


def rule12(txn: DataFrame, store: DataFrame, control: DataFrame, params: RunParams, sites: Sequence[str], low_attr: str = "Low", high_attr: str = "High") -> DataFrame:
    """I-16: technical fallback among card-present transactions."""
    base = in_months(txn.where(_present()), "tstamp_local", params.window_start, params.window_end)
    base = with_merchant(with_store(base, store, params), control, sites, False)
    fallback = F.coalesce(F.col("pos_crd_dat_in_mod").isin("B", "C"), F.lit(False))
    months = monthly(base, SITE, "tstamp_local", {"count_cp": F.count("*"), "count_fallback": F.count_if(fallback)})
    measures = {"rolling_avg_cp": W.rolling_nonzero(F.col("count_cp")), "rolling_avg_fallback": W.rolling_nonzero(F.col("count_fallback"))}
    return against_baseline(months, SITE, measures, params, low_high(control, 12, low_attr, high_attr))


def rule15_16(txn: DataFrame, store: DataFrame, tran_type: DataFrame, control: DataFrame, params: RunParams, sites: Sequence[str]) -> DataFrame:
    """I-17: purchase and refund values and counts, four baselines from one window."""
    kinds = tran_type.select(F.col("dn_tran_code").try_cast("int").alias("code"), F.left(X.norm_key(F.col("abbr")), F.lit(6)).alias("kind"))
    kinds = kinds.where(F.col("kind").isin("PURCHA", "REFUND"))
    base = in_months(txn, "tstamp_local", params.window_start, params.window_end)
    base = J.lookup(base, kinds, {"code": F.col("tran_type_id").try_cast("int")}, {"kind": "__kind"}, "inner")
    base = with_merchant(with_store(base, store, params), control, sites, True)
    buy, back = F.col("__kind") == "PURCHA", F.col("__kind") == "REFUND"
    paid, returned = F.coalesce("purchase_total", F.lit(0)), F.coalesce("transaction_total", F.lit(0))
    sums = {
        "purchase_value": M.minor_to_major(R.sum_if(buy, paid)),
        "refund_value": M.minor_to_major(R.sum_if(back, returned)),
        "purchase_count": F.count_if(buy & (paid != 0)),
        "refund_count": F.count_if(back & (returned != 0)),
    }
    months = monthly(base, SITE_MCC, "tstamp_local", sums)
    measures = {f"rolling_{n}": W.rolling_nonzero(F.col(n)) for n in sums}
    limits = {
        "value_diff_low": J.control_value(control, 15, "Value Difference_Low"),
        "value_diff_high": J.control_value(control, 15, "Value Difference_High"),
        "refund_low": J.control_value(control, 16, "Low", 0.01),
        "refund_high": J.control_value(control, 16, "High", 0.01),
    }
    return against_baseline(months, SITE_MCC, measures, params, limits)


def settled_detail(txn: DataFrame, wallet: DataFrame | None, tran_type: DataFrame, response: DataFrame, store: DataFrame, type_code: DataFrame, control: DataFrame, params: RunParams, sites: Sequence[str], since: object, until: object) -> DataFrame:
    """Approved switch rows and wallet rows on one shape, with signed settlement cents.

    Two sources, one union, then one pass of dimension lookups.
    """
    base = txn.where(F.col("amt_recon_net") != 0)
    base = base.where((F.col("tstamp_trans") >= F.lit(since).cast("timestamp_ntz")) & (F.col("tstamp_trans") < F.lit(until).cast("timestamp_ntz")))
    base = _approved(base, response)
    kinds = tran_type.select(F.col("dn_tran_code").try_cast("int").alias("code"), "abbr")
    base = J.lookup(base, kinds, {"code": F.col("tran_type_id").try_cast("int")}, ["abbr"], "inner")
    detail = base.select(
        F.col("net_term_id").alias("terminal"),
        K.scheme_of(F.col("proc_id_iss_b"), F.col("inst_id_recon_iss")).alias("scheme"),
        "tstamp_trans",
        K.calc_tran_type(F.col("proc_id_iss_b"), F.col("abbr"), F.col("mti")).alias("kind"),
        F.col("amt_recon_net").alias("cents"),
    )
    if wallet is not None:
        paid = wallet.where((F.col("txn_time") >= F.lit(since).cast("timestamp_ntz")) & (F.col("txn_time") < F.lit(until).cast("timestamp_ntz")))
        detail = detail.unionByName(
            paid.select(
                F.col("terminal_id").alias("terminal"),
                X.norm_key(F.col("scheme_name")).alias("scheme"),
                F.col("txn_time").alias("tstamp_trans"),
                X.norm_key(F.col("transaction_type")).alias("kind"),
                F.col("amount_cents").alias("cents"),
            )
        )
    codes = type_code.select(X.norm_key(F.col("tran_type_desc")).alias("kind"), "spend_factor")
    detail = detail.join(codes, "kind", "left").withColumn("signed_cents", F.coalesce("spend_factor", F.lit(0)) * F.col("cents"))
    return with_merchant(with_store(detail, store, params, "terminal"), control, sites, True)


def billing_by_scheme(detail: DataFrame) -> DataFrame:
    """I-20, rule 22 part 1: settlement by merchant, scheme and month."""
    return monthly(detail, [*SITE_MCC, "scheme"], "tstamp_trans", {"settlement_amount": M.minor_to_major(F.sum("signed_cents"))})


def rule20(by_scheme: DataFrame, control: DataFrame, params: RunParams) -> DataFrame:
    """I-18: monthly deposits per merchant."""
    kept = by_scheme.where((F.col("first_of_month") >= F.lit(params.window_start)) & (F.col("first_of_month") < F.lit(params.window_end)))
    months = kept.groupBy(*SITE_MCC, "first_of_month").agg(F.sum("settlement_amount").alias("deposit_value"))
    return against_baseline(months, SITE_MCC, {"rolling_avg": W.rolling_nonzero(F.col("deposit_value"))}, params, low_high(control, 20, "Low", "High"))


def rule21(txn: DataFrame, store: DataFrame, control: DataFrame, params: RunParams, sites: Sequence[str]) -> DataFrame:
    """I-19: counts per scheme."""
    base = with_merchant(with_store(in_months(txn, "tstamp_local", params.window_start, params.window_end), store, params), control, sites, False)
    base = base.withColumn("scheme", K.scheme_of(F.col("proc_id_iss_b"), F.col("inst_id_recon_iss")))
    cp = F.coalesce(_present(), F.lit(False))
    keys = [*SITE, "scheme"]
    months = monthly(base, keys, "tstamp_local", {"count_cp": F.count_if(cp), "count_cnp": F.count_if(~cp)})
    measures = {"rolling_avg_cp": W.rolling_nonzero(F.col("count_cp")), "rolling_avg_cnp": W.rolling_nonzero(F.col("count_cnp"))}
    return against_baseline(months, keys, measures, params, low_high(control, 21, "Low", "High"))


def rule22(by_scheme: DataFrame, params: RunParams) -> DataFrame:
    """I-21: deposits per scheme; its thresholds are constant zero."""
    keys = [*SITE_MCC, "scheme"]
    kept = by_scheme.where((F.col("first_of_month") >= F.lit(params.window_start)) & (F.col("first_of_month") < F.lit(params.window_end)))
    months = kept.select(*keys, "first_of_month", F.coalesce("settlement_amount", F.lit(0)).alias("deposit_value"))
    zero = {"threshold_low": F.lit(0), "threshold_high": F.lit(0)}
    return against_baseline(months, keys, {"rolling_avg": W.rolling_nonzero(F.col("deposit_value"))}, params, zero)


def rule23(detail: DataFrame, control: DataFrame, params: RunParams) -> DataFrame:
    """I-22: average transaction value against value per transaction of three months."""
    kept = in_months(detail, "tstamp_trans", params.window_start, params.window_end)
    months = monthly(kept, SITE_MCC, "tstamp_trans", {"trans_value": M.minor_to_major(F.sum("signed_cents")), "trans_count": F.count("*")})
    months = months.withColumn("avg_trans", M.ratio(F.col("trans_value"), F.col("trans_count"), None))
    return against_baseline(months, SITE_MCC, _value_measures(), params, low_high(control, 23, "Low", "High"))


def _value_measures() -> dict[str, tuple[Column, Column]]:
    value, count = F.col("trans_value"), F.col("trans_count")
    return {
        "rolling_avg_trans": (F.coalesce(value, F.lit(0)), F.coalesce(count, F.lit(0))),
        "rolling_avg_value": W.rolling_nonzero(value),
        "rolling_avg_count": W.rolling_nonzero(count),
    }


def rule24(chargebacks: DataFrame, store: DataFrame, control: DataFrame, params: RunParams, sites: Sequence[str]) -> DataFrame:
    """I-23: chargebacks, one row per bank reference, against their baselines."""
    one = W.keep_first(chargebacks, ["bank_ref_no"], [F.col("txn_dttm_local"), F.col("id")])
    base = in_months(one.where((F.col("amount_cents") != 0) & X.non_blank(F.col("store_id"))), "txn_dttm_local", params.window_start, params.window_end)
    base = with_merchant(with_store(base.withColumnRenamed("store_id", "__term"), store, params, "__term"), control, sites, False)
    months = monthly(base, SITE, "txn_dttm_local", {"trans_value": M.minor_to_major(F.sum("amount_cents")), "trans_count": F.count("*")})
    return against_baseline(months, SITE, _value_measures(), params, low_high(control, 24, "Low", "High"))


def with_alert(df: DataFrame, metric: str, baseline: str, low: str = "threshold1", high: str = "threshold2") -> DataFrame:
    """I-24: optional comparison that the published tables leave to their readers."""
    return df.withColumn("alert_level", Q.alert_level(F.col(metric), F.col(baseline), F.col(low), F.col(high)))
