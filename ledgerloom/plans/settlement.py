"""Settlement pipelines: eligibility, ledger file, partner and wallet rows, listings, payouts.

Amounts arrive in minor units (``*_cents``) and stay exact.  Every function takes its run time
as an argument and returns DataFrames; ``settlement_run`` commits them together.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import cards as K
from ledgerloom.functions import dates as D
from ledgerloom.functions import money as M
from ledgerloom.functions import text as X
from ledgerloom.operators import joins as J
from ledgerloom.operators import rollup as R
from ledgerloom.operators import windows as W
from ledgerloom.sinks import files as S

UNIFIED = ["tran_uid", "transaction_time", "file_name", "store_id", "kind", "qualifier", "amount_cents", "discount_cents", "issuer"]

# fixed values: merchant suffix of a company code in ledger file names
COMPANY_SUFFIX = {"1410": "aus", "2025": "nzl"}


def _unified(df: DataFrame, **cols: Column) -> DataFrame:
    base: dict[str, Column] = {"qualifier": F.lit(""), "discount_cents": F.lit(0).cast("long"), "issuer": F.lit("NONE")}
    base.update(cols)
    return df.select(*[base[c].alias(c) for c in UNIFIED])


def gift_source(gift: DataFrame, windows: DataFrame, width: int = 5) -> DataFrame:
    """Successful gift-card rows of merchants that are not settlement partners."""
    partners = windows.where(F.col("division_type") == "PARTNER").select(F.col("division").alias("__m"))
    own = gift.where(X.norm_key(F.col("transaction_status")) == "SUCCESS").withColumn("__m", X.norm_key(F.col("merchant")))
    own = own.join(partners, "__m", "left_anti")
    ts = D.date_time_or_default(F.col("transaction_date"), F.col("transaction_time"))
    return _unified(
        own,
        tran_uid=K.tran_uid("QC", F.col("approval_code"), F.col("reference_number"), F.col("batch_number"), D.compact_stamp(ts)),
        transaction_time=ts,
        file_name=F.lit("gift"),
        store_id=K.gift_store(F.col("outlet_code"), width=width),
        kind=X.norm_key(F.col("transaction_type")),
        amount_cents=F.coalesce("amount_cents", F.lit(0)),
    )


def wallet_source(wallet: DataFrame, width: int = 5) -> DataFrame:
    """Wallet purchases; the number of dots in the reference names the kind of account."""
    dots = X.count_char(F.col("txn_ref"), ".")
    kept = wallet.where((F.col("transaction_type") == "PURCHASE") & X.non_blank(F.col("txn_ref")) & dots.isin(0, 2))
    return _unified(
        kept,
        tran_uid=K.tran_uid("DP", F.trim("txn_ref")),
        transaction_time=F.date_trunc("second", "txn_time").cast("timestamp_ntz"),
        file_name=F.lit("wallet"),
        store_id=K.store_of_terminal(F.col("terminal_id"), width),
        kind=X.norm_key(F.col("transaction_type")),
        qualifier=F.when(dots == 0, "WEX").otherwise("QC"),
        amount_cents=F.coalesce("amount_cents", F.lit(0)),
    )


# fixed values: request types of the wallet feed that settle
APM_TYPES = ["N", "N-", "P", "R", "30001000", "30002000"]


def apm_source(apm: DataFrame) -> DataFrame:
    kept = apm.where((F.col("res_rt") == "TRANSACTION APPROVED") & X.norm_key(F.col("req_type")).isin(*APM_TYPES))
    kept = kept.where((F.col("amount_cents") != 0) & F.col("req_date").isNotNull() & X.non_blank(F.col("req_store")))
    return _unified(
        kept,
        tran_uid=K.wallet_uid(F.col("req_tx_ref"), F.col("req_date"), F.col("req_time")),
        transaction_time=D.date_time_or_default(F.col("req_date"), F.col("req_time")),
        file_name=F.lit("apm"),
        store_id=X.norm_key(F.col("req_store")),
        kind=X.norm_key(F.col("req_type")),
        amount_cents=F.col("amount_cents"),
    )


def acquirer_source(acquirer: DataFrame, key_value: DataFrame, width: int = 5) -> DataFrame:
    """Acquirer rows; a missing terminal is found through the merchant map."""
    kept = acquirer.where(X.norm_key(F.col("transaction_type")).isin("PURCHASE", "REFUND"))
    kept = kept.where((F.coalesce("transaction_approval_status", F.lit(0)) == 0) & (F.coalesce("transaction_amount", F.lit(0)) != 0))
    kept = J.bridge(kept, key_value, "merchant-terminal", F.col("merchant_id"), "__terminal")
    ts = D.timestamp_from_int(F.col("transaction_timestamp"))
    return _unified(
        kept,
        tran_uid=K.tran_uid("CY", F.col("tran_uid"), X.norm_key(F.col("transaction_type")), D.compact_stamp(ts)),
        transaction_time=ts,
        file_name=F.lit("acquirer"),
        store_id=K.store_of_terminal(X.first_non_blank(F.col("terminal_id"), F.col("__terminal")), width),
        kind=X.norm_key(F.col("transaction_type")),
        qualifier=F.lit("CY"),
        amount_cents=F.col("transaction_amount"),
        issuer=F.coalesce(X.blank_to_null(X.norm_key(F.col("scheme"))), F.lit("NONE")),
    )


def switch_source(switch: DataFrame, tran_type: DataFrame, response: DataFrame, type_code: DataFrame, width: int = 5, prefix: str = "TC") -> DataFrame:
    """Approved switch rows of a settling kind; the amount's sign comes from the kind."""
    ok = response.where(X.norm_key(F.col("approval_flag")) == "Y").select(F.col("action_code").alias("act_code")).distinct()
    kept = switch.where((F.coalesce("transaction_total", F.lit(0)) != 0) | (F.coalesce("surcharge_amount", F.lit(0)) != 0)).join(ok, "act_code", "left_semi")
    kinds = tran_type.select(F.col("dn_tran_code").try_cast("int").alias("c"), "abbr")
    kept = J.lookup(kept, kinds, {"c": F.col("tran_type_id").try_cast("int")}, ["abbr"], "inner")
    settling = type_code.where((F.col("settlement_amount_flag") != 0) & (F.col("spend_factor") != 0))
    settling = settling.select(X.norm_key(F.col("tran_type_desc")).alias("k"), (F.col("settlement_amount_flag") * F.col("spend_factor")).alias("sign"))
    kept = J.lookup(kept, settling, {"k": K.calc_tran_type(F.col("proc_id_iss_b"), F.col("abbr"), F.col("mti"))}, ["sign"], "inner")
    return _unified(
        kept,
        tran_uid=K.tran_uid(prefix, F.col("tran_uid")),
        transaction_time=F.date_trunc("second", "tstamp_trans").cast("timestamp_ntz"),
        file_name=F.lit("switch"),
        store_id=K.store_of_terminal(F.col("net_term_id"), width),
        kind=X.norm_key(F.col("abbr")),
        qualifier=F.lit(prefix),
        amount_cents=F.abs(F.coalesce("transaction_total", F.lit(0))) * F.col("sign"),
        issuer=F.coalesce(K.scheme_of(F.col("proc_id_iss_b"), F.col("inst_id_recon_iss")), F.lit("NONE")),
    )


def edp_source(edp: DataFrame, tran_type: DataFrame, response: DataFrame, type_code: DataFrame, width: int = 5) -> DataFrame:
    """Rows of the wallet's own activity feed with a known response and a settling kind; the kind gives the sign."""
    kept = edp.where((F.col("txn_disposition") == 1) & F.col("local_timestamp").isNotNull() & (F.coalesce("amount_txn", F.lit(0)) != 0))
    known = response.select(F.col("action_code").try_cast("int").alias("code")).distinct()
    kept = kept.withColumn("code", F.col("action_code").try_cast("int")).join(known, "code", "left_semi")
    kinds = tran_type.select(F.col("dn_tran_code").try_cast("int").alias("c"), "abbr")
    kept = J.lookup(kept, kinds, {"c": F.col("txn_type_indicator").try_cast("int")}, ["abbr"], "inner")
    settling = type_code.where((F.col("settlement_amount_flag") != 0) & (F.col("spend_factor") != 0))
    settling = settling.select(X.norm_key(F.col("tran_type_desc")).alias("k"), (F.col("settlement_amount_flag") * F.col("spend_factor")).alias("sign"))
    kind = K.calc_tran_type(F.lit(""), F.col("abbr"), F.col("mti"))
    kept = J.lookup(kept, settling, {"k": kind}, ["sign"], "inner")
    return _unified(
        kept,
        tran_uid=K.tran_uid("ED", F.col("retrieval_ref_num"), F.col("pan"), D.compact_stamp(F.col("local_timestamp"))),
        transaction_time=F.date_trunc("second", "local_timestamp").cast("timestamp_ntz"),
        file_name=F.lit("edp"),
        store_id=K.store_of_terminal(F.col("card_acceptor_terminal_id"), width),
        kind=kind,
        qualifier=F.lit("EDP"),
        amount_cents=F.abs("amount_txn") * F.col("sign"),
    )


def partner_source(partner: DataFrame) -> DataFrame:
    """Gift-card activations and cancellations that partners report."""
    kept = partner.where(X.norm_key(F.col("transaction_type")).isin("ACTIVATION", "CANCELLATION") & X.non_blank(F.col("merchant")))
    kept = kept.where((F.coalesce("amount_cents", F.lit(0)) != 0) | (F.coalesce("discount_cents", F.lit(0)) != 0))
    return _unified(
        kept,
        tran_uid=K.partner_uid(F.col("invoice_number"), F.col("card_number"), F.col("transaction_type"), F.col("transaction_date")),
        transaction_time=F.coalesce("transaction_date", F.lit("1900-01-01").cast("timestamp_ntz")),
        file_name=F.lit("partner"),
        store_id=X.norm_key(F.col("store_id")),
        kind=X.norm_key(F.col("transaction_type")),
        qualifier=F.lit("QP"),
        discount_cents=F.coalesce("discount_cents", F.lit(0)),
        amount_cents=F.coalesce("amount_cents", F.lit(0)),
    )


#: sources whose kinds carry the sign, so that no factor is needed
OWN_SIGN = ("TC", "ED")


def combined(sources: Sequence[DataFrame]) -> DataFrame:
    """All sources on one shape, rows with a store only."""
    out = sources[0]
    for s in sources[1:]:
        out = out.unionByName(s)
    return out.where(X.non_blank(F.col("store_id")))


def _store_or_division(by_store: str, column: str, division_column: str | None = None) -> Column:
    use_division = F.col("__store_window").isNull() | (F.col("settle_by_store") == "N")
    return F.when(use_division, F.col(division_column or column)).otherwise(F.col(by_store))


def pre_settlement(
    trans: DataFrame, store: DataFrame, windows: DataFrame, by_store: DataFrame, sap_map: DataFrame, factors: DataFrame, settled: DataFrame, run_date: dt.date
) -> DataFrame:
    """Eligible, not yet settled transactions of all sources (L-03, E-05, H-71).

    An id that occurs twice among all transactions is rejected in every copy (F-02).  That
    check comes last: it counts ids over everything but joins eligible rows only.
    """
    everything = trans
    # no window begins before the earliest one: older rows go before any join
    earliest = windows.select("earliest_date").unionByName(by_store.select("earliest_date")).agg(F.min(F.col("earliest_date").cast("timestamp_ntz"))).scalar()
    trans = trans.where((F.col("transaction_time") < F.lit(run_date).cast("timestamp_ntz")) & (F.col("transaction_time") >= earliest))
    open_stores = store.where(~F.col("is_closed")).withColumn("__id", X.norm_key(F.col("store_id")))
    rows = J.lookup(trans, open_stores, {"__id": "store_id"}, ["division", "site_name", "suburb", "state", "is_online"], "inner")
    active = windows.where(F.col("is_active") == "Y")
    take = ["division_type", "settle_by_store", "last_execution_time", "days_lookback", "earliest_date", "file_prefix"]
    rows = J.lookup(rows, active, {"division": X.norm_key(F.col("division"))}, take, "inner")
    mapped = sap_map.where((X.norm_key(F.coalesce("active_flag", F.lit(""))) != "N") & X.non_blank(F.col("company_code")))
    rows = J.lookup(rows, mapped, {"store_number": "store_id"}, ["exclude_issuers"], "inner")
    source = F.left("tran_uid", F.lit(2))
    qualifier = F.when(source == "QC", F.col("division_type")).otherwise(F.col("qualifier"))
    rows = J.lookup(rows, factors.where(F.col("settlement_factor") != 0), {"transaction_type": "kind", "tran_qualifier": qualifier}, ["settlement_factor", "record_type"])
    rows = rows.where(source.isin(*OWN_SIGN) | F.col("settlement_factor").isNotNull())
    rows = rows.where(~X.list_has_text(F.col("exclude_issuers"), F.col("issuer")))
    rows = J.left_anti(rows, settled, ["tran_uid"])
    stores = by_store.where(F.col("is_active") == "Y")
    rows = J.lookup(rows, stores, {"store_id": "store_id"}, {"store_id": "__store_window", "last_execution_time": "__s_last", "days_lookback": "__s_back", "earliest_date": "__s_first"})
    rows = rows.where((F.col("settle_by_store") != "Y") | F.col("__store_window").isNotNull())
    floor = K.settlement_floor(_store_or_division("__s_last", "last_execution_time"), _store_or_division("__s_back", "days_lookback"))
    first = _store_or_division("__s_first", "earliest_date").cast("timestamp_ntz")
    at = F.col("transaction_time")
    rows = rows.where((at > floor) & (at >= first))
    rows = W.without_repeats(rows, ["tran_uid"], everything)
    own_sign = source.isin(*OWN_SIGN)
    area = F.concat(
        F.upper(F.trim(F.coalesce("site_name", F.lit("")))),
        F.when(X.non_blank(F.col("site_name")) & X.non_blank(F.col("suburb")), ",").otherwise(""),
        F.upper(F.trim(F.coalesce("suburb", F.lit("")))),
    )
    return rows.select(
        "tran_uid",
        X.norm_key(F.coalesce("state", F.lit(""))).alias("state"),
        area.alias("business_area"),
        X.norm_key(F.col("division")).alias("division"),
        "file_prefix",
        "store_id",
        "record_type",
        F.col("file_name").alias("filename"),
        "transaction_time",
        F.when(F.upper("is_online") == "ONLINE", "Y").otherwise("N").alias("eft_flag"),
        F.when(own_sign, F.col("amount_cents")).otherwise(F.abs("amount_cents") * F.col("settlement_factor")).alias("amount_cents"),
        F.when(own_sign, F.col("discount_cents")).otherwise(-F.abs("discount_cents") * F.col("settlement_factor")).alias("discount_cents"),
    )


def pre_settlement_file(rows: DataFrame, windows: DataFrame, run_date: dt.date) -> DataFrame:
    """B-09, B-13: per merchant prefix a header, one amount per store, a count trailer."""
    stamp = f"_Presettlement_APM_{run_date - dt.timedelta(days=1):%Y%m%d}"
    name = F.concat(F.col("merchant"), F.lit(stamp))
    per = rows.groupBy(F.col("file_prefix").alias("merchant"), "store_id").agg(F.sum(F.col("amount_cents") + F.col("discount_cents")).alias("c"))
    detail = per.select(name.alias("file_name"), "merchant", "store_id", X.money_text(M.minor_to_major(F.col("c"))).alias("amount_in_dollar"))
    merchants = windows.where(X.non_blank(F.col("file_prefix"))).select(F.col("file_prefix").alias("merchant")).distinct()
    header = merchants.select(name.alias("file_name"), "merchant", F.lit("store_id").alias("store_id"), F.lit("amount_in_dollar").alias("amount_in_dollar"))
    counts = merchants.join(per.groupBy("merchant").agg(F.count("*").alias("n")), "merchant", "left")
    tail = counts.select(name.alias("file_name"), "merchant", F.coalesce("n", F.lit(0)).cast("string").alias("store_id"))
    return S.file_lines(header, detail, tail)


def merchant_name(prefix: str, company: Column) -> Column:
    return F.concat(F.lit(prefix), K.code_map(company, COMPANY_SUFFIX, F.lit("oth")), company)


def company_files(sap_map: DataFrame, prefix: str, run_ts: dt.datetime) -> DataFrame:
    """J-19: company codes with their stable sequence and file name."""
    seq = S.entity_sequence(sap_map.where(X.norm_key(F.coalesce("active_flag", F.lit("N"))) != "N"), "company_code")
    return seq.withColumn("file_name", S.stamped_name(prefix, run_ts, F.col("entity_seq")))


def open_rows(std: DataFrame, partner: bool) -> DataFrame:
    """Rows without a result file, of partners or of everyone else."""
    is_partner = F.col("tran_uid").startswith("QP")
    return std.where(F.col("setlmnt_result_file").isNull() & (is_partner if partner else ~is_partner))


def ledger_places(store: DataFrame, windows: DataFrame, sap_map: DataFrame, run_ts: dt.datetime, prefix: str = "LEDGER") -> DataFrame:
    """What the lines of a store's rows need: its division's window, its mapping and its commission store's, its file."""
    mapped = sap_map.where(X.norm_key(F.coalesce("active_flag", F.lit(""))) != "N")
    rows = J.lookup(store.select("store_id", "division"), windows, {"division": "division"}, ["division_type", "commission_store"], "inner")
    keys = {"company_code": "company_code", "merchant_organisation_id": "org", "merchant_store_number": "store_no", "customer_number": "customer", "currency_code": "currency"}
    rows = J.lookup(rows, mapped, {"store_number": "store_id"}, {**keys, "commission_percent": "pct", "commission_fixed": "fix"}, "inner")
    rows = J.lookup(rows, mapped, {"store_number": "commission_store"}, {k: v + "_c" for k, v in keys.items()})
    return J.lookup(rows, company_files(sap_map, prefix, run_ts), {"company_code": "company_code"}, ["file_name"], "inner")


def ledger_detail(std: DataFrame, store: DataFrame, windows: DataFrame, sap_map: DataFrame, run_ts: dt.datetime, prefix: str = "LEDGER") -> DataFrame:
    """Settlement and commission per row, with both customers' keys."""
    return placed_detail(std, ledger_places(store, windows, sap_map, run_ts, prefix))


def placed_detail(std: DataFrame, places: DataFrame) -> DataFrame:
    """``ledger_detail`` of stores' ``places``: all but the rows is joined before, so the rows are joined once."""
    named = places.where(F.col("company_code").isNotNull() & F.col("file_name").isNotNull())  # all are: details and trailers read the same lines, by one plan
    rows = J.lookup(open_rows(std, partner=False), named, {"store_id": "store_id"}, [c for c in places.columns if c != "store_id"], "inner")
    amount = M.minor_to_major(F.coalesce("settlement_cents", F.lit(0)) + F.coalesce("discount_cents", F.lit(0)))
    fee = M.service_fee(M.commission_flag(F.col("commission_store"), F.col("transaction_type")), amount, F.col("pct"), F.col("fix"))
    order = F.when(X.non_blank(F.col("order_number")) & (F.col("division_type") == "INTERNAL"), F.col("order_number"))
    return rows.select("*", fee.alias("commission"), (amount.cast(M.MONEY) - fee).alias("net"), order.alias("order_ref"), F.col("transaction_timestamp").cast("date").alias("day"))


def ledger_lines(detail: DataFrame) -> DataFrame:
    """D-10, G-08: one settlement and one commission line per key, zero sums left out.

    Both line kinds come from one scan: each row is unpivoted to its two postings, of which those
    without an amount add nothing.
    """
    posting = F.array(
        F.struct(F.col("org").alias("org"), F.col("store_no").alias("store_no"), F.col("customer").alias("customer"), F.col("store_id").alias("location"), F.col("currency").alias("currency"), F.lit("settlement").alias("line"), F.col("net").alias("amount")),
        F.struct(F.col("org_c").alias("org"), F.col("store_no_c").alias("store_no"), F.col("customer_c").alias("customer"), F.col("commission_store").alias("location"), F.col("currency_c").alias("currency"), F.lit("commission").alias("line"), F.col("commission").alias("amount")),
    )
    rows = detail.select("file_name", "company_code", "record_type", "day", "order_ref", F.explode(posting).alias("p")).select("file_name", "company_code", F.col("record_type").alias("kind"), "day", "order_ref", "p.*").where(F.col("amount") != 0)
    keys = ["file_name", "company_code", "kind", "line", "org", "store_no", "customer", "location", "currency", "day", "order_ref"]
    summed = rows.groupBy(*keys).agg(F.sum("amount").alias("total")).where(F.col("total") != 0)
    return summed.withColumn("amount_cents", F.round(F.col("total") * 100, 0).cast("long")).drop("total")


def ledger_file(lines: DataFrame, sap_map: DataFrame, run_ts: dt.datetime, prefix: str = "LEDGER") -> DataFrame:
    """B-09, D-16: header, detail and trailer of every company; the trailer counts details."""
    companies = company_files(sap_map, prefix, run_ts).withColumn("merchant", merchant_name("ledgersettlement", F.col("company_code")))
    detail = J.lookup(lines, companies, {"company_code": "company_code"}, ["merchant"], "inner")
    header = companies.select("file_name", "merchant", "company_code")
    tail = S.trailer(lines, ["file_name"], F.col("amount_cents"), "line_count", "amount_cents")
    tail = header.join(tail, "file_name", "left").withColumn("line_count", F.coalesce("line_count", F.lit(0))).withColumn("amount_cents", F.coalesce("amount_cents", F.lit(0)))
    return S.file_lines(header, detail, tail)


def partner_rows(partner: DataFrame, store: DataFrame, windows: DataFrame, sap_map: DataFrame, factors: DataFrame, settled: DataFrame, run_date: dt.date) -> DataFrame:
    """Partner gift-card rows that join the settlement table: new, first copy, inside the window."""
    kept = partner.where(X.norm_key(F.col("transaction_type")).isin("ACTIVATION", "CANCELLATION") & X.non_blank(F.col("merchant")))
    kept = kept.where((F.coalesce("amount_cents", F.lit(0)) != 0) | (F.coalesce("discount_cents", F.lit(0)) != 0))
    kept = kept.withColumn("tran_uid", K.partner_uid(F.col("invoice_number"), F.col("card_number"), F.col("transaction_type"), F.col("transaction_date")))
    kept = J.left_anti(kept, settled, ["tran_uid"])
    first = W.keep_first(kept, ["tran_uid"], [F.col("load_time"), F.col("amount_cents"), F.col("discount_cents"), F.col("store_id"), F.col("merchant"), F.col("line_no")])
    rows = J.lookup(first, store.where(~F.col("is_closed")), {"store_id": "store_id"}, ["division", "is_online"], "inner")
    rows = J.lookup(rows, windows.where(F.col("is_active") == "Y"), {"division": X.norm_key(F.col("division"))}, ["last_execution_time", "days_lookback", "earliest_date", "day_lag", "settlement_cutoff"], "inner")
    mapped = sap_map.where((X.norm_key(F.coalesce("active_flag", F.lit("N"))) != "N") & X.non_blank(F.col("company_code")))
    rows = J.lookup(rows, mapped, {"store_number": "store_id"}, [], "inner")
    own = factors.where((F.col("settlement_factor") != 0) & (F.col("tran_qualifier") == "QP"))
    rows = J.lookup(rows, own, {"transaction_type": X.norm_key(F.col("transaction_type"))}, ["settlement_factor", "record_type"], "inner")
    ts = F.coalesce("transaction_date", F.lit("1900-01-01").cast("timestamp_ntz"))
    inside = K.in_settlement_window(ts, F.col("last_execution_time"), F.col("days_lookback"), F.col("earliest_date"), F.lit(run_date), F.col("day_lag"), F.col("settlement_cutoff"))
    return rows.where(inside).select(
        "tran_uid",
        ts.alias("transaction_timestamp"),
        "store_id",
        X.norm_key(F.col("division")).alias("division"),
        F.when(F.upper("is_online") == "ONLINE", F.trim("invoice_number")).otherwise("").alias("order_number"),
        (F.abs("amount_cents") * F.col("settlement_factor")).alias("settlement_cents"),
        "record_type",
        (-F.abs("discount_cents") * F.col("settlement_factor")).alias("discount_cents"),
    )


def wallet_rows(apm: DataFrame, store: DataFrame, windows: DataFrame, sap_map: DataFrame, factors: DataFrame, settled: DataFrame, findings: DataFrame, run_date: dt.date) -> DataFrame:
    """Wallet rows that join the settlement table; divisions with open findings are held back."""
    rows = J.lookup(apm_source(apm), store.where(~F.col("is_closed")), {"store_id": "store_id"}, ["division"], "inner")
    rows = J.lookup(rows, windows.where(F.col("is_active") == "Y"), {"division": X.norm_key(F.col("division"))}, ["last_execution_time", "earliest_date", "day_lag", "settlement_cutoff"], "inner")
    mapped = sap_map.where(X.norm_key(F.coalesce("active_flag", F.lit(""))) != "N")
    rows = J.lookup(rows, mapped, {"store_number": "store_id"}, [], "inner")
    own = factors.where((F.col("settlement_factor") != 0) & (F.col("tran_qualifier") == ""))
    rows = J.lookup(rows, own, {"transaction_type": "kind"}, ["settlement_factor", "record_type"], "inner")
    rows = J.left_anti(rows, settled, ["tran_uid"])
    held = findings.where(X.non_blank(F.col("division"))).select("division")
    rows = J.left_anti(rows.withColumn("division", X.norm_key(F.col("division"))), held, ["division"])
    blocked = findings.agg(F.count_if(~X.non_blank(F.col("division")) | F.col("message").startswith("Duplicate"))).scalar()
    at = F.col("transaction_time")
    after = at > F.coalesce("last_execution_time", F.lit("1900-01-01").cast("timestamp_ntz"))
    before = at <= D.cutoff_on(F.date_add(F.lit(run_date), F.col("day_lag")), F.col("settlement_cutoff"))
    rows = rows.where((blocked == 0) & after & before)
    return rows.select(
        "tran_uid", F.col("transaction_time").alias("transaction_timestamp"), "store_id", "division", (F.abs("amount_cents") * F.col("settlement_factor")).alias("settlement_cents"), "record_type"
    )


def transaction_listing(switch: DataFrame, tran_type: DataFrame, response: DataFrame, store: DataFrame, windows: DataFrame, sap_map: DataFrame, identity: DataFrame, day: dt.date, width: int = 5) -> DataFrame:
    """Transaction listing rows of one local day: masked card, identity lookup, first copy."""
    nxt = day + dt.timedelta(days=1)
    at = F.col("tstamp_local")
    rows = switch.where((at >= F.lit(day).cast("timestamp_ntz")) & (at < F.lit(nxt).cast("timestamp_ntz")) & X.non_blank(F.col("proc_id_iss_b")))
    rows = J.lookup(rows, response.where(F.col("action_code") != "902"), {"action_code": "act_code"}, ["approval_flag"], "inner")
    rows = J.lookup(rows, tran_type.select(F.col("dn_tran_code").try_cast("int").alias("c"), "abbr"), {"c": F.col("tran_type_id").try_cast("int")}, ["abbr"], "inner")
    rows = J.lookup(rows, store.withColumn("__id", X.norm_key(F.col("store_id"))), {"__id": K.store_of_terminal(F.col("net_term_id"), width)}, {"store_id": "store_id", "division": "division", "is_online": "is_online"}, "inner")
    rows = J.lookup(rows, windows.where(X.non_blank(F.col("file_prefix"))), {"division": X.norm_key(F.col("division"))}, {"file_prefix": "merchant"}, "inner")
    rows = rows.withColumn("card_id", K.card_id(token=F.col("scdr_token")))
    known = identity.groupBy("card_id").agg(F.max("par").alias("__par"), F.max("pan_alias").alias("__alias"))
    rows = rows.join(known, "card_id", "left")
    rows = W.keep_first(rows, ["tran_uid"], [F.col("store_id"), F.col("transaction_total"), F.col("masked_pan"), F.col("tstamp_local"), F.col("act_code")])
    rows = J.lookup(rows, sap_map, {"store_number": "store_id"}, {"merchant_store_number": "merchant_store_id"})
    return rows.select(
        F.concat(F.col("merchant"), F.lit(f"_Txn_Listing_{day:%Y%m%d}")).alias("file_name"),
        "merchant",
        F.lit("D").alias("record_type"),
        K.tran_uid("TC", F.col("tran_uid")).alias("transaction_uid"),
        "store_id",
        F.col("net_term_id").alias("terminal_id"),
        F.abs(F.coalesce("transaction_total", F.lit(0))).cast("string").alias("transaction_amt"),
        F.date_format("tstamp_trans", "yyyyMMddHHmmss").alias("transaction_timestamp"),
        X.mask_pan(F.col("masked_pan")).alias("pan"),
        "mti",
        F.abs(F.coalesce("purchase_total", F.lit(0))).cast("string").alias("sale_amt"),
        F.abs(F.coalesce("cashout_total", F.lit(0))).cast("string").alias("cashout_amt"),
        X.norm_key(F.col("abbr")).alias("transaction_type_desc"),
        K.scheme_of(F.col("proc_id_iss_b"), F.col("inst_id_recon_iss")).alias("scheme"),
        F.when(X.norm_key(F.col("card_type")) == "C", "CREDIT").otherwise("DEBIT").alias("card_type"),
        F.when(F.col("approval_flag") == "Y", "1").otherwise("0").alias("approval_status"),
        F.when(F.upper("is_online") == "ONLINE", F.col("order_number")).otherwise("").alias("order_num"),
        X.norm_key(F.coalesce("merchant_store_id", F.lit(""))).alias("merchant_store_id"),
        F.coalesce("__par", "pymt_acct_ref").alias("par"),
        F.coalesce("__alias", "scdr_token").alias("pan_alias"),
    )


def partner_posting(std: DataFrame, store: DataFrame, sap_map: DataFrame, calendar: DataFrame, run_ts: dt.datetime, frequency: str = "WEEKLY") -> DataFrame:
    """Partner fees per store and day: net recovery and partner discount, one aggregate (G-08), due
    after the fiscal period's end."""
    rows = J.lookup(open_rows(std, partner=True), store.where(~F.col("is_closed")), {"store_id": "store_id"}, ["site_name", "company"], "inner")
    mapped = sap_map.where(X.norm_key(F.coalesce("active_flag", F.lit(""))) != "N")
    rows = J.lookup(rows, mapped, {"store_number": "store_id"}, ["company_code", "merchant_organisation_id", "merchant_store_number", "customer_number", "currency_code"], "inner")
    rows = J.lookup(rows, company_files(sap_map, "FEES", run_ts), {"company_code": "company_code"}, ["file_name"], "inner")
    day = F.col("transaction_timestamp").cast("date")
    keys = ["file_name", "company_code", "merchant_organisation_id", "merchant_store_number", "site_name", "customer_number", "store_id", "currency_code"]
    per = rows.groupBy(*keys, day.alias("calendar_date")).agg(
        F.sum(F.col("settlement_cents") + F.col("discount_cents")).alias("net"), F.sum("discount_cents").alias("discount"), F.count("*").alias("record_count")
    )
    ends = calendar.select("calendar_date", "fp_end_date")
    per = J.lookup(per, ends, {"calendar_date": "calendar_date"}, ["fp_end_date"])
    per = per.withColumn("pay_due_date", F.date_format(K.due_pay_date(F.col("fp_end_date")), "yyyyMMdd")).withColumn("frequency", F.lit(frequency))
    keep = [*keys, "calendar_date", "record_count", "pay_due_date", "frequency"]
    return R.lenses(per, keep, "fee_type", "fee_value", {"GCNETRECOVERY": F.col("net"), "GCPARTNERDISC": F.col("discount")})


def partner_posting_file(detail: DataFrame, sap_map: DataFrame, run_ts: dt.datetime) -> DataFrame:
    companies = company_files(sap_map, "FEES", run_ts).withColumn("merchant", merchant_name("partnerfeeposting", F.col("company_code"))).select("file_name", "merchant", "company_code")
    tail = S.trailer(detail, ["file_name"], F.col("fee_value"), "line_count", "fee_value")
    tail = companies.join(tail, "file_name", "left").withColumn("line_count", F.coalesce("line_count", F.lit(0))).withColumn("fee_value", F.coalesce("fee_value", F.lit(0)))
    return S.file_lines(companies, J.lookup(detail, companies, {"company_code": "company_code"}, ["merchant"], "inner"), tail)


def commission_listing(std: DataFrame, store: DataFrame, windows: DataFrame, sap_map: DataFrame) -> DataFrame:
    """Commission per settled transaction of divisions with a commission store, H/D/T."""
    settled = J.lookup(std.where(X.non_blank(F.col("setlmnt_result_file"))), store, {"store_id": "store_id"}, ["division"], "inner")
    rows = J.lookup(settled, windows.where(X.non_blank(F.col("commission_store")) & X.non_blank(F.col("file_prefix"))), {"division": "division"}, {"file_prefix": "merchant", "commission_store": "commission_store"}, "inner")
    mapped = sap_map.where((X.norm_key(F.coalesce("active_flag", F.lit(""))) != "N") & (X.non_blank(F.col("commission_percent")) | X.non_blank(F.col("commission_fixed"))))
    rows = J.lookup(rows, mapped, {"store_number": "store_id"}, {"commission_percent": "pct", "commission_fixed": "fix"}, "inner")
    amount = M.minor_to_major(F.col("settlement_cents") + F.col("discount_cents"))
    fee = M.service_fee(M.commission_flag(F.col("commission_store"), F.col("transaction_type")), amount, F.col("pct"), F.col("fix"))
    detail = rows.select("merchant", "tran_uid", F.round(fee * 100, 0).cast("long").cast("string").alias("commission_amt"))
    tail = S.trailer(detail, ["merchant"], None, "n").select("merchant", F.col("n").cast("string").alias("tran_uid"))
    header = tail.select("merchant", F.lit("tran_uid").alias("tran_uid"), F.lit("commission_amt").alias("commission_amt"))
    return S.file_lines(header, detail, tail)


def payout_instructions(lines: DataFrame, store: DataFrame, windows: DataFrame, run_ts: dt.datetime, zone: str = "Australia/Sydney") -> DataFrame:
    """Sum per store and day for direct-payout divisions; weekend runs start Monday 10:00 local."""
    rows = J.lookup(lines, store, {"store_id": "location"}, ["division"], "inner")
    direct = windows.where(F.col("division_type") == "ISO")
    rows = J.lookup(rows, direct, {"division": X.norm_key(F.col("division"))}, ["commission_store"], "inner")
    rows = rows.where(~F.col("location").eqNullSafe(F.col("commission_store")))
    monday = run_ts.date() + dt.timedelta(days=7 - run_ts.weekday())
    start = D.utc_from_local(D.at(dt.datetime.combine(monday, dt.time(10))), zone)
    per = rows.groupBy("division", "location", "day", F.col("file_name").alias("batch_name")).agg(F.sum("amount_cents").alias("amount"))
    return per.select(
        "division",
        F.concat(F.col("location"), F.date_format("day", "yyyyMMdd"), F.lit(run_ts.strftime("%Y-%m-%dT%H:%M:%S"))).alias("merchant_payment_uid"),
        "amount",
        "batch_name",
        D.at(run_ts).alias("batch_datetime"),
        (start if run_ts.weekday() >= 5 else F.lit(None).cast("timestamp_ntz")).alias("payment_initiated_at"),
    )
