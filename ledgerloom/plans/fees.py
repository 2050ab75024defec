"""Fee listings, scheme-fee analysis, direct-entry files and reply files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions import cards as K
from ledgerloom.functions import dates as D
from ledgerloom.functions import money as M
from ledgerloom.functions import text as X
from ledgerloom.operators import joins as J
from ledgerloom.operators import rollup as R
from ledgerloom.operators import windows as W
from ledgerloom.sinks import files as S
from ledgerloom.sources import text_files as TF
from ledgerloom.sources.tables import local_table

# fixed values: issuers whose card type is known without a card type code
ISSUER_CARD_TYPE = {"EHB": "Debit", "AMEX": "Credit", "FDF": "Debit", "FDI": "Credit", "RED": "Credit"}


def listing_days(run_date: dt.date, last_file_date: dt.date | None) -> list[dt.date]:
    """E-09, A-18: the day four days back; after missed runs every day since the last listing."""
    lag = run_date - dt.timedelta(days=4)
    if last_file_date is None or (run_date - last_file_date).days <= 1:
        return [lag]
    start = last_file_date - dt.timedelta(days=3)
    return [start + dt.timedelta(days=i) for i in range((lag - start).days + 1)]


def fee_listing(tables: Sequence[DataFrame], store: DataFrame, windows: DataFrame, days: Sequence[dt.date], width: int = 5) -> DataFrame:
    """Fee listing of several fee tables: masked card, text amounts, trailer per prefix and day.

    The listed days are one range on the time column where they are contiguous, so the scan
    reads only those days.
    """
    rows = tables[0]
    for t in tables[1:]:
        rows = rows.unionByName(t)
    first, last = min(days), max(days)
    at = F.col("tstamp_local")
    rows = rows.where((at >= F.lit(first).cast("timestamp_ntz")) & (at < F.lit(last + dt.timedelta(days=1)).cast("timestamp_ntz")))
    rows = rows.where(at.cast("date").isin(*days) & X.non_blank(F.col("proc_id_iss_b")) & (F.coalesce("act_code", F.lit("")) != "902"))
    rows = J.lookup(rows, store.withColumn("__id", X.norm_key(F.col("store_id"))), {"__id": K.store_of_terminal(F.col("net_term_id"), width)}, ["division"], "inner")
    rows = J.lookup(rows, windows.where(X.non_blank(F.col("file_prefix"))), {"division": X.norm_key(F.col("division"))}, {"file_prefix": "file_prefix"}, "inner")
    issuer = F.trim("proc_id_iss_b")
    scheme = F.coalesce(K.scheme_of(F.col("proc_id_iss_b"), F.col("inst_id_recon_iss")), issuer)
    card = F.when(F.col("card_type") == "C", "Credit").when(F.col("card_type").isin("D", "P"), "Debit").otherwise(K.code_map(issuer, ISSUER_CARD_TYPE, F.lit("Debit")))
    zero = F.lit("0.0000")
    interchange = F.when(issuer.isin("AMEX", "FDI"), zero).otherwise(F.coalesce(X.fixed_decimals(F.col("interchange_fee"), 4), zero))
    detail = rows.select(
        F.lit("D").alias("record_type"),
        F.col("net_term_id").alias("terminal_id"),
        X.fixed_decimals(F.col("transaction_total"), 4).alias("transaction_amt"),
        F.date_format("tstamp_trans", "yyyyMMddHHmmss").alias("transaction_timestamp"),
        X.mask_pan(F.col("masked_pan")).alias("pan"),
        X.zero_pad(F.col("order_number").cast("long"), 6).alias("stan"),
        "mti",
        scheme.alias("scheme"),
        card.alias("card_type"),
        interchange.alias("interchange_fee"),
        F.coalesce(X.fixed_decimals(F.col("processing_fees"), 4), zero).alias("processing_fee"),
        "file_prefix",
        at.cast("date").alias("tran_date"),
    )
    tail = S.trailer(detail, ["file_prefix", "tran_date"], None, "n").select(F.lit("T").alias("record_type"), F.col("n").cast("string").alias("terminal_id"), "file_prefix", "tran_date")
    return detail.unionByName(tail, allowMissingColumns=True)


# fixed values: the greatest amount and number of payments that a direct-entry trailer can hold
ENTRY_CENTS, ENTRY_LINES = 10**10 - 1, 10**6 - 1


def entry_files(payments: DataFrame, cents_limit: int = ENTRY_CENTS, lines_limit: int = ENTRY_LINES) -> DataFrame:
    """D-16: payments with the number of their file (from 0), so that no file's total or count outgrows its trailer.

    A payment above the limit becomes several.  If one file can't hold all, stores are dealt by their
    numbers without the last three digits; in each deal, in the order of the stores, a stretch of the
    limit's length on the running total is a file, and a payment across two stretches one of its own.
    """
    parts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("cents") - 1) / cents_limit).cast("long"))
    rows = payments.withColumn("part", F.explode(parts))
    rows = rows.withColumn("cents", F.least(F.lit(cents_limit).cast("long"), F.col("cents") - F.col("part") * cents_limit))
    fits = rows.agg((F.sum("cents") <= cents_limit) & (F.count("*") <= lines_limit)).scalar()
    deal = F.when(fits, "").otherwise(F.left("store_number", F.length("store_number") - 3))
    rows = rows.withColumn("__deal", deal)
    so_far = Window.partitionBy("__deal").orderBy("store_number", "part").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumns({"__upto": F.sum("cents").over(so_far), "__line": F.count("*").over(so_far)})
    stretches = [F.expr(f"({e}) div {n}").alias(c) for c, e, n in (("a", "__upto - cents", cents_limit), ("b", "__upto - 1", cents_limit), ("c", "__line - 1", lines_limit))]
    placed = placed.withColumn("__file", F.struct("__deal", *stretches))
    numbers = placed.agg(F.sort_array(F.collect_set("__file")).alias("__all")).select(F.posexplode("__all").alias("file_no", "__file"))
    return placed.join(numbers, "__file").drop("__file", "__deal", "__upto", "__line", "part")


def direct_entry(cleared: DataFrame, accounts: DataFrame, day: dt.date, sequence: int, user: str = "LEDGERLOOM") -> DataFrame:
    """B-10, J-18: fixed-width direct-entry lines of one day's cleared transactions.

    Amounts are summed per store; lines stay rows with a rank, so the file is written in
    parallel and no cell holds a whole file.  A day whose total or number of payments is too long
    for one trailer takes several files with successive numbers.
    """
    per = cleared.groupBy("store_number").agg(F.sum("cents").alias("cents"))
    per = per.where(F.col("cents") > 0)
    rows = J.lookup(per, accounts, {"store_number": "store_number"}, ["bsb", "account", "title"], "inner")
    rows = entry_files(rows)
    blank = lambda n: S.Slot(F.lit(""), n)
    detail = S.fixed_width_line(
        [
            S.Slot(F.lit("1"), 1),
            S.Slot(F.col("bsb"), 7),
            S.Slot(F.col("account"), 9, right=True),
            blank(1),
            S.Slot(F.lit("50"), 2),
            S.Slot(F.col("cents"), 10, right=True, fill="0"),
            S.Slot(F.col("title"), 32, cut=True),
            S.Slot(F.concat(F.col("store_number"), F.lit(f"{day:%y%m%d}")), 18),
        ]
    )
    header = S.fixed_width_line([S.Slot(F.lit("0"), 1), blank(17), S.Slot(F.lit("01"), 2), S.Slot(F.lit("BNK"), 3), blank(7), S.Slot(F.lit(user), 26, cut=True), S.Slot(F.lit(f"{day:%d%m%y}"), 6)])
    # the first file is there on a day without payments, too
    none = local_table(rows.sparkSession, "file_no int, cents long, n long", [(0, 0, 0)])
    totals = rows.select("file_no", "cents", F.lit(1).cast("long").alias("n")).unionByName(none)
    totals = totals.groupBy("file_no").agg(F.sum("cents").alias("cents"), F.sum("n").alias("n"))
    trailer = S.fixed_width_line(
        [S.Slot(F.lit("7"), 1), S.Slot(F.lit("999-999"), 7), blank(12), S.Slot(F.col("cents"), 10, right=True, fill="0"), S.Slot(F.col("cents"), 10, right=True, fill="0"), S.Slot(F.lit("0"), 10, right=True, fill="0"), blank(24), S.Slot(F.col("n"), 6, right=True, fill="0")]
    )
    name = F.concat(F.lit(f"DE.{day:%y%m%d}"), (F.col("file_no") + sequence).cast("string"))
    parts = [
        totals.select(name.alias("file_name"), F.lit(0).alias("line_rank"), F.lit("").alias("sort_key"), header.alias("line")),
        rows.select(name.alias("file_name"), F.lit(1).alias("line_rank"), F.col("store_number").alias("sort_key"), detail.alias("line")),
        totals.select(name.alias("file_name"), F.lit(2).alias("line_rank"), F.lit("").alias("sort_key"), trailer.alias("line")),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# fixed values: character ranges of the reply file's records
REPLY_HEADER_1 = [TF.Field("record_type", 0, 1), TF.Field("payment_reference", 1, 15, strip=True), TF.Field("reserved", 15, 22, strip=True)]
REPLY_HEADER_2 = [TF.Field("record_type", 0, 1), TF.Field("valid_items", 1, 7), TF.Field("failed_items", 7, 13)]
REPLY_DETAIL = [TF.Field("record_type", 0, 1), TF.Field("sequence_number", 1, 7), TF.Field("bsb", 7, 14), TF.Field("lodgement_reference", 68, 86, strip=True)]


def reply_records(lines: DataFrame, seen: DataFrame) -> dict[str, DataFrame]:
    """A-09, E-05, H-70: all three record types; details whose reference is known are skipped."""
    kind = F.substring("value", 1, 1)
    detail = TF.slice_fields(lines.where(kind == "2"), REPLY_DETAIL)
    return {
        "header_1": TF.slice_fields(lines.where(kind == "0"), REPLY_HEADER_1),
        "header_2": TF.slice_fields(lines.where(kind == "1"), REPLY_HEADER_2),
        "detail": J.left_anti(detail, seen, ["lodgement_reference"]),
    }


def weekly_extract(wallet: DataFrame, run_date: dt.date) -> DataFrame:
    """H-61, C-09: wallet rows of the last complete Thursday to Wednesday week."""
    start, end = D.last_complete_week(run_date)
    at = F.col("txn_time")
    return wallet.where((at >= F.lit(start).cast("timestamp_ntz")) & (at < F.lit(end + dt.timedelta(days=1)).cast("timestamp_ntz"))).withColumn("week_start", F.lit(start))


def _approved(c: Column) -> Column:
    """A missing status counts as approved."""
    return F.coalesce(c, F.lit(0)) == 0


def scheme_fee_report(acquirer: DataFrame, fees: DataFrame, store: DataFrame, rates: DataFrame, scheme: str, width: int = 5, with_rates: bool = True) -> DataFrame:
    """E-13, E-15, F-06: fee by trace id, else by terminal and amount, then the dated rate card.

    Both fee lookups are one row per key before they join, so no fee can multiply a
    transaction.
    """
    own = acquirer.where(F.upper("scheme") == scheme)
    known = fees.where(F.col("trace_id").isNotNull() & F.col("load_time").isNotNull())
    # of the newest load the greatest fee, in one aggregate
    newest = F.max(F.struct("load_time", "interchange_fee"))["interchange_fee"]
    by_trace = known.groupBy("trace_id", "transaction_amt").agg(newest.alias("fee"))
    by_terminal = fees.groupBy(F.upper("term_id").alias("term_id"), "transaction_amt").agg(F.min("interchange_fee").alias("fee"))
    ok = _approved(F.col("transaction_approval_status"))
    steps = [
        (by_trace, {"trace_id": F.when(ok, F.col("tran_uid")), "transaction_amt": "transaction_amount"}),
        (by_terminal, {"term_id": F.when(ok, F.upper("terminal_id")), "transaction_amt": "transaction_amount"}),
    ]
    rows = J.cascade_match(own, steps, "fee", step_out="match_step")
    dims = ["division", "company", "merchant_group", "invoice_group", "ratecard_group"]
    rows = J.lookup(rows, store.withColumn("__id", F.upper("store_id")), {"__id": F.upper(F.left("terminal_id", F.lit(width)))}, {"store_id": "store_id", **{d: d for d in dims}})
    day = D.timestamp_from_int(F.col("transaction_timestamp")).cast("date")
    rows = rows.withColumn("transaction_date", day)
    rows = J.range_lookup(rows, rates, {"merchant": F.upper("ratecard_group"), "card_type": F.upper("card_type")}, F.col("transaction_date"), "from_date", "to_date", ["proc_fee_code", "proc_fee_percent", "proc_fee_fixed"])
    amount = M.minor_to_major(F.col("transaction_amount")).cast("double")
    sign = F.when(F.upper("transaction_type") == "REFUND", -1.0).otherwise(1.0)
    fee = F.col("fee").cast("double") / 1000000
    return rows.select(
        "tran_uid",
        "transaction_date",
        "store_id",
        *dims[:4],
        "card_type",
        "transaction_type",
        (amount * sign).alias("tran_amt"),
        (fee / 1.1 * sign).alias("interchange_fee"),
        F.when(amount != 0, fee / amount).alias("calc_interchange"),
        M.processing_fee(F.col("proc_fee_code"), amount, F.col("proc_fee_percent"), F.col("proc_fee_fixed")).alias("processing_fees"),
        "match_step",
    )


def average_fee_report(detail: DataFrame, store: DataFrame, keys: Sequence[str], width: int = 5) -> DataFrame:
    """Average fee percent for credit and average fee for debit, sums of both in one aggregate."""
    rows = J.lookup(detail, store, {"store_id": F.left("net_term_id", F.lit(width))}, ["division", "company", "merchant_group", "invoice_group"])
    credit = F.col("card_type") == "C"
    amount, fee = F.sum("transaction_total"), F.sum("interchange_fee")
    out = rows.groupBy(*keys, "card_type").agg(amount.alias("amount_cents"), fee.alias("fee_micros"), F.count("*").alias("tran_count"))
    dollars = F.col("amount_cents").cast("double") / 100
    fees = F.col("fee_micros").cast("double") / 1000000
    pct = F.when(credit, M.ratio(fees, dollars) * 100).otherwise(0.0)
    avg = F.when(credit, 0.0).otherwise(M.ratio(fees, F.col("tran_count")))
    return out.select(*keys, "card_type", pct.alias("avg_fee_percent"), avg.alias("average_fee"), dollars.alias("total_amount"), fees.alias("total_fees"), "tran_count")


def signed_fee_rows(switch: DataFrame, store: DataFrame, sap_map: DataFrame, width: int = 5) -> DataFrame:
    """C-17, C-18: signed amount by processing code and reversal, fee rate, dimensions."""
    code = F.left(F.lpad("tran_type_id", 2, "0"), F.lit(2))
    reversal = F.col("mti") == "1440"
    amount = F.col("transaction_total").cast("double") / 100
    negative = ((code == "00") & reversal) | ((code == "20") & ~reversal)
    fee = F.col("interchange_fee").cast("double") / 1000000
    rows = J.lookup(switch, store, {"store_id": F.left("net_term_id", F.lit(width))}, {"store_id": "store_id", "division": "division", "brand": "brand", "company": "company"})
    rows = J.lookup(rows, sap_map, {"store_number": F.left("net_term_id", F.lit(width))}, ["currency_code"])
    return rows.select(
        "tran_uid", "mti", "store_id", "division", "brand", "company", "currency_code",
        F.when(negative, -amount).otherwise(amount).alias("tran_amt"), fee.alias("interchange_fee"), F.when(amount != 0, fee / amount).alias("calc_interchange_fee"),
        K.code_map(code, TRAN_LABELS).alias("tran_type"),
    )


# fixed values: label of a two-digit processing code
TRAN_LABELS = {
    "00": "Purchase",
    "01": "Cashout",
    "02": "Debit adjustment",
    "09": "Purchase with Cashout",
    "11": "Cash",
    "20": "Refund",
    "21": "Deposit",
    "22": "Credit Adjustment",
}


def unit_converted(switch: DataFrame, store: DataFrame, columns: Sequence[str], keep: Sequence[str], width: int = 5) -> DataFrame:
    """C-18, E-02: minor units to doubles plus the store dimension."""
    rows = J.lookup(switch, store, {"store_id": F.left("net_term_id", F.lit(width))}, ["store_id", "division", "company", "is_online"])
    return rows.select(*keep, *[(F.col(c).cast("double") / 100).alias(c) for c in columns], "store_id", "division", "company", "is_online")


def combined_fees(parts: Sequence[DataFrame], scheme_fees: DataFrame, since: dt.date, fee_keys: Sequence[str]) -> DataFrame:
    """G-05, E-02: fee rows of several tables since a day, with the scheme fee of their keys (Q10)."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    rows = rows.where(F.col("tstamp_trans") >= F.lit(since).cast("timestamp_ntz"))
    return rows.join(J.unique_or_fail(scheme_fees, list(fee_keys), "scheme fee"), list(fee_keys), "left")


def quality_union(parts: Sequence[DataFrame], required: Sequence[str]) -> DataFrame:
    """G-05, C-06: union of fee tables, rows with a blank required field left out."""
    rows = parts[0]
    for p in parts[1:]:
        rows = rows.unionByName(p, allowMissingColumns=True)
    for c in required:
        rows = rows.where(X.non_blank(F.col(c)))
    return rows


def declined_summary(billing: DataFrame, store: DataFrame, response_text: DataFrame, since: dt.date) -> DataFrame:
    """Declined transactions by store, scheme, reason and Monday week (G-05, H-58)."""
    rows = billing.where((F.col("approval") == "D") & (F.col("tran_date") >= F.lit(since)))
    per = rows.groupBy("store_id", "scheme", "declined_reason", D.monday_week_start(F.col("tran_date")).alias("week_start")).agg(F.count("*").alias("declined_count"), F.sum("amount_cents").alias("declined_cents"))
    per = J.lookup(per, store, {"store_id": "store_id"}, ["merchant_group", "brand"])
    return J.lookup(per, response_text, {"action_code": "declined_reason"}, ["approval_flag"]).withColumn("week_end", F.date_add("week_start", 6))


def gift_tax_lines(gift: DataFrame, merchants: str) -> DataFrame:
    """Discount of three percent and its tax on rows of matching merchants."""
    rows = gift.where(F.col("merchant").like(merchants))
    amount = M.minor_to_major(F.col("amount_cents"))
    discount = amount.cast("decimal(24,4)") * F.lit("0.03").cast("decimal(3,2)")
    return rows.select(
        "card_number", "merchant", "transaction_date", "transaction_type", F.lit("3%").alias("discount"), amount.alias("amount"),
        discount.alias("discount_value"), (discount * F.lit("0.15").cast("decimal(3,2)")).alias("gst_value"), (amount - discount).alias("net_value"),
    )


def partner_ledger(rows: DataFrame, day: str, codes: dict[str, str], accounts: dict[str, str], discount: Column | None = None) -> DataFrame:
    """G-09, H-57: activation and discount lines per day and merchant with coded references.

    ``codes`` and ``accounts`` map a merchant's name prefix to its reference code and customer
    account.  One aggregate feeds both lines.
    """
    m = F.col("merchant")

    def by_prefix(table: dict[str, str]) -> Column:
        out: Column | None = None
        for prefix, v in table.items():
            out = F.when(m.startswith(prefix), v) if out is None else out.when(m.startswith(prefix), v)
        assert out is not None
        return out

    off = F.col("discount_cents") if discount is None else discount
    per = rows.where(F.col(day).isNotNull()).groupBy("merchant", F.col(day).cast("date").alias("day")).agg(F.sum("amount_cents").alias("a"), F.sum(off).alias("d"))
    stamp = D.day_month_iso_year(F.col("day"))
    text = F.concat(m, F.lit(" "), F.date_format("day", "dd-MM-"), D.iso_year2(F.col("day")))

    def line(kind: str, account: str, profit: str, cost: str, amount: Column) -> dict[str, Column]:
        return {
            "reference_no": F.concat(by_prefix(codes), stamp, F.lit(kind)),
            "customer_account": by_prefix(accounts),
            "gl_account": F.lit(account),
            "customer_text": text,
            "profit_centre": F.lit(profit),
            "cost_centre": F.lit(cost),
            "amount": M.minor_to_major(amount),
        }

    return R.ledger_lines(per, ["merchant", "day"], [line("ACT", "204743", "5975", "", F.col("a")), line("DIS", "699200", "", "9876", -F.col("d"))])
