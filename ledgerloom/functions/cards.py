"""Routines over card and transaction codes (2.K), all native columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom.functions import dates as D
from ledgerloom.functions import text as X

# fixed values: issuer processor code to scheme name
SCHEME_BY_PROCESSOR = {
    "AMEX": "AMEX",
    "EHB": "EFTPOS",
    "FDF": "FUEL CARDS",
    "RED": "GIFT CARDS",
    "VDCS": "VISA",
    "MC": "MASTERCARD",
}

# fixed values: gift-card processor renames of the transaction kind
GIFT_RENAMES = {
    "PURCHASE": "REDEMPTION",
    "REFUND": "ACTIVATION",
    "BALANCE INQUIRY - SAVINGS": "BALANCE INQUIRY",
}

# fixed values: transaction kinds counted as plus and as minus when netting reversals
PURCHASE_PLUS = ["PURCHASE", "PURCHASE WITH CASHOUT", "REDEMPTION", "REFUND REVERSAL"]
PURCHASE_MINUS = ["PURCHASE REVERSAL", "PURCHASE WITH CASHOUT REVERSAL", "REDEMPTION REVERSAL"]
AMOUNT_MINUS = PURCHASE_MINUS + ["REFUND"]
PAYOUT_PLUS = PURCHASE_PLUS + ["CASHOUT"]
PAYOUT_MINUS = PURCHASE_MINUS + ["REFUND", "ACTIVATION", "CASHOUT REVERSAL"]

# fixed values: card type shown for schemes that have only one
CARD_TYPE_BY_SCHEME = {
    "DINERS": "CREDIT",
    "AMEX": "CREDIT",
    "EFTPOS": "DEBIT",
    "FUEL CARDS": "FUEL CARDS",
    "GIFT CARDS": "GIFT CARDS",
    "PAYPAL": "APM",
    "ALIPAY": "APM",
    "UPI": "CREDIT",
}


def code_map(c: Column, table: dict[str, str], default: Column | None = None) -> Column:
    """C-04: simple CASE from a code table."""
    out: Column | None = None
    for code, value in table.items():
        out = F.when(c == code, value) if out is None else out.when(c == code, value)
    assert out is not None
    return out if default is None else out.otherwise(default)


def scheme_of(processor: Column, institution: Column, upi: tuple[str, ...] = ("I0", "UPI")) -> Column:
    """Scheme from the issuer processor; two processors also need the institution."""
    p = X.norm_key(processor)
    is_upi = X.norm_key(institution).isin(*upi)
    return (
        F.when(p == "FDI", F.when(is_upi, "UPI").otherwise("DINERS"))
        .when(p == "ANZ", F.when(is_upi, "UPI").otherwise("ACCOUNT"))
        .otherwise(code_map(p, SCHEME_BY_PROCESSOR))
    )


def calc_tran_type(processor: Column, abbr: Column, mti: Column) -> Column:
    """Transaction kind: gift-card renames, then ' REVERSAL' for message type 1440."""
    kind = X.norm_key(abbr)
    renamed = F.when(X.norm_key(processor) == "RED", code_map(kind, GIFT_RENAMES, kind)).otherwise(kind)
    return F.concat(renamed, F.when(mti == "1440", " REVERSAL").otherwise(""))


def scheme_card_type(scheme: Column, card_type: Column) -> Column:
    """Card type by scheme; only the two big schemes carry their own."""
    own = F.when(card_type.isin("CREDIT", "DEBIT"), card_type).otherwise("")
    return F.when(scheme.isin("MASTERCARD", "VISA"), own).otherwise(code_map(scheme, CARD_TYPE_BY_SCHEME))


def tran_uid(source: str, *parts: Column) -> Column:
    """Stable id: source prefix and the source's own key parts, NULL spelled out."""
    return F.concat_ws("_", F.lit(source), *[F.coalesce(p.cast("string"), F.lit("NULL")) for p in parts])


def wallet_uid(ref: Column, day: Column, hhmmss: Column) -> Column:
    """LK_<reference>_<yyyyMMdd>T<HHmmss>."""
    stamp = F.concat(
        F.coalesce(F.date_format(day, "yyyyMMdd"), F.lit("19000101")),
        F.lit("T"),
        F.coalesce(F.replace(hhmmss, F.lit(":"), F.lit("")), F.lit("000000")),
    )
    return tran_uid("LK", ref, stamp)


def partner_uid(invoice: Column, pan: Column, kind: Column, ts: Column) -> Column:
    """QP_<invoice>_<masked card>_<KIND>_<stamp>."""
    return tran_uid(
        "QP",
        F.coalesce(F.trim(invoice), F.lit("Null")),
        X.mask_pan_keep_length(pan),
        X.norm_key(kind),
        F.coalesce(D.compact_stamp(ts), F.lit("19000101T000000")),
    )


def card_id(
    token: Column | None = None,
    customer_ref: Column | None = None,
    container_id: Column | None = None,
    item_id: Column | None = None,
    gift_card: Column | None = None,
) -> Column:
    """Card identity text per source; null when its own parts are missing."""
    options: list[Column] = []
    if token is not None:
        options.append(F.concat(F.lit("SCDR|"), token))
    if customer_ref is not None and container_id is not None and item_id is not None:
        options.append(
            F.concat(
                F.lit("customerRef|"), customer_ref,
                F.lit("|containerId|"), container_id,
                F.lit("|itemId|"), item_id,
            )
        )
    if gift_card is not None:
        options.append(F.concat(F.lit("CardNumber|"), gift_card))
    return F.coalesce(*options)


def gift_store(*candidates: Column, width: int = 5) -> Column:
    """First usable outlet text, cut to the store code; lookup order is the argument order."""
    return F.left(X.norm_key(X.first_non_blank(*candidates)), F.lit(width))


def due_pay_date(period_end: Column, weekday: str = "FRI") -> Column:
    """Next given weekday after the fiscal period's end (assumed rule)."""
    return F.next_day(period_end, weekday)


def store_of_terminal(terminal: Column, width: int = 5) -> Column:
    """The store code is the head of the terminal id."""
    return F.upper(F.left(F.trim(terminal), F.lit(width)))


def settlement_floor(last_execution: Column, lookback_days: Column) -> Column:
    """L-03: start of the day ``lookback`` days after the last run; open when never run."""
    return F.when(last_execution.isNull(), F.lit("1900-01-01").cast("timestamp_ntz")).otherwise(
        F.date_add(last_execution.cast("date"), lookback_days).cast("timestamp_ntz")
    )


def in_settlement_window(
    ts: Column,
    last_execution: Column,
    lookback_days: Column,
    earliest: Column,
    run_date: Column,
    day_lag: Column,
    cutoff_hhmm: Column,
) -> Column:
    """L-03: newer than the last run's floor, not before the first day, up to the cut-off."""
    return (
        (ts > settlement_floor(last_execution, lookback_days))
        & (ts >= earliest.cast("timestamp_ntz"))
        & (ts <= D.cutoff_on(F.date_add(run_date, day_lag), cutoff_hhmm))
    )


# fixed values: column lists of the fee-listing layouts, by layout version
FEE_LAYOUTS = {
    "v1": ["merchant", "store_id", "tran_date", "masked_pan", "amount", "fee_percent"],
    "v2": ["merchant", "store_id", "tran_date", "masked_pan", "amount", "fee_percent", "scheme", "settlement_date"],
}


def layout_columns(version: str) -> list[str]:
    return FEE_LAYOUTS[version]
