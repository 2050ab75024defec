"""Amounts, fees and ratios (C-17, C-18, D-09, fee formulas).  Money stays decimal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,4)"


def money(c: Column, kind: str = MONEY) -> Column:
    return c.cast(kind)


def minor_to_major(cents: Column, digits: int = 2) -> Column:
    """C-18: 100 (or 10^digits) minor units to one major unit, exact in decimal."""
    return (cents.cast("decimal(20,0)") * F.lit(10**-digits).cast(f"decimal({digits + 1},{digits})")).cast(
        f"decimal(24,{digits})"
    )


def ex_gst(amount: Column, rate: str = "1.1") -> Column:
    """C-18: tax-exclusive amount, as a double because the quotient has no finite scale."""
    return amount.cast("double") / F.lit(float(rate))


def signed(amount: Column, kind: Column, minus: Sequence[str]) -> Column:
    """C-17: amount turned negative for the named kinds."""
    return F.when(kind.isin(*minus), -amount).otherwise(amount)


def ratio(num: Column, den: Column, empty: float | None = 0.0) -> Column:
    """D-09: quotient of two sums, ``empty`` where the divisor is zero or null."""
    guarded = F.when(den != 0, num.cast("double") / den.cast("double"))
    return guarded if empty is None else F.coalesce(guarded, F.lit(empty))


def service_fee(flag: Column, amount: Column, percent: Column, fixed: Column) -> Column:
    """Commission: none when the flag is N, else percent of the amount plus a fixed part.

    The rule's text is not published; percent-plus-fixed is this engine's assumption.
    """
    pct = F.coalesce(percent.try_cast("decimal(9,4)"), F.lit(0).cast("decimal(9,4)"))
    fix = F.coalesce(fixed.try_cast("decimal(18,4)"), F.lit(0).cast("decimal(18,4)"))
    fee = amount.cast(MONEY) * pct / F.lit(100).cast("decimal(3,0)") + fix
    return F.when(flag == "N", F.lit(0).cast(MONEY)).otherwise(F.round(fee, 4).cast(MONEY))


def commission_flag(commission_store: Column, tran_type: Column) -> Column:
    """Commission is due unless there is no commission store or the row is a plain refund."""
    kind = F.upper(F.trim(F.coalesce(tran_type, F.lit(""))))
    return (
        F.when(F.coalesce(commission_store, F.lit("")) == "", "N")
        .when(kind.contains("REVERSAL"), "Y")
        .when(kind.contains("REFUND"), "N")
        .otherwise("Y")
    )


def processing_fee(code: Column, amount: Column, percent: Column, fixed: Column) -> Column:
    """ALL is percent plus fixed, FIXED and PERCENT are one part, anything else is free."""
    part = amount.cast("double") * percent.cast("double") / 100
    flat = fixed.cast("double")
    return (
        F.when(code == "ALL", part + flat)
        .when(code == "FIXED", flat)
        .when(code == "PERCENT", part)
        .otherwise(F.lit(0.0))
    )
