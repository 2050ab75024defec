"""Text column functions (S-01..S-25, H-50..H-54, H-66..H-71)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm_key(c: Column) -> Column:
    """E-16: the one normal form used on both sides of a text join."""
    return F.upper(F.trim(c))


def blank_to_null(c: Column) -> Column:
    """C-06: null and blank text are the same thing to every filter."""
    return F.when(F.trim(c) != "", c)


def non_blank(c: Column) -> Column:
    return F.coalesce(F.trim(c), F.lit("")) != ""


def first_non_blank(*cols: Column) -> Column:
    return F.coalesce(*[blank_to_null(c) for c in cols])


def null_text_to_null(c: Column, marker: str = "NULL") -> Column:
    """C-20: text that spells the word NULL."""
    return F.when(norm_key(c) != marker, c)


def sentinel_to_null(names: Sequence[str], sentinel: float) -> list[Column]:
    """C-20 over many columns: one projection list, apply with ``df.select``."""
    return [F.nullif(F.col(n), F.lit(sentinel)).alias(n) for n in names]


def mask_pan(pan: Column) -> Column:
    """H-50: first six, six stars, last four; text under ten characters is kept."""
    p = F.trim(pan)
    return F.when(F.length(p) < 10, pan).otherwise(
        F.concat(F.left(p, F.lit(6)), F.lit("******"), F.right(p, F.lit(4)))
    )


def mask_pan_keep_length(pan: Column) -> Column:
    """H-50 partner form: first six and last three stay, stars fill the length."""
    p = F.trim(pan)
    return F.when(F.length(p) < 10, p).otherwise(
        F.concat(
            F.left(p, F.lit(6)),
            F.repeat(F.lit("*"), F.length(p) - 9),
            F.right(p, F.lit(3)),
        )
    )


def card_alias(card_id: Column) -> Column:
    """H-51: base64 of the SHA-256 bytes."""
    return F.base64(F.unhex(F.sha2(card_id, 256)))


def zero_pad(n: Column, width: int) -> Column:
    """H-52: pads like a number format, never truncates."""
    s = n.cast("string")
    return F.when(F.length(s) >= width, s).otherwise(F.lpad(s, width, "0"))


def fixed_decimals(x: Column, places: int, scale: int = 18) -> Column:
    """H-53: decimal text with exactly ``places`` digits, rounded half up."""
    return F.round(x.cast(f"decimal(38,{scale})"), places).cast(f"decimal(38,{places})").cast("string")


def money_text(x: Column) -> Column:
    """B-13: amount with two decimals."""
    return fixed_decimals(x, 2)


def thousands(x: Column, places: int = 2) -> Column:
    """H-54."""
    return F.format_number(x, places)


def digits_only(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def count_char(c: Column, char: str) -> Column:
    """H-68."""
    return F.length(c) - F.length(F.replace(c, F.lit(char), F.lit("")))


def strip_quotes(c: Column) -> Column:
    """H-69."""
    return F.regexp_replace(c, "['\"]", "")


def text_between(c: Column, left: str, right: str) -> Column:
    """H-66: text after the first ``left`` up to the next ``right``; null when absent."""
    start = F.instr(c, left)
    rest = F.substr(c, start + len(left))
    stop = F.instr(rest, right)
    return F.when((start > 0) & (stop > 0), F.substr(rest, F.lit(1), stop - 1))


def list_has_text(items: Column, item: Column) -> Column:
    """H-71: substring test on a delimited list, as the settlement exclusions use it."""
    return F.instr(F.coalesce(norm_key(items), F.lit("")), norm_key(item)) > 0


def address_line(*parts: Column) -> Column:
    """H-67: null as soon as one part is null."""
    joined: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            joined.append(F.lit(" "))
        joined.append(p)
    return F.upper(F.concat(*joined))


def email_domain(c: Column) -> Column:
    return F.lower(F.when(F.instr(c, "@") > 0, F.substring_index(c, "@", -1)))


def file_base_name(path: Column) -> Column:
    """H-70: last path segment, the one canonical file name of the engine."""
    return F.substring_index(path, "/", -1)


def name_slice(name: Column, start: int, length: int) -> Column:
    """H-70: 1-based slice of a file name; a start of 0 counts as 1."""
    return F.substring(name, max(start, 1), length)
