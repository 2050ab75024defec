"""Matches of a regular expression with their places, by native functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: an array of matches holds fewer than 2 ** STEPS; their text would be some hundred MB
STEPS = 24


def found(text: Column, pattern: str | Column, group: int = 0) -> Column:
    """All leftmost non-overlapping matches (or a group of each), in order."""
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def gaps(text: Column, pattern: str | Column) -> Column:
    """What stands before, between and after the matches."""
    return F.split(text, pattern, -1)


def bound(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value made once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """All values up to each place of an array joined into one: sums, greatest or least so far.

    Each step joins what stands 1, 2, 4 … places before, so an array of n values takes about
    n * log2(n) joins.  An array of 2 ** ``STEPS`` values or more fails.
    """

    def joined(step: int) -> Callable[[Column], Column]:
        return lambda p: F.when(F.size(p) > step, F.transform(p, lambda x, i: F.when(i >= step, join(x, F.get(p, i - step))).otherwise(x))).otherwise(p)

    out = F.when(F.size(values) < 1 << STEPS, values).otherwise(F.raise_error(F.lit("too many matches in one text")))
    for k in range(STEPS):
        out = bound(out, joined(1 << k))
    return out


def places(text: Column, pattern: str) -> Column:
    """Start and end (exclusive, in code points) of each match, in the order of ``found``."""
    lengths = F.zip_with(gaps(text, pattern), found(text, pattern), lambda g, m: F.struct(F.length(g).alias("gap"), F.coalesce(F.length(m), F.lit(0)).alias("len")))

    def spans(parts: Column) -> Column:
        ends = running(F.transform(parts, lambda x: x["gap"] + x["len"]), lambda a, b: a + b)
        every = F.zip_with(ends, parts, lambda e, x: F.struct((e - x["len"]).alias("start"), e.alias("end")))
        return F.slice(every, 1, F.greatest(F.size(every) - 1, F.lit(0)))

    return bound(lengths, spans)
