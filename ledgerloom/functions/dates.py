"""Calendar column functions (S-26..S-55, H-55..H-64)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def at(moment: dt.datetime) -> Column:
    """Literal wall time, independent of the machine's and the session's time zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def month_index(d: Column) -> Column:
    """Months since year 0: makes 'three months before' an integer range."""
    return F.year(d) * 12 + F.month(d)


def days_in_month(d: Column) -> Column:
    """D-18."""
    return F.dayofmonth(F.last_day(d))


def monday_week_start(d: Column) -> Column:
    """H-58."""
    return F.date_sub(d, F.weekday(d))


def monday_week_end(d: Column) -> Column:
    return F.date_add(monday_week_start(d), 6)


def sunday_week_start(d: Column) -> Column:
    """H-59."""
    return F.date_sub(d, F.dayofweek(d) - 1)


def sunday_week_number(d: Column) -> Column:
    """H-59: weeks begin on Sunday; days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(d) + 7 - F.dayofweek(d)) / 7).cast("int")


def fiscal_year_start(d: Column) -> Column:
    """Fiscal years have 52 or 53 whole weeks and begin on the last Monday up to 30 June."""
    this = monday_week_start(F.make_date(F.year(d), F.lit(6), F.lit(30)))
    last = monday_week_start(F.make_date(F.year(d) - 1, F.lit(6), F.lit(30)))
    return F.when(d >= this, this).otherwise(last)


def fiscal_week(d: Column) -> Column:
    """1 to 53."""
    return (F.floor(F.date_diff(d, fiscal_year_start(d)) / 7) + 1).cast("int")


def fiscal_period(week: Column) -> Column:
    """12 periods of 4, 4 and 5 weeks; a 53rd week belongs to the last."""
    quarter = F.least(F.floor((week - 1) / 13), F.lit(3))
    return (quarter * 3 + F.least(F.floor((week - 1 - quarter * 13) / 4), F.lit(2)) + 1).cast("int")


def fiscal_period_start(year_start: Column, period: Column) -> Column:
    quarter, inside = F.floor((period - 1) / 3), F.pmod(period - 1, F.lit(3))
    return F.date_add(year_start, ((quarter * 13 + inside * 4) * 7).cast("int"))


def iso_year2(d: Column) -> Column:
    """H-57: two-digit year of the ISO week."""
    return F.lpad((F.year(F.date_add(monday_week_start(d), 3)) % 100).cast("string"), 2, "0")


def day_month_iso_year(d: Column) -> Column:
    """H-57: the ddMMyy reference text whose year is the ISO one."""
    return F.concat(F.date_format(d, "ddMM"), iso_year2(d))


def previous_month(d: Column) -> Column:
    """H-60: date arithmetic in place of text surgery on month keys."""
    return F.add_months(month_start(d), -1)


def month_text(d: Column) -> Column:
    return F.date_format(d, "yyyy-MM")


def timestamp_from_int(n: Column) -> Column:
    """H-55: yyyyMMddHHmmss as a number, right-padded with zeros; bad text gives null."""
    return F.try_to_timestamp(F.rpad(n.cast("string"), 14, "0"), F.lit("yyyyMMddHHmmss")).cast(
        "timestamp_ntz"
    )


def date_time_or_default(d: Column, hhmmss: Column) -> Column:
    """H-56: date plus time text, 1900-01-01 and midnight standing in for nulls."""
    return F.to_timestamp_ntz(
        F.concat(
            F.coalesce(F.date_format(d, "yyyy-MM-dd"), F.lit("1900-01-01")),
            F.lit(" "),
            F.coalesce(hhmmss, F.lit("00:00:00")),
        ),
        F.lit("yyyy-MM-dd HH:mm:ss"),
    )


def compact_stamp(ts: Column) -> Column:
    """yyyyMMddTHHmmss, used inside transaction ids."""
    return F.date_format(ts, "yyyyMMdd'T'HHmmss")


def local_from_utc(ts: Column, zone: str) -> Column:
    """H-64."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), ts.cast("timestamp_ntz"))


def utc_from_local(ts: Column, zone: str) -> Column:
    """H-64."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), ts.cast("timestamp_ntz"))


def time_text(ts: Column) -> Column:
    """Time of day as HH:mm:ss text: sorts like a time, independent of a TIME type."""
    return F.date_format(ts, "HH:mm:ss")


def seconds_of_day(ts: Column) -> Column:
    return F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)


def plus_seconds(ts: Column, seconds: Column) -> Column:
    return ts + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))


def plus_minutes(ts: Column, minutes: Column) -> Column:
    return ts + F.make_dt_interval(mins=minutes.cast("int"))


def cutoff_label(ts: Column, cutoff: str = "18:00:00", before: str = "Pre", after: str = "Post") -> Column:
    """C-19: the cut-off second itself still counts as before."""
    return F.when(time_text(ts) <= cutoff, before).otherwise(after)


def hhmm_minutes(hhmm: Column) -> Column:
    """Minutes of an HHMM number such as 1830."""
    return F.floor(hhmm / 100).cast("int") * 60 + (hhmm % 100).cast("int")


def cutoff_shift_minutes(hhmm: Column) -> Column:
    """H-63: minutes that carry a cut-off to the next midnight; midnight itself shifts nothing."""
    minutes = hhmm_minutes(hhmm)
    return F.when(minutes > 0, 24 * 60 - minutes).otherwise(0)


def cutoff_on(day: Column, hhmm: Column) -> Column:
    """Timestamp of an HHMM cut-off on a day."""
    return plus_minutes(day.cast("timestamp_ntz"), hhmm_minutes(hhmm))


# fixed values: position of a weekday name when weeks are counted from Monday
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday"]


def payout_date(day: Column, payout_days: Column, schedule: Column, weekend_payout: Column) -> Column:
    """H-62: day plus schedule; weekday-only plans move weekend work to a named weekday
    and a due date that falls on a weekend to the following Monday."""
    target = F.array_position(F.array(*[F.lit(w) for w in WEEKDAYS]), weekend_payout).cast("int")
    # array_position is 1 for Monday; a Saturday is two days before the next Monday
    from_weekend = F.date_add(day, F.when(target > 0, target + (6 - F.weekday(day))))
    due = F.date_add(day, schedule)
    rolled = F.date_add(due, F.when(F.weekday(due) >= 5, 7 - F.weekday(due)).otherwise(0))
    # the reported calendar adds 1 day for a Sunday and 2 for a Saturday
    return F.when(
        payout_days == "Weekdays", F.when(F.weekday(day) >= 5, from_weekend).otherwise(rolled)
    ).otherwise(due)


def last_complete_week(run_date: dt.date, first_weekday: int = 3) -> tuple[dt.date, dt.date]:
    """H-61: last full week before ``run_date`` that starts on ``first_weekday`` (Monday is 0,
    so the default is Thursday to Wednesday)."""
    end_weekday = (first_weekday - 1) % 7
    back = (run_date.weekday() - end_weekday) % 7 or 7
    end = run_date - dt.timedelta(days=back)
    return end - dt.timedelta(days=6), end


def week_of_cycle(d: Column, first_weekday: int = 3) -> Column:
    """Start day of the week containing ``d`` for weeks that begin on ``first_weekday``."""
    return F.date_sub(d, F.pmod(F.weekday(d) - first_weekday, F.lit(7)).cast("int"))
