"""Run parameters: every 'today' the pipelines need is passed in, never read from a clock."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


def add_months(day: dt.date, months: int) -> dt.date:
    """First-of-month arithmetic for report windows."""
    index = day.year * 12 + (day.month - 1) + months
    return dt.date(index // 12, index % 12 + 1, 1)


@dataclass(frozen=True)
class RunParams:
    run_date: dt.date
    run_ts: dt.datetime | None = None
    store_width: int = 5
    baseline_from: dt.date = field(default=dt.date(2020, 10, 1))
    months_back: int = 10
    months_read: int = 11
    months_reported: int = 8

    @property
    def now(self) -> dt.datetime:
        return self.run_ts or dt.datetime.combine(self.run_date, dt.time())

    # I-25: the monthly rules read an 11 month window and report its last 8 months
    @property
    def window_start(self) -> dt.date:
        return add_months(self.run_date.replace(day=1), -self.months_back)

    @property
    def window_end(self) -> dt.date:
        return add_months(self.window_start, self.months_read)

    @property
    def report_start(self) -> dt.date:
        return add_months(self.window_end, -self.months_reported)
