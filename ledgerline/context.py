"""Run context: the one frozen "as of" date that every snapshot slice uses.

The daily jobs this library models read ``now()`` inside SQL text.  Here the
date is an explicit value so a run can be repeated, back-dated and tested.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta


def month_key(d: date) -> str:
    return f"{d.year:04d}-{d.month:02d}"


def add_months(d: date, n: int) -> date:
    """First day of the month ``n`` months after ``d``'s month."""
    m = d.year * 12 + (d.month - 1) + n
    return date(m // 12, m % 12 + 1, 1)


@dataclass(frozen=True)
class RunContext:
    """Frozen parameters of one run.

    as_of        the run date; ``ds`` of today's snapshot is derived from it.
    first_close  first month-close snapshot (``yyyyMMdd``, a day 01) that may be
                 read by the closed-month slice.
    floor_month  lowest ``yyyy-MM`` a feed may emit (None = no floor).
    tz           session time zone the event months are defined in.
    """

    as_of: date
    first_close: str = "20010601"
    floor_month: str | None = "2001-05"
    tz: str = "UTC"

    @property
    def ds(self) -> str:
        return self.as_of.strftime("%Y%m%d")

    @property
    def month(self) -> str:
        return month_key(self.as_of)

    @property
    def yesterday(self) -> date:
        return self.as_of - timedelta(days=1)

    @property
    def window_start(self) -> str:
        """Lowest month rewritten by an incremental run: month(as_of - 1 day).

        On the 1st this is the previous month (it is being closed), otherwise
        the current one.  Before the first close nothing older can be closed.
        """
        if self.ds < self.first_close:
            return self.month
        return month_key(self.yesterday)

    @property
    def rebuild_months(self) -> list[str]:
        """Months a full rebuild can close: the month before the first close up to today's."""
        first = date(int(self.first_close[:4]), int(self.first_close[4:6]), 1)
        out, d = [], add_months(first, -1)
        while month_key(d) <= self.month:
            out.append(month_key(d))
            d = add_months(d, 1)
        return out

    def closing_ds(self, month: str) -> str:
        """The snapshot that holds ``month`` for good: that of the 1st after it, or
        today's for a month that is not over."""
        close = add_months(date(int(month[:4]), int(month[5:]), 1), 1).strftime("%Y%m%d")
        return min(close, self.ds)

    @property
    def window_months(self) -> list[str]:
        out, d = [], date(int(self.window_start[:4]), int(self.window_start[5:]), 1)
        while month_key(d) <= self.month:
            out.append(month_key(d))
            d = add_months(d, 1)
        return out
