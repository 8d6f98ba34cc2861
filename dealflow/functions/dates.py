"""Date and time helpers.

Two kinds of timestamps exist in the CRM and must never be mixed up:

* real instants (meeting start, stage entry, plain close date) are converted to the
  America/New_York calendar day (``et_date``);
* midnight-anchored date properties (renewal close date, payment dates, expiration)
  are plain casts (``date_only``) - shifting them would move them one day back.

All helpers accept Columns or Python dates for ``as_of`` so they can be evaluated per
row (e.g. over a column of order dates) as well as with a single literal.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from dealflow.config import TIMEZONE


def ntz_lit(x: _dt.datetime) -> Column:
    """A naive datetime as a TIMESTAMP_NTZ literal - no session or process time zone is
    involved (``F.lit(datetime)`` would be an instant in the Python process's zone)."""
    return F.expr(f"TIMESTAMP_NTZ '{x.replace(tzinfo=None).isoformat(sep=' ')}'")


def _col(x) -> Column:
    if isinstance(x, Column):
        return x
    if isinstance(x, str):
        return F.col(x)
    if isinstance(x, _dt.datetime):
        return ntz_lit(x)
    return F.lit(x)


def as_date(x) -> Column:
    """A Python date / ISO string literal / Column as a DATE column."""
    if isinstance(x, _dt.date) and not isinstance(x, _dt.datetime):
        return F.lit(x)
    if isinstance(x, str) and len(x) == 10 and x[4] == "-":
        return F.lit(_dt.date.fromisoformat(x))
    return _col(x).cast("date")


def et_date(ts, tz: str = TIMEZONE) -> Column:
    """instant stored as UTC wall time (timestamp_ntz) -> calendar day in ``tz``.

    ``convert_timezone`` works on timestamp_ntz; a timestamp_ltz input is first read in the
    session time zone, which the engine sets to UTC.
    """
    c = _col(ts)
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), c.cast("timestamp_ntz")))


def date_only(ts) -> Column:
    """midnight-anchored timestamp -> date, no zone shift."""
    return _col(ts).cast("date")


def add_days(d, n) -> Column:
    """F8: d + n days (n may be negative or a Column)."""
    return F.date_add(as_date(d), n if isinstance(n, Column) else F.lit(int(n)))


def start_date(close_date, close_date_fallback, contact_date, tz: str = TIMEZONE) -> Column:
    """3-tier start date: renewal close date (date rule), plain close date and the
    contact's close date (both instants)."""
    return F.coalesce(date_only(close_date), et_date(close_date_fallback, tz), et_date(contact_date, tz))


def midpoint(start, end) -> Column:
    """start + floor(days(start, end) / 2); negative spans round towards -inf."""
    s, e = as_date(start), as_date(end)
    half = F.floor(F.datediff(e, s) / F.lit(2)).cast("int")
    return F.date_add(s, half)


def month_bounds(as_of) -> dict[str, Column]:
    """month-to-date and the same elapsed days of the prior month (clamped)."""
    today = as_date(as_of)
    prior_month_start = F.trunc(F.add_months(today, -1), "MM")
    return {
        "today_et": today,
        "yesterday_et": F.date_sub(today, 1),
        "mtd_start": F.trunc(today, "MM"),
        "mtd_end": today,
        "prior_month_start": prior_month_start,
        "prior_mtd_end": F.least(
            F.date_add(prior_month_start, F.dayofmonth(today) - 1),
            F.last_day(F.add_months(today, -1)),
        ),
    }


def prior_window(start, end) -> tuple[Column, Column]:
    """the equal-length window right before [start, end] (inclusive)."""
    s, e = as_date(start), as_date(end)
    length = F.datediff(e, s) + 1
    prior_end = F.date_sub(s, 1)
    prior_start = F.date_sub(prior_end, length - 1)
    return prior_start, prior_end


#: Presets of a number of days up to yesterday.
LAST_DAYS = {"last3d": 3, "last7d": 7, "last14d": 14, "last30d": 30}
WINDOW_PRESETS = ("today", "yesterday", *LAST_DAYS, "mtd", "custom")


def window_bounds(preset: str, as_of, start=None, end=None) -> tuple[Column, Column]:
    """window presets. Every preset but ``today`` ends yesterday (landing lag);
    ``mtd`` starts on the first of yesterday's month."""
    today = as_date(as_of)
    yday = F.date_sub(today, 1)
    if preset == "today":
        return today, today
    if preset == "yesterday":
        return yday, yday
    if preset in LAST_DAYS:
        return F.date_sub(yday, LAST_DAYS[preset] - 1), yday
    if preset == "mtd":
        return F.trunc(yday, "MM"), yday
    if preset == "custom":
        if start is None or end is None:
            raise ValueError("window 'custom' needs start and end")
        return as_date(start), as_date(end)
    raise ValueError(f"unknown window preset {preset!r}; expected one of {WINDOW_PRESETS}")


def window_dates(preset: str, as_of: _dt.date, start: _dt.date | None = None, end: _dt.date | None = None) -> tuple[_dt.date, _dt.date]:
    """F12 as dates, for one run's parameters."""
    yday = as_of - _dt.timedelta(days=1)
    if preset == "custom" and not (start and end):
        raise ValueError("window 'custom' needs start and end")
    if preset not in WINDOW_PRESETS:
        raise ValueError(f"unknown window preset {preset!r}; expected one of {WINDOW_PRESETS}")
    fixed = {"today": (as_of, as_of), "yesterday": (yday, yday), "mtd": (yday.replace(day=1), yday), "custom": (start, end)}
    return fixed[preset] if preset in fixed else (yday - _dt.timedelta(days=LAST_DAYS[preset] - 1), yday)


def iso_day(s) -> Column:
    """F16: ISO date/datetime text -> date of its first 10 characters; empty or malformed -> NULL."""
    c = _col(s)
    return F.when(F.length(c) >= 10, F.try_to_date(F.substring(c, 1, 10), "yyyy-MM-dd"))
