"""Percent conventions and display labels.

Three percent conventions exist and are never mixed:

* ``report_pct``  - wide report: ROUND(100 * num / NULLIF(den, 0)), NULL on empty;
* ``safe_pct``    - tables: NULL when den <= 0 (or NULL), else rounded num / den * 100;
* ``ratio_or_zero`` - leaderboards: 0 when den is 0.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dealflow import config as C
from dealflow.functions.dates import _col


def safe_pct(num, den) -> Column:
    """F17."""
    n, d = _col(num), _col(den)
    return F.when(d > 0, F.round(F.lit(100.0) * n / d, 0))


def ratio_or_zero(num, den) -> Column:
    """F18."""
    n, d = _col(num), _col(den)
    return F.when(d > 0, n / d).otherwise(F.lit(0.0))


def report_pct(num, den) -> Column:
    """F19."""
    return F.round(F.lit(100.0) * _col(num) / F.nullif(_col(den), F.lit(0)), 0)


def report_ratio(num, den) -> Column:
    """F19 without the factor 100 (average dollars per live call)."""
    return F.round(_col(num) / F.nullif(_col(den), F.lit(0)), 0)


def to_ratio(x) -> Column:
    """a percent-shaped value (> 1) becomes a 0..1 ratio."""
    c = _col(x)
    return F.when(c > 1, c / 100.0).otherwise(c)


def _int_text(x: Column) -> Column:
    return F.format_string("%d", F.round(x, 0).cast("bigint"))


def money_k(x) -> Column:
    """``$1.2K`` from 1,000; no decimals from 100K; ``$N`` below 1,000."""
    c = _col(x)
    k = c / 1000.0
    return (
        F.when(c >= 100_000, F.concat(F.lit("$"), _int_text(k), F.lit("K")))
        .when(c >= 1_000, F.concat(F.lit("$"), F.format_string("%.1f", F.round(k, 1)), F.lit("K")))
        .otherwise(F.concat(F.lit("$"), _int_text(c)))
    )


def money_k_signed(x) -> Column:
    """signed ``money_k``: ``+$1.2K`` / ``-$800``."""
    c = _col(x)
    return F.concat(F.when(c >= 0, F.lit("+")).otherwise(F.lit("-")), money_k(F.abs(c)))


def money(x) -> Column:
    """whole dollars with thousands separators, ``$4,184``."""
    return F.concat(F.lit("$"), F.format_number(F.round(_col(x), 0).cast("bigint"), 0))


def pct_label(x) -> Column:
    """``round(to_ratio(x) * 100)%``."""
    return F.concat(_int_text(to_ratio(x) * 100.0), F.lit("%"))


def progress(value, goal) -> Column:
    """value / goal, NULL without a goal."""
    return _col(value) / F.nullif(_col(goal), F.lit(0))


def status(value, target) -> Column:
    """traffic light: >= target green, >= 60 % yellow, else red; NULL without target."""
    r = progress(value, target)
    return (
        F.when(r.isNull(), F.lit(None).cast("string"))
        .when(r >= 1, F.lit("green"))
        .when(r >= C.STATUS_YELLOW_FROM, F.lit("yellow"))
        .otherwise(F.lit("red"))
    )


def is_inactive(value) -> Column:
    """closers with nothing in the window are greyed out."""
    return F.coalesce(_col(value), F.lit(0)) == 0
