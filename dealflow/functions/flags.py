"""Meeting / deal predicates.

Three-valued logic is kept deliberately: ``is_completed`` is NULL for a NULL outcome,
exactly like ``outcome = 'COMPLETED'`` in SQL, while ``is_booked`` is FALSE for it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from dealflow import config as C
from dealflow.functions.dates import _col, add_days, as_date


_CATEGORY = {a: category for category, activities in (("PC", C.PC_ACTIVITY_TYPES), ("RC", C.RC_ACTIVITY_TYPES),
                                                      ("PWC", C.PWC_ACTIVITY_TYPES), ("WB", C.WB_ACTIVITY_TYPES)) for a in activities}


def is_booked(outcome) -> Column:
    """Outcome present and not canceled."""
    o = _col(outcome)
    return o.isNotNull() & ~o.isin(*C.CANCELED_OUTCOMES)


def is_completed(outcome) -> Column:
    """Exactly COMPLETED (sub-outcomes such as 'COMPLETED - NURTURE' do not count)."""
    return _col(outcome) == F.lit(C.COMPLETED_OUTCOME)


def categorize(activity_type) -> Column:
    """Activity type -> PC / RC / PWC / WB, NULL otherwise (retired types included)."""
    # A lookup in constant arrays: filters on the category then hold the activity's own expression once, not once
    # a category (the JVM leaves methods of generated code uncompiled beyond 8,000 bytes), and unlike map
    # literals, arrays compare equal, so that equal plans are still found and run once.
    at = F.array_position(F.array(*map(F.lit, _CATEGORY)), _col(activity_type))
    return F.get(F.array(*map(F.lit, _CATEGORY.values())), at.cast("int") - 1)


def is_closing_call(category, completed, activity_type) -> Column:
    """P10: completed RC/PWC/WB call that is not a follow-up (NULL if completion is NULL)."""
    return (
        _col(category).isin(*C.LIVE_CATEGORIES)
        & _col(completed)
        & (F.coalesce(_col(activity_type), F.lit("")) != F.lit(C.FOLLOW_UP_ACTIVITY_TYPE))
    )


def null_safe_flag(col, value) -> Column:
    """``coalesce(col = value, false)``."""
    return F.coalesce(_col(col) == F.lit(value), F.lit(False))


def effective_cash(cash, amount) -> Column:
    """cash collected unless it is zero/NULL, else the deal amount."""
    return F.coalesce(F.nullif(_col(cash), F.lit(0)), _col(amount))


def rc_due_pred(as_of, expiration_date, days: int = C.RC_DUE_DAYS) -> Column:
    """as_of within [expiration - days, expiration]."""
    exp = as_date(expiration_date)
    return as_date(as_of).between(F.date_sub(exp, days), exp)


def pc_due_pred(as_of, midpoint_date, lead_days: int = C.PC_DUE_LEAD_DAYS) -> Column:
    """as_of on or after midpoint - lead_days; no upper bound."""
    return as_date(as_of) >= add_days(midpoint_date, -lead_days)
