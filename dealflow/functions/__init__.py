"""Column -> Column helpers built only from Spark built-ins (no UDFs)."""

from dealflow.functions.dates import (  # noqa: F401
    add_days,
    date_only,
    et_date,
    iso_day,
    midpoint,
    month_bounds,
    prior_window,
    start_date,
    window_bounds,
)
from dealflow.functions.flags import (  # noqa: F401
    categorize,
    effective_cash,
    is_booked,
    is_closing_call,
    is_completed,
    null_safe_flag,
    pc_due_pred,
    rc_due_pred,
)
from dealflow.functions.ratios import (  # noqa: F401
    is_inactive,
    money,
    money_k,
    money_k_signed,
    pct_label,
    progress,
    ratio_or_zero,
    report_pct,
    report_ratio,
    safe_pct,
    status,
    to_ratio,
)
